"""Statistics and monitor counts that grow with arriving files."""

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import arrivals as AR
from ledgerfold.operators import evaluate as EV
from ledgerfold.operators import stats as ST
from ledgerfold.plans import views as V
from ledgerfold.sources.scratch import new_path
from ledgerfold.streaming.monitor import latest_counts, monitor_stream
from tests.conftest import rows_of

COLS = ["pre_disc", "pre_part", "enc_ret"]


def test_two_arrivals_are_one_fit(spark, sf, monkeypatch):
    h = V.history(spark, sf).withColumn("pre_none", F.lit(None).cast("int"))
    path, state, cols = new_path(spark, "in"), new_path(spark, "state"), [*COLS, "pre_none"]
    train = lambda rows: rows.where(F.col("id") % 3 != 0)
    counted = []
    plain = ST.value_counts

    def watched(rows, *args, **kw):
        counted.append(rows.count())
        return plain(rows, *args, **kw)

    monkeypatch.setattr(AR, "value_counts", watched)
    for part in (0, 1):
        h.where(F.col("rn") % 2 == part).write.mode("append").parquet(path)
        assert AR.count_arrival(spark, state, path, h.schema, cols, train) > 0
        assert AR.count_arrival(spark, state, path, h.schema, cols, train) == 0
    # the second arrival read its own rows alone
    assert counted == [train(h.where(F.col("rn") % 2 == part)).count() for part in (0, 1)]
    assert rows_of(AR.arrived_stats(spark, state)) == rows_of(ST.stats_of(train(h), cols))


def test_an_unfinished_arrival_does_not_count(spark, sf):
    h = V.history(spark, sf)
    path, state = new_path(spark, "in"), new_path(spark, "state")
    h.write.parquet(path)
    ST.value_counts(h, COLS, keep_null=True).write.parquet(f"{state}/counts/arrival=cut-short")
    assert AR.arrived_counts(spark, state).count() == 0
    AR.count_arrival(spark, state, path, h.schema, COLS)
    assert rows_of(AR.arrived_stats(spark, state)) == rows_of(ST.stats_of(h, COLS))


def test_statistics_scan_the_history_once(spark, sf):
    text = ST.stats_of(V.history(spark, sf), COLS)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Join" not in text


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_monitor_goes_on_after_a_restart(spark, sf, files_per_batch):
    rows = V.scored(spark, sf).select("id", "predicted", F.round("p", 3).alias("confidence"))
    path, out, checkpoint = (new_path(spark, n) for n in ("in", "out", "checkpoint"))

    def arrive(frame):
        frame.repartition(2).write.mode("append").parquet(path)
        query = monitor_stream(spark, path, rows.schema, out, checkpoint, files_per_batch=files_per_batch)
        query.awaitTermination()
        return latest_counts(spark, out)

    def same(got, want):
        cols = sorted(want.columns)
        flat = [sorted([tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in cols) for r in x.collect()], key=repr) for x in (got, want)]
        assert flat[0] == flat[1]

    same(arrive(rows.where("id % 2 = 0")), EV.prediction_monitor(rows.where("id % 2 = 0"), "predicted", "confidence"))
    late = rows.where("id % 2 = 1").unionByName(spark.createDataFrame([(None, 9, None)], rows.schema))
    same(arrive(late), EV.prediction_monitor(rows.unionByName(late.where("predicted = 9")), "predicted", "confidence"))
    same(arrive(late.limit(0)), EV.prediction_monitor(rows.unionByName(late.where("predicted = 9")), "predicted", "confidence"))
