"""What one task holds is bounded by rows, however many there are and however few bytes they have on the wire."""

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators import blocks as B
from ledgerfold.operators import evaluate as EV
from ledgerfold.operators import skew
from ledgerfold.operators import stats as ST
from ledgerfold.operators.placed import parted
from ledgerfold.operators.skew import hot_keys
from ledgerfold.plans import catalog as C
from ledgerfold.plans import mart as M
from ledgerfold.plans import views as V
from tests.conftest import rows_of


def explained(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("hot", [None, 7])
def test_parts_follow_the_rows(spark, skewed, monkeypatch, hot):
    """F1, F2, F6, F7."""
    monkeypatch.setattr(skew, "PART_ROWS", 100)
    cold, hot_rows = parted(skewed, "id", hot_keys(skewed, "id", 500 if hot else None))
    assert cold.rdd.getNumPartitions() == 30 and (hot_rows is not None) == bool(hot)
    monkeypatch.setattr(skew, "PART_ROWS", 3000)
    assert parted(skewed, "id", hot_keys(skewed, "id"))[0].rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("made", [ST.local_modes, ST.local_non_dominant_counts])
def test_own_values_without_a_row_per_value(spark, skewed, made):
    """ordinary entities' rows are not multiplied by the columns; same rows as the hot plan."""
    cold = made(skewed, "id", ["a", "b"], hot=[])
    assert "explode" not in explained(cold)
    assert rows_of(cold) == rows_of(made(skewed, "id", ["a", "b"], hot=[7]))
    assert cold.schema == made(skewed, "id", ["a", "b"], hot=[7]).schema


def test_stretches_of_lists(spark):
    """F7."""
    df = spark.createDataFrame([(1, [2, None, 1, 2, 1]), (2, []), (3, [None]), (4, [5]), (5, [3, 3, 1, 3])], "id int, l array<int>")
    got = B.with_runs(df, {"l": "l"}).select("id", B.listed_mode("l").alias("m"), *B.listed_non_dominant("l", "l")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 1, 2, 0.5), (2, None, None, None), (3, None, None, None), (4, 5, 0, 0.0), (5, 3, 1, 0.25)]


def test_edges_are_two_aggregates(spark, sf):
    """first and last values are one struct each."""
    folded = M.folded_snapshots(ST.inject_modes(V.history(spark, sf), ST.global_modes(V.history(spark, sf), V.CODES), V.CODES)[0], V.KEYS, V.MART_V1)
    plan = explained(folded)
    partial = next(line for line in plan.split("\n") if "partial_max_by" in line)
    assert partial.count("partial_max_by") == 1 and partial.count("partial_min_by") == 1


def test_buckets_follow_the_rows(spark, sf, monkeypatch):
    """in the placed queries too."""
    monkeypatch.setattr(skew, "PART_ROWS", 200)
    rows = V.history(spark, sf).count()
    kept = C.placed(spark, sf)
    assert f" out of {-(-rows // 200)}" in explained(kept.cold.groupBy("id").count()) and rows > 8 * 200
    assert rows_of(kept.rows()) == rows_of(V.history(spark, sf))


@pytest.mark.parametrize("hot_rows", [10**9, 500])
def test_profile_deals_by_rows(spark, skewed, monkeypatch, hot_rows):
    """ids and duplicate rows, ordinary and hot, a null id among them."""
    df = skewed.drop("flag").union(skewed.drop("flag").limit(40)).union(spark.sql("SELECT CAST(NULL AS bigint), 1, 1, 1 UNION ALL SELECT NULL, 1, 1, 1"))
    df = df.cache()
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(skew, "PART_ROWS", 100)
    made = EV.dataset_profile(df, "id", "rn", "b", ["a"])
    assert "31)" in "".join(line for line in explained(made).split("\n") if "REPARTITION_BY_NUM" in line)
    got = {r["metric"]: r["value"] for r in made.collect()}
    rows = [tuple(r) for r in df.collect()]
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert got["rows"] == len(rows) and got["ids"] == len(by) and got["duplicate_rows"] == len(rows) - len(set(rows))
    assert got["ids_with_two_labels"] == sum(len({r[3] for r in rs}) > 1 for rs in by.values())
    assert abs(got["mean_of_mean_rn"] - sum(sum(r[1] for r in rs) / len(rs) for rs in by.values()) / len(by)) < 1e-6
