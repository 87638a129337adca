"""A history placed by entity: the same marts, without any exchange of its rows."""

import pytest
from pyspark.sql import functions as F

from ledgerfold.operators.placed import place_history, read_placed
from ledgerfold.operators.stats import fit_population_stats
from ledgerfold.plans import mart as M
from ledgerfold.plans import presets as P
from ledgerfold.plans import views as V
from ledgerfold.sources.scratch import new_path
from tests.conftest import rows_of
from tests.test_marts import credit_history


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("hot", [[], [3, 5], [None, 7]])
def test_same_marts(spark, hot):
    h = credit_history(spark).union(credit_history(spark, 3).withColumn("id", F.lit(None).cast("bigint")))
    kept = read_placed(spark, place_history(h, new_path(spark, "placed"), "id", "rn", buckets=4, hot=hot))
    assert kept.hot == hot and rows_of(kept.rows()) == rows_of(h)
    stats = fit_population_stats(h, list(P.CREDIT_V2.coded))

    def rows(df):
        cols = sorted(df.columns)
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)) for r in df.collect()), key=repr)

    assert rows(M.mart_v1(kept, P.CREDIT_KEYS, P.CREDIT_V1)) == rows(M.mart_v1(h, P.CREDIT_KEYS, P.CREDIT_V1, hot=[]))
    assert rows(M.mart_v2(kept, P.CREDIT_KEYS, P.CREDIT_V2, stats)) == rows(M.mart_v2(h, P.CREDIT_KEYS, P.CREDIT_V2, stats, hot=[]))


def test_no_exchange_of_the_history(spark, sf):
    """Neither mart moves rows of the history; the only exchanges are those of counts by value."""
    kept = read_placed(spark, place_history(V.history(spark, sf), new_path(spark, "placed"), "id", "seq", buckets=4))
    stats = spark.createDataFrame([(c, 1, [2]) for c in V.MART_V2.coded], "feature string, mode_value int, rare_bins array<int>").coalesce(1)
    for made in (M.mart_v1(kept, V.KEYS, V.MART_V1), M.mart_v2(kept, V.KEYS, V.MART_V2, stats)):
        blocks = formatted(made).split("\n\n")
        moved = [b for b in blocks if b.split(") ")[-1].startswith("Exchange") or ") Exchange" in b.split("\n")[0]]
        assert all("hashpartitioning(id#" not in b for b in moved)
        assert "Bucketed: true" in formatted(made) and "Join" not in formatted(made)


def test_wrong_key_is_refused(spark):
    h = credit_history(spark, 5)
    kept = read_placed(spark, place_history(h, new_path(spark, "placed"), "id", buckets=2, hot=[]))
    with pytest.raises(ValueError):
        M.mart_v1(kept, M.HistorySpec(id="rn", rn="rn", order="rn"), P.CREDIT_V1)


def test_empty_history(spark):
    h = credit_history(spark, 5).where("id < 0")
    kept = read_placed(spark, place_history(h, new_path(spark, "placed"), "id", "rn"))
    assert M.mart_v1(kept, P.CREDIT_KEYS, P.CREDIT_V1).count() == 0
