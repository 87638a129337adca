"""The driver's tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.plans.mart import GridSpec, HistorySpec, LeakFreeMart, SnapshotMart

KEYS = HistorySpec(id="id", rn="rn", order="seq")
GRID = GridSpec(pattern="^grid_[0-9]+$", special=(3,))
CODES = ("pre_disc", "pre_tax", "pre_qty", "pre_part", "enc_ret", "enc_stat")

MART_V1 = SnapshotMart(
    last=(*CODES, "pclose_flag", "fclose_flag"), first=("pre_disc", "enc_ret", "enc_stat"),
    shares=("is_zero_a", "is_zero_b", "is_zero_c", "pclose_flag", "fclose_flag"),
    ever_off={"ever_had_a": "is_zero_a", "ever_had_b": "is_zero_b"},
    coded=CODES, local=("pre_disc", "pre_tax", "pre_part", "enc_ret"), distinct=CODES,
    sequences=("pre_disc", "pre_part", "enc_ret"), first_eq_last=("pre_disc", "pre_part"),
    grid=GRID)

MART_V2 = LeakFreeMart(
    flags=("pclose_flag", "fclose_flag"), overdue={"a": "is_zero_a", "b": "is_zero_b"}, usage={"c": "is_zero_c"},
    usage_counted=("c",), serious=("is_zero_a", "is_zero_b"), any=("is_zero_a", "is_zero_b", "is_zero_c"), mild="is_zero_a",
    coded={
        "pre_disc": ("nunique", "first", "last", "change_count", "share_global_mode", "share_rare_bins"),
        "pre_tax": ("nunique", "last", "changed_ever", "share_global_mode"),
        "pre_qty": ("nunique", "first", "last", "change_count", "share_global_mode", "share_rare_bins"),
        "pre_part": ("nunique", "first", "last", "change_count", "changed_ever", "share_global_mode"),
        "enc_ret": ("nunique", "first", "last", "change_count"),
    },
    grid=GRID)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as entity history. ``rn`` is the line number, which repeats within an order;
    ``seq`` refines it by a mix of all columns used here, so it orders an entity's rows without a
    ranking over the entity."""
    c = F.col
    disc, tax, price = (F.floor(c(x) * 100 + 0.5).cast("bigint") for x in ("l_discount", "l_tax", "l_extendedprice"))
    disc, tax = disc.cast("int"), tax.cast("int")
    qty = F.floor(c("l_quantity") / 5).cast("int")
    part = F.when(c("l_suppkey") % 10 != 0, (c("l_partkey") % 7).cast("int"))
    ret = F.when(c("l_returnflag") == "A", 0).when(c("l_returnflag") == "N", 1).when(c("l_returnflag") == "R", 2)
    stat = F.when(c("l_linestatus") == "F", 0).when(c("l_linestatus") == "O", 1)
    mix = ((c("l_partkey") % 1000003) * 2000000011 + (c("l_suppkey") % 1000003) * 1000000007 + price * 9999991
           + F.floor(c("l_quantity")).cast("bigint") * 7368787 + disc * F.lit(15485863) + tax * F.lit(3276509) + ret * F.lit(99991) + stat * F.lit(7919))
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("id"), c("l_linenumber").alias("rn"),
        (c("l_linenumber").cast("bigint") * F.lit(2**52) + mix % F.lit(2**52)).alias("seq"),
        disc.alias("pre_disc"), tax.alias("pre_tax"), qty.alias("pre_qty"), part.alias("pre_part"),
        ret.alias("enc_ret"),
        stat.alias("enc_stat"),
        (c("l_discount") <= 0.03).alias("is_zero_a"), (c("l_tax") <= 0.02).alias("is_zero_b"),
        (c("l_quantity") < 40).alias("is_zero_c"),
        (c("l_returnflag") == "R").alias("pclose_flag"), (c("l_linestatus") == "F").alias("fclose_flag"),
        (disc % 5).alias("grid_0"), (tax % 5).alias("grid_1"), (qty % 5).alias("grid_2"), (part % 5).alias("grid_3"),
        (c("l_partkey") % 5).cast("int").alias("grid_4"),
        F.when(c("l_linenumber") <= 5, (c("l_suppkey") % 5).cast("int")).alias("grid_5"),
    )


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("flag"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a fixed score in [0, 1): stands in for a model where a metric needs an exact
    expected value. The score repeats, so ties occur."""
    p = ((F.col("o_orderkey") * 7919 + F.floor("o_totalprice").cast("bigint")) % 1000) / F.lit(1000.0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("actual"), p.alias("p"),
        (p > 0.5).cast("int").alias("predicted"), "o_orderpriority", "o_orderstatus", "o_custkey", "o_totalprice")
