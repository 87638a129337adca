"""Exact top-k search by columnar branch-and-bound.

Vectors become integers, floor(1024 * x). Candidates lie in vertical blocks, one row of the block
per dimension. A query accumulates inner products ``STEP`` dimensions at a time; after each step
the k-th best lower bound (what is accumulated minus the most that the remaining dimensions can
take, by the norms of what is left) is compared with every candidate's upper bound, and the block is
compacted to the candidates that can still be among the k best. Ties are never pruned.

Queries are cut into blocks of about ``QUERIES`` and candidates into blocks of about ``CANDIDATES``
rows by hashing; every block of queries meets every block of candidates once, in one task of bounded
size. A candidate is sent once per block of queries, which is once per ``QUERIES`` queries.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUERIES = 2048
CANDIDATES = 16_384
STEP = 8
SCALE = 1024.0


def scaled(col: str) -> Column:
    """floor(1024 * x) of each component as bigint."""
    return F.transform(F.col(col).cast("array<double>"), lambda x: F.floor(x * SCALE))


def usable(col: str) -> Column:
    """Not null, and no null, NaN or infinite component."""
    good = F.forall(F.col(col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(col).isNotNull() & good


def rest_norms(v: np.ndarray) -> np.ndarray:
    """For rows of dimensions: the norm of what lies at or after each step, rounded up."""
    square = np.cumsum((v.astype(float) ** 2)[::-1], axis=0)[::-1]
    return np.sqrt(square) * (1 + 1e-9)


def best_of_block(queries: np.ndarray, q_ids: np.ndarray, block: np.ndarray, ids: np.ndarray, k: int, step: int = STEP):
    """(query number, row of the block, score) of each query's k best; ``queries`` is (queries,
    dimensions), ``block`` is vertical: (dimensions, rows), in the order of ids. All int64."""
    dims = block.shape[0]
    norms, q_norms = rest_norms(block), rest_norms(queries.T)
    found = []
    for q in range(len(queries)):
        alive = np.flatnonzero(ids != q_ids[q])
        part, score = None, np.zeros(len(alive), np.int64)
        for at in range(0, dims, step):
            rows = block[at:at + step] if len(alive) == block.shape[1] else block[at:at + step, alive]
            score = score + queries[q, at:at + step] @ rows
            after = at + step
            if after >= dims or len(alive) <= k:
                continue
            slack = norms[after, alive] * q_norms[after, q] + 1
            least = np.partition(score - slack, len(alive) - k)[len(alive) - k]
            keep = score + slack >= least
            if not keep.all():
                alive, score = alive[keep], score[keep]
        if len(alive) > k:
            edge = np.partition(score, len(alive) - k)[len(alive) - k]
            keep = score >= edge
            alive, score = alive[keep], score[keep]
        order = np.lexsort((ids[alive], -score))[:k]
        part = alive[order]
        found.append((np.full(len(part), q), part, score[order]))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
          queries_per_block: int = QUERIES, candidates_per_block: int = CANDIDATES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` the k
    other vectors of highest integer inner product, ties to the smaller id.

    Vectors that are null, hold a null or non-finite component, or have no id take no part; a
    vector only meets vectors of its own length, an empty one scores 0. Repeated rows of a query id
    ask as one query (of different vectors the shortest, then smallest) and are not answers to it; repeated rows of another id are answers of their own.
    Scores must fit in 64 bits. Other columns are not read.
    """

    def run(key, asked, offered):
        import pandas as pd

        names = ["query_id", "vec_id", "score"]
        if not len(asked) or not len(offered):
            return pd.DataFrame({n: pd.Series([], dtype="int64") for n in names})
        offered = offered.sort_values("id", kind="stable")
        ids, q_ids = offered["id"].to_numpy(np.int64), asked["id"].to_numpy(np.int64)
        dims = key[0]
        block = np.ascontiguousarray(np.array(offered["v"].tolist(), np.int64).reshape(len(ids), dims).T)
        q, row, score = best_of_block(np.array(asked["v"].tolist(), np.int64).reshape(len(q_ids), dims), q_ids, block, ids, k)
        return pd.DataFrame({"query_id": q_ids[q], "vec_id": ids[row], "score": score})

    good = (vectors.where(F.col(id_col).isNotNull() & usable(vector_col))
            .select(F.col(id_col).cast("bigint").alias("id"), scaled(vector_col).alias("v")).withColumn("dims", F.size("v")))
    asked = (good.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("dims", "v")).alias("x"))
             .select("id", "x.v", "x.dims"))
    sizes = good.agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()  # q: at least the queries
    q_blocks = max(1, -(-sizes["q"] // queries_per_block))
    c_blocks = max(1, -(-sizes["n"] // candidates_per_block))

    def dealt(frame, own, copies, own_name, other_name):
        # by the row, not by the id, which very many rows may share
        placed = frame.withColumn(own_name, F.pmod(F.xxhash64("id", F.monotonically_increasing_id(), F.lit(own_name)), F.lit(own)).cast("int"))
        return placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other_name))

    keys = ["dims", "qb", "cb"]
    left = dealt(asked, q_blocks, c_blocks, "qb", "cb").groupBy(*keys)
    right = dealt(good, c_blocks, q_blocks, "cb", "qb").groupBy(*keys)
    best = left.cogroup(right).applyInPandas(run, "query_id bigint, vec_id bigint, score bigint")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
