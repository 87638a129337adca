"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link when they differ in at most ``RADIUS`` = 2 bits. Over two halves the bits
that differ lie (0, up to 2) or (1, 1); over the two quarters of a half up to two bits leave one quarter
with at most one. So linked fingerprints share one of 128 keys: a half whole and a quarter of the
other half with one bit wiped out (64 keys), or the lower half with one bit wiped out and a whole quarter
of the upper one (64 keys). Such one-wildcard variants of 47 bits are the index, joined by equality and
verified on the whole fingerprint.

Equal fingerprints are one node from the start. The fingerprints of a key, which agree in 47 bits, are
compared pair by pair up to ``PAIRED`` of them. Of more (the copies of one much edited text), all are
indexed once again with any two of the 64 bits wiped out: the fingerprints under such a key (four at
most) are linked to each other, one star per key. Both ways are exact; the bound is where they cost the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import free_name, small_batches, text_bytes
from ledgerfold.llm.components import connected_components
from ledgerfold.sources.scratch import written

WORDS = 3
SEED = 42
RADIUS = 2
PAIRED = 512
SLICE = 1 << 16


def simhash_of(text: bytes, words: int = WORDS) -> int:
    """Majority of the bits of the XXH64 of all word shingles, repeats included; as an unsigned
    number. Words are runs without ASCII white space, A-Z lower-cased; fewer words than a shingle
    are one shingle, no word gives zero."""
    import numpy as np
    import xxhash

    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_digest
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    ends = ends[words - 1:].tolist()
    votes, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, SLICE):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + SLICE], ends[at:at + SLICE])])
        votes += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row, fp as a signed 64-bit number."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = np.array([simhash_of(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, fp bigint")


def bits_apart(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def one_wildcard_keys() -> Column:
    """The 128 keys of ``fp``: number of the kind and the 47 bits that stay, hashed to one number."""
    half = "(shiftrightunsigned(fp, {}) & 4294967295L)"
    quarter = "(shiftrightunsigned(fp, {}) & 65535L)"
    kinds = [f"transform(sequence(0, 15), b -> xxhash64({kind}, b, {half.format(32 * h)}, {quarter.format(32 * (1 - h) + 16 * q)} & ~shiftleft(1L, b)))"
             for kind, (h, q) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)])]
    kinds += [f"transform(sequence(0, 31), b -> xxhash64({4 + q}, b, {half.format(0)} & ~shiftleft(1L, b), {quarter.format(32 + 16 * q)}))" for q in (0, 1)]
    return F.expr(f"concat({', '.join(kinds)})")


def links(nodes: DataFrame, paired: int = PAIRED) -> DataFrame:
    """(a, b), a < b: enough links between the different fingerprints ``nodes.fp`` to connect
    exactly those that the radius connects; every row is a true link."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # 128 keys come from 8 bytes: spread the rows by a fixed number before they are multiplied; by a
    # hash, since the planner would take out a second partitioning by the column itself.
    variants = nodes.repartition(tasks, F.xxhash64("fp")).select("fp", F.explode(one_wildcard_keys()).alias("key"))
    buckets = written(
        variants.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"),
        "buckets")
    close = bits_apart("a", "b") <= RADIUS
    twos = buckets.where("n = 2").select("a", "b").where(close)
    members = written(
        variants.join(buckets.where("n > 2").select("key", "n").hint("merge"), "key").select("key", "n", "fp"), "members")
    few = members.where(F.col("n") <= paired).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("m"))
    pairs = few.select(F.explode(F.expr("""flatten(transform(m, (x, i) ->
        transform(filter(slice(m, i + 2, size(m)), y -> bit_count(x ^ y) <= %d), y -> struct(x as a, y as b))))""" % RADIUS)
    ).alias("p")).select("p.a", "p.b")
    many = members.where(F.col("n") > paired).select("fp").distinct().select("fp", F.explode(F.expr("sequence(0, 62)")).alias("i"))
    masks = F.expr("transform(sequence(i + 1, 63), j -> shiftleft(1L, i) | shiftleft(1L, j))")
    stars = (many.repartition(tasks).select("fp", F.explode(masks).alias("mask"))
             .groupBy("mask", F.expr("fp & ~mask").alias("rest")).agg(F.collect_list("fp").alias("m"))
             .where("size(m) > 1").select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a <> b"))
    return twos.union(pairs).union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own included. A null text
    is empty; texts without a word have fingerprint zero and link like any other; repeated rows are
    each returned; rows without a doc_id are returned with the component of their fingerprint,
    which is null if no row in it has a doc_id. Other columns of ``docs`` are not read.
    """
    printed = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    parts = connected_components(links(nodes.select("fp")))
    placed = nodes.join(parts, nodes.fp == parts.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    placed = written(placed, "placed")
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = placed.join(names, "root").select("fp", "component_id")
    return printed.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component; of repeated rows of that
    document all stay. Rows without a doc_id stay only where their component has no doc_id."""
    gone = free_name("_gone", docs.columns)
    found = near_duplicates(docs, id_col, text_col)
    rest = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(rest, F.col(id_col).eqNullSafe(F.col(gone)), "left_anti")
