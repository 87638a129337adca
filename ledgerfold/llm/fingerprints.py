"""SimHash fingerprints of 128 bits, in DataFrame expressions only.

A term is a word and the one behind it (lower case); its weight is its length, at most ``HEAVIEST``,
since long pairs are rare ones. Each of the 128 bits of the term's hash votes with the weight for or
against the same bit of the fingerprint. Terms are exploded and added up inside the task that holds
the text, so they are never shuffled: four votes to a 64-bit sum over runs of ``RUN`` terms, which is as far as
15 bits hold, then two to a sum over the runs of a text.

``within_radius`` finds all fingerprints near given ones: the bits are permuted into radius + 1
tables that each begin with another block; fingerprints within the radius agree on one whole block,
so an equality join on (table, leading block) followed by a count of differing bits misses none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfold.llm.common import whole_text
from ledgerfold.sources.scratch import written

BITS = 128
HEAVIEST = 32
RADIUS = 3
LANES, PAIRS = 0x0001000100010001, 0x0000FFFF0000FFFF
RUN = 0x7FFF // HEAVIEST


def terms(text: str) -> Column:
    """Array of (h, g, w): both halves of the hash, and the weight, of each word and its successor."""
    words = F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != "")
    return F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.struct(
        F.xxhash64(a, b).alias("h"), F.xxhash64(a, b, a).alias("g"),
        F.least(F.char_length(a) + F.coalesce(F.char_length(b), F.lit(0)), F.lit(HEAVIEST)).cast("bigint").alias("w")))


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, hi, lo): the fingerprint of each text as two longs, zero without a word. Texts under the
    same keys vote together."""
    votes = texts.select(*keys, F.posexplode_outer(terms(text)).alias("_at", "t")).select(
        *keys, F.floor(F.col("_at") / RUN).alias("_run"), F.col("t.h").alias("_h"), F.col("t.g").alias("_g"), F.col("t.w").alias("_w"))
    four = [F.sum(F.shiftrightunsigned(half, k).bitwiseAND(F.lit(LANES)) * F.col("_w")).alias(f"{half}{k}") for half in ("_h", "_g") for k in range(16)]
    runs = votes.groupBy(*keys, "_run").agg(F.sum("_w").alias("total"), *four)
    # bits k and k + 32, and bits k + 16 and k + 48, of each half
    two = [F.sum(F.shiftrightunsigned(f"{half}{k}", shift).bitwiseAND(F.lit(PAIRS))).alias(f"{half}{k + shift}")
           for half in ("_h", "_g") for shift in (0, 16) for k in range(16)]
    total = runs.groupBy(*keys).agg(F.sum("total").alias("total"), *two)

    def half_of(half):
        bits = None
        for k in range(64):
            vote = F.col(f"{half}{k % 32}")
            vote = F.shiftrightunsigned(vote, 32) if k >= 32 else vote.bitwiseAND(F.lit(0xFFFFFFFF))
            bit = F.when(vote * 2 > F.col("total"), F.lit(1 << k if k < 63 else -(1 << 63))).otherwise(F.lit(0).cast("bigint"))
            bits = bit if bits is None else bits.bitwiseOR(bit)
        return bits

    return total.select(*keys, half_of("_h").alias("hi"), half_of("_g").alias("lo"))


def as_hex(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def bits_apart(hi: str, lo: str, other_hi: str, other_lo: str) -> Column:
    return (F.bit_count(F.col(hi).bitwiseXOR(F.col(other_hi))) + F.bit_count(F.col(lo).bitwiseXOR(F.col(other_lo)))).cast("int")


def likeness(apart: Column) -> Column:
    """Cosine of the angle that the share of differing bits estimates; 0 from half of the bits on."""
    return F.greatest(F.lit(0.0), F.when(apart == 0, F.lit(1.0)).otherwise(F.cos(apart * F.lit(3.141592653589793 / BITS))))


KEYS = ["nameless", "doc", "h"]  # no doc_id, doc_id (0 without), hash of the text


def in_order(texts: DataFrame) -> DataFrame:
    """Each different document (KEYS, chars) and the one behind it (n_nameless, n_doc, n_h); the
    first follows the last. The order is a range-partitioned sort, numbered inside its partitions;
    one row per partition says where the next begins."""
    sizes = texts.groupBy(*KEYS).agg(F.max("chars").alias("chars"))
    ranked = written(sizes.orderBy(F.desc("nameless"), "doc", "h").withColumn("at", F.monotonically_increasing_id()), "order")
    runs = ranked.groupBy(F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("low"), F.max("at").alias("high"))
    all_runs = W.partitionBy(F.lit(0))
    turns = runs.select("high", F.coalesce(F.lead("low").over(all_runs.orderBy("part")), F.min("low").over(all_runs)).alias("turn"))
    placed = ranked.join(F.broadcast(turns), F.col("at") == F.col("high"), "left").select(
        *KEYS, "chars", F.coalesce("turn", F.col("at") + 1).alias("after"))
    behind = ranked.select(F.col("at").alias("after"), *[F.col(k).alias("n_" + k) for k in KEYS])
    return written(placed.join(behind, "after").drop("after"), "order")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one
    row per row of ``docs``.

    The edited text is the text whose last floor(n_chars / 4) code points give way to the first as
    many of the next document. Null texts are empty; the fingerprint of a text without words is
    zero. Rows equal in doc_id and text are one document: each returns the same row, and the next
    document is the next different one; different texts of one doc_id follow each other by hash. A
    single document follows itself. Rows without a doc_id come first. Other columns are not read.

    Texts are shuffled once, by document; both joins, and the votes of both texts, use that
    partitioning. Heads of next documents are shuffled back.
    """
    ident = F.col(id_col).cast("bigint")
    base = docs.select(ident.isNull().alias("nameless"), F.coalesce(ident, F.lit(0)).alias("doc"), whole_text(text_col).alias("text"))
    base = base.withColumns({"h": F.xxhash64("text"), "chars": F.char_length("text")})
    order = in_order(base.select(*KEYS, "chars"))
    one = base.groupBy(*KEYS).agg(F.first("text").alias("text"))
    heads = (one.withColumnsRenamed({k: "n_" + k for k in KEYS}).join(order, ["n_" + k for k in KEYS])
             .select(*KEYS, "chars", F.expr("left(text, cast(chars div 4 as int))").alias("head")))
    both = one.join(heads, KEYS).select(
        *KEYS, "chars", "text", F.concat(F.expr("left(text, chars - cast(chars div 4 as int))"), "head").alias("edited"))
    kinds = both.select(*KEYS, "chars", F.sha2("edited", 256).alias("sha"), F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("k"))
    prints = fingerprints(kinds.select(*KEYS, "chars", "sha", "k.kind", "k.t"), [*KEYS, "chars", "sha", "kind"], "t")

    def pick(kind, half):
        return F.max(F.when(F.col("kind") == kind, F.col(half)))

    found = written(prints.groupBy(*KEYS, "chars", "sha").agg(
        pick(0, "hi").alias("hi"), pick(0, "lo").alias("lo"), pick(1, "hi").alias("ehi"), pick(1, "lo").alias("elo")), "prints")
    following = found.select(*[F.col(k).alias("n_" + k) for k in KEYS], F.col("hi").alias("nhi"), F.col("lo").alias("nlo"))
    rows = base.select(*KEYS).join(found, KEYS).join(order.drop("chars"), KEYS).join(following, ["n_" + k for k in KEYS])
    return rows.select(
        F.when(~F.col("nameless"), F.col("doc")).alias("doc_id"), F.col("chars").cast("bigint").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        as_hex(F.col("hi"), F.col("lo")).alias("fingerprint"), as_hex(F.col("ehi"), F.col("elo")).alias("edited_fingerprint"),
        likeness(bits_apart("hi", "lo", "ehi", "elo")).alias("near_edited"), likeness(bits_apart("hi", "lo", "nhi", "nlo")).alias("near_next"))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query_id, doc_id, bits): for each query every fingerprint at most ``radius`` bits away, its
    own id left out. Both frames have id, hi, lo.

    Equal fingerprints are searched once and met again by id at the end, so copies do not multiply
    the candidates. Blocks are 128 / (radius + 1) bits, rounded up.
    """
    blocks = radius + 1
    width = -(-BITS // blocks)

    def keys(hi, lo):
        bits = F.concat(F.lpad(F.bin(hi), 64, "0"), F.lpad(F.bin(lo), 64, "0"))
        return F.array(*[F.struct(F.lit(k).alias("t"), F.substring(bits, k * width + 1, width).alias("b")) for k in range(blocks)])

    def tables(frame, prefix):
        different = frame.select("hi", "lo").distinct()
        return different.select(F.col("hi").alias(prefix + "hi"), F.col("lo").alias(prefix + "lo"),
                                F.explode(keys(F.col("hi"), F.col("lo"))).alias("k")).select(prefix + "hi", prefix + "lo", "k.t", "k.b")

    apart = bits_apart("qhi", "qlo", "dhi", "dlo")
    close = (tables(queries, "q").join(tables(prints, "d"), ["t", "b"]).where(apart <= radius)
             .select("qhi", "qlo", "dhi", "dlo", apart.alias("bits")).distinct())
    asked = queries.select(F.col("id").alias("query_id"), F.col("hi").alias("qhi"), F.col("lo").alias("qlo"))
    found = prints.select(F.col("id").alias("doc_id"), F.col("hi").alias("dhi"), F.col("lo").alias("dlo"))
    return (close.join(asked, ["qhi", "qlo"]).join(found, ["dhi", "dlo"])
            .where(F.col("query_id") != F.col("doc_id")).select("query_id", "doc_id", "bits"))
