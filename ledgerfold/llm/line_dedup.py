"""Line deduplication by an exact set-similarity join, in DataFrame expressions only.

A line is the set of its lower-cased words. It is removed when an earlier line of the corpus, in
the order of doc_id and line number, has a set of Jaccard similarity ``NUM``/``DEN`` = 0.8 or more.

1. Word counts of the whole corpus are added up in ``BUCKETS`` hash buckets, a constant of fixed
   size in the plan: the rarity of a word is the level of its bucket. Any fixed order of words gives the same
   result; a good one makes the prefixes below rare.
2. Lines are coded once, words ordered from rare to frequent, and written: the key of the set, its
   size, a parity signature (64 bits, 128 of long sets; two sets differ in at least as many words as signatures in
   bits) and its prefix, 32 bits of each of the rarest size - ceil(0.8 size) + 1 words. Similar sets share a word of
   their prefixes.
3. Equal sets are one row, placed at their first line.
4. Leaders: every set meets the first ``LEADERS`` sets of each word of its short prefix (below). Near copies of one
   much repeated line find one of their originals here, whichever of their words were replaced, so that
   few of a group are left to be compared pair by pair.
5. Sets without a match so far meet all earlier sets on prefix words, under the length, positional
   and signature filters; what passes is verified on the words. Of two similar sets the longer one has a word of its
   prefix in the short prefix of the other, size - ceil(8/9 size) + 1 words: an overlap of 4/9 of both sizes is at
   least 8/9 of the shorter one. So the pairs are those of a prefix and a short prefix, of sets in the same class of sizes;
   a short prefix is in the classes of all sizes that its set may meet, two at most.

The last step takes the prefix words in ``SLICES`` parts, one after the other, so that only one part's shuffle
files are there at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import free_name, whole_text
from ledgerfold.sources.scratch import written

NUM, DEN = 4, 5
BUCKETS = 1 << 18
LEADERS = 2
SLICES = 4
CLASS = (DEN / NUM) ** 2  # ratio of the bounds of a class of sizes
MOST_CLASSES = 64  # an array has less than 2^31 words
LONG = 64  # words of a set that 64 bits do not tell from others
PLAN_TEXT, PLAN_TEXT_DEFAULT = "spark.sql.maxPlanStringLength", "2147483632b"


def split_words(line: Column) -> Column:
    """Lower-cased words between white space (that of the pattern ``\\s``), empty ones among them. Splitting at single
    spaces takes half the time of splitting at a pattern, so other white space is made a space where there is any."""
    spaced = F.when(line.rlike(r"[\t\n\x0B\f\r]"), F.regexp_replace(line, r"\s", " ")).otherwise(line)
    return F.split(F.lower(spaced), " ")


def words_of(line: Column) -> Column:
    return F.array_remove(split_words(line), "")


def rarity_levels(texts: DataFrame) -> Column:
    """Constant array: for each hash bucket the level (4 log2 of the count) of its words. The counts are over all
    texts; what the driver passes on is one byte per bucket."""
    spark = texts.sparkSession
    words = texts.select(F.explode(split_words(F.replace(F.col("_text"), F.lit("\n"), F.lit(" ")))).alias("w")).where("w != ''")
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).alias("id")).agg(F.count("*").alias("n"))
    level = F.coalesce(F.least(F.floor(4 * F.log2("n")), F.lit(127)), F.lit(0)).alias("level")
    row = (spark.range(BUCKETS).join(counts, "id", "left").select("id", level)
           .agg(F.array_sort(F.collect_list(F.struct("id", "level"))).alias("s"))
           .select(F.array_join(F.transform("s", lambda s: s["level"].cast("string")), ",")).first())
    if spark.conf.get(PLAN_TEXT) == PLAN_TEXT_DEFAULT:
        spark.conf.set(PLAN_TEXT, "100000")  # the array is not for printing with every plan
    return F.split(F.lit(row[0]), ",").cast("array<tinyint>")


def coded_lines(texts: DataFrame) -> DataFrame:
    """(doc, line, hash, k1, k2, n, sig, high, prefix) of every line that has a word; texts: (doc, _text)."""
    levels = rarity_levels(texts)

    def code(h):
        level = levels[h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")]  # never null, so the codes are sorted as plain numbers
        return F.shiftleft(level.cast("bigint"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    lines = texts.select("doc", F.posexplode(F.split("_text", "\n")).alias("line", "_line")).where(F.col("_line").rlike(r"\S"))
    # The higher-order functions are innermost: what stands inside one is interpreted too.
    codes = F.transform(F.transform(split_words(F.col("_line")), lambda w: F.xxhash64(w)), code)
    sets = lines.select("doc", "line", F.xxhash64("_line").alias("hash"), F.array_remove(
        F.sort_array(F.array_distinct(codes)), code(F.xxhash64(F.lit("")))).alias("codes"))
    n = F.size("codes")

    def parity(bit):
        return F.aggregate("codes", F.lit(0).cast("bigint"), lambda s, c: s.bitwiseXOR(
            F.call_function("shiftleft", bit(c), c.bitwiseAND(F.lit(63)).cast("int"))))

    rarest = F.slice("codes", F.lit(1), n - F.expr(f"cast((size(codes) * {NUM} + {DEN - 1}) div {DEN} as int)") + 1)
    return sets.select(
        "doc", "line", "hash", F.xxhash64("codes").alias("k1"), F.xxhash64(F.lit(1), "codes").alias("k2"), n.alias("n"),
        parity(lambda c: F.lit(1).cast("bigint")).alias("sig"),
        F.when(n > LONG, parity(lambda c: F.shiftrightunsigned(c, 6).bitwiseAND(F.lit(1)))).alias("high"),
        F.transform(rarest, lambda c: F.shiftright(F.shiftleft(c, 32), 32).cast("int")).alias("prefix"))


def could_match(a: str, b: str) -> Column:
    """Length and signature filters on two sets."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    both, high = (F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")) for c in ("sig", "high"))
    # Jaccard t needs an overlap of t / (1 + t) of both sizes together. ``sig`` is the parity of both halves of the signature:
    # it differs in no more bits than they do, and is compared first. Short sets have no second half.
    most = (n + m) * (DEN - NUM)
    return ((n * DEN >= m * NUM) & (m * DEN >= n * NUM) & (F.bit_count(both) * (NUM + DEN) <= most)
            & F.coalesce((F.bit_count(both.bitwiseXOR(high)) + F.bit_count(high)) * (NUM + DEN) <= most, F.lit(True)))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (doc, line) of pairs (doc, line, edoc, eline, both) that are similar by their words; ``both``
    is the number of words of the two sets. Texts are
    met by document; only the lines asked for are cut out of them."""
    pairs = written(pairs, "pairs")
    asked = (pairs.select("doc", "line").union(pairs.select("edoc", "eline"))
             .groupBy(F.col("doc").alias("_doc")).agg(F.collect_set("line").alias("_lines")))
    # Texts outgrow any broadcast, and so do the lines asked for; small tables take the same plan.
    lines = written(
        texts.join(asked.hint("shuffle_hash"), F.col("doc").eqNullSafe(F.col("_doc")))
        .select("doc", "_lines", F.split("_text", "\n").alias("_all"))
        .select("doc", "_all", F.explode("_lines").alias("line")).where("line < size(_all)")
        .select("doc", "line", F.get("_all", F.col("line")).alias("t")).distinct(), "asked")
    own, early = lines.alias("o"), lines.alias("e")
    joined = (pairs.alias("p")
              .join(own, F.col("p.doc").eqNullSafe(F.col("o.doc")) & (F.col("p.line") == F.col("o.line")))
              .join(early, F.col("p.edoc").eqNullSafe(F.col("e.doc")) & (F.col("p.eline") == F.col("e.line"))))
    shared = F.size(F.array_intersect(words_of(F.col("o.t")), words_of(F.col("e.t"))))
    return joined.where(shared * (NUM + DEN) >= F.col("both") * NUM).select("p.doc", "p.line").distinct()


def size_class(n: Column) -> Column:
    """Number of the class of a size; it never falls as sizes grow."""
    return F.floor(F.log(CLASS, n)).cast("int")


def short_prefix() -> Column:
    """The words of the prefix that the shorter one of two similar sets needs; all of sets as long as each other."""
    return F.slice("prefix", F.lit(1), F.col("n") - F.expr(f"cast((n * {2 * NUM} + {NUM + DEN - 1}) div {NUM + DEN} as int)") + 1)


def leaders(sets: DataFrame) -> DataFrame:
    """(doc, line, edoc, eline, both) of sets and the first sets that share a word of their short prefixes."""
    rows = sets.select(F.struct("doc", "line", "n", "sig", "high").alias("s"), F.explode(short_prefix()).alias("token"))
    group = Window.partitionBy("token").orderBy(F.col("s.doc").asc_nulls_first(), "s.line")
    first = rows.select("s", F.array(*[F.nth_value("s", k + 1).over(group) for k in range(LEADERS)]).alias("_first"))
    return (first.select("s", F.explode("_first").alias("e"))
            .where(F.col("e").isNotNull() & could_match("s", "e") & (F.struct("e.doc", "e.line") < F.struct("s.doc", "s.line")))
            .select("s.doc", "s.line", F.col("e.doc").alias("edoc"), F.col("e.line").alias("eline"), (F.col("s.n") + F.col("e.n")).alias("both")))


def earlier_sets(sets: DataFrame, asked: Column) -> DataFrame:
    """(doc, line, edoc, eline, both) of open sets and all earlier sets that share one of the asked tokens."""
    def rows(prefix, most):
        tokens = sets.select("doc", "line", "n", "sig", "high", "open", size_class(F.col("n")).alias("low"), size_class(most).alias("top"),
                             F.posexplode(prefix).alias("pos", "token")).where(asked)
        classes = tokens.select("doc", "line", "n", "sig", "high", "open", "pos", "token", F.explode(F.sequence("low", "top")).alias("class"))
        # one number: rows are sorted by it without comparing them
        return classes.withColumn("key", F.col("token").cast("bigint") * MOST_CLASSES + F.col("class")).drop("token", "class")

    # A set no longer than its match has the short prefix, whichever of them comes first.
    long, short = rows(F.col("prefix"), F.col("n")).alias("l"), rows(short_prefix(), F.expr(f"n * {DEN} div {NUM}")).alias("r")
    n, m = F.col("l.n"), F.col("r.n")
    left_over = F.least(n - F.col("l.pos"), m - F.col("r.pos"))
    later = F.struct("r.doc", "r.line") < F.struct("l.doc", "l.line")

    def of(a, b, name):
        return F.when(later, F.col(f"{a}.{name}")).otherwise(F.col(f"{b}.{name}"))

    return (long.join(short, F.col("l.key") == F.col("r.key"))
            .where((n >= m) & could_match("l", "r") & (left_over * (NUM + DEN) >= (n + m) * NUM)
                   & ((n > m) | later) & (of("l", "r", "open") == 1))
            .select(of("l", "r", "doc").alias("doc"), of("l", "r", "line").alias("line"),
                    of("r", "l", "doc").alias("edoc"), of("r", "l", "line").alias("eline"), (n + m).alias("both")))


def repeated_sets(sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, line) of the sets (doc, line, n, sig, high, prefix) that resemble an earlier set."""
    found = written(verified(leaders(sets).distinct(), texts), "led")
    marked = sets.join(found.select(F.col("doc").alias("_d"), F.col("line").alias("_l"), F.lit(False).alias("_open")),
                       F.col("doc").eqNullSafe(F.col("_d")) & (F.col("line") == F.col("_l")), "left")
    marked = marked.select("doc", "line", "n", "sig", "high", "prefix", F.col("_open").isNull().cast("int").alias("open"))
    marked = written(marked, "marked")
    parts = [written(earlier_sets(marked, F.pmod("token", F.lit(SLICES)) == k).distinct(), "earlier") for k in range(SLICES)]
    return written(found.union(verified(reduce(DataFrame.union, parts).distinct(), texts)), "repeated")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, line, hash): the lines to remove, numbered from 0, each with the hash of its text.

    Lines without a word are never removed. Repeated rows of a document are one place each line:
    they do not remove each other. Rows of one doc_id with different texts compete only with other
    doc_ids and line numbers; the hash says which of the texts is meant. A null text has no line, a
    null doc_id comes before all others and its rows are one document.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), whole_text(text_col).alias("_text"))
    lines = written(coded_lines(texts), "lines")
    sets = written(
        lines.groupBy("k1", "k2").agg(F.min(F.struct("doc", "line", "n", "sig", "high", "prefix")).alias("s"), F.count("*").alias("c"))
        .select("k1", "k2", "c", "s.*"), "sets")
    found = repeated_sets(sets.drop("k1", "k2", "c"), texts)
    marked = sets.select("k1", "k2", "c", F.col("doc").alias("fdoc"), F.col("line").alias("fline")).join(
        found.select(F.col("doc").alias("_d"), F.col("line").alias("_l"), F.lit(True).alias("gone")),
        F.col("fdoc").eqNullSafe(F.col("_d")) & (F.col("fline") == F.col("_l")), "left").where((F.col("c") > 1) | F.col("gone")).select("k1", "k2", "fdoc", "fline", "gone")
    own = F.col("doc").eqNullSafe(F.col("fdoc")) & (F.col("line") == F.col("fline"))
    return (lines.select("k1", "k2", "doc", "line", "hash").join(marked, ["k1", "k2"])
            .where(F.coalesce("gone", F.lit(False)) | ~own).select("doc", "line", "hash").distinct())


def marks_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _marks): per document the (line, hash) to remove."""
    return removed_lines(docs, id_col, text_col).groupBy(F.col("doc").alias("_doc")).agg(
        F.collect_list(F.struct("line", "hash")).alias("_marks"))


def meant_lines(hash_at, marks_col: str = "_marks") -> Column:
    """Of _marks the numbers of the lines that have the marked text; ascending."""
    marks = F.coalesce(marks_col, F.array().cast("array<struct<line:int,hash:bigint>>"))
    return F.sort_array(F.transform(F.filter(marks, lambda m: hash_at(m["line"]) == m["hash"]), lambda m: m["line"]))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed_lines (numbers from 0). Texts
    are not shuffled for it, only a hash per line."""
    hashes = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                         F.transform(F.split(whole_text(text_col), "\n"), lambda t: F.xxhash64(t)).alias("_hashes"))
    met = hashes.join(marks_of(docs, id_col, text_col), F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    gone = met.select("doc_id", F.size("_hashes").alias("n_lines"), meant_lines(lambda i: F.get("_hashes", i)).alias("removed_lines"))
    return gone.select("doc_id", "n_lines", F.size("removed_lines").alias("n_removed"), "removed_lines")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` without their repeated lines, and with n_chars (if there) counted anew.
    A text that loses every line is empty; a row without removals is unchanged, null text included."""
    doc, marks, lines, gone = (free_name(n, docs.columns) for n in ("_doc", "_marks", "_lines", "_gone"))
    marked = marks_of(docs, id_col, text_col).select(F.col("_doc").alias(doc), F.col("_marks").alias(marks))
    met = docs.join(marked, F.col(id_col).cast("bigint").eqNullSafe(F.col(doc)), "left").withColumn(lines, F.split(whole_text(text_col), "\n"))
    met = met.withColumn(gone, meant_lines(lambda i: F.xxhash64(F.get(lines, i)), marks))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")
    changed = F.size(gone) > 0
    new = {text_col: F.when(changed, rest).otherwise(F.col(text_col))}
    if chars_col in docs.columns:
        new[chars_col] = F.when(changed, F.char_length(rest).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col))
    return met.withColumns(new).select(*docs.columns)
