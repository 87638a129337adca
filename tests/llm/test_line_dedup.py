"""Line deduplication against a plain program over all pairs of lines."""

import glob
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import line_dedup
from ledgerfold.sources.scratch import written


def plain_removed(docs):
    places = []
    for d, text in docs:
        for i, line in enumerate((text or "").split("\n")):
            words = frozenset(line.lower().split())
            if words:
                places.append((d, i, words, line))
    gone = set()
    for d, i, words, line in places:
        if any((e, j) < (d, i) and len(words & other) * 5 >= 4 * len(words | other) for e, j, other, _ in places):
            gone.add((d, i))
    return gone


def check(spark, docs):
    frame = spark.createDataFrame([(d, t, len(t or ""), "x") for d, t in docs], "doc_id bigint, text string, n_chars int, line string")
    report = {r.doc_id: r for r in line_dedup.line_report(frame).collect()}
    want = plain_removed(docs)
    for d, text in docs:
        lines = (text or "").split("\n")
        gone = sorted(i for e, i in want if e == d)
        assert (report[d].n_lines, report[d].n_removed, report[d].removed_lines) == (len(lines), len(gone), gone), d
    kept = {r.doc_id: r for r in line_dedup.drop_repeated_lines(frame).collect()}
    assert len(kept) == len(docs)
    for d, text in docs:
        rest = "\n".join(x for i, x in enumerate((text or "").split("\n")) if (d, i) not in want)
        assert kept[d].text == (rest if text is not None else None) and kept[d].n_chars == len(rest) and kept[d].line == "x"


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lines(spark, seed):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(4000)]
    pool = [[rng.choice(common if rng.random() < 0.5 else rare) for _ in range(rng.randrange(1, 40))] for _ in range(40)]
    docs = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            words = list(rng.choice(pool))
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(rare)
            lines.append(" ".join(words))
        docs.append((d * 3, "\n".join(lines)))
    check(spark, docs)


def test_odd_texts(spark):
    check(spark, [(1, None), (2, ""), (3, "\n\n"), (4, "A b"), (5, "b  a\n\na B\nlong " + "word " * 3000), (6, "b a a b"),
                  (7, "Été x y"), (8, "été x Y"), (9, "a b c d e"), (10, "a b c d f"), (11, "a b c d e g")])


def test_repeated_rows_and_ids(spark):
    rows = [(None, "one two"), (1, "one two\nthree"), (1, "one two\nthree"), (2, "own line"), (2, "three\nown text"), (3, "own line")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0, r.text) for r in line_dedup.drop_repeated_lines(frame).collect()), key=str)
    assert got == [(0, "one two"), (1, "three"), (1, "three"), (2, "own line"), (2, "own text"), (3, "")]
    assert line_dedup.line_report(frame.limit(0)).count() == 0


def test_long_sets_that_differ_are_not_verified(spark, monkeypatch):
    """Of long lines that share words only those that may be similar have their texts met."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    words = [f"w{i}" for i in range(400)]
    docs = [(d, " ".join(rng.sample(words, 160))) for d in range(60)]
    docs += [(100, " ".join(base)), (101, " ".join(base[:-8])), (102, " ".join(base[60:]))]
    handed, verified = [], line_dedup.verified

    def counted(pairs, texts):
        handed.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(line_dedup, "verified", counted)
    check(spark, docs)
    assert sum(handed) <= 10


def test_near_copies_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies that each have other rare words of their own find an original under the words they share."""
    base = [f"b{i}" for i in range(40)]
    docs = [(d, " ".join([f"own{d}a", f"own{d}b", *base[2:]])) for d in range(200)]
    handed, verified = [], line_dedup.verified

    def counted(pairs, texts):
        handed.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(line_dedup, "verified", counted)
    check(spark, docs)
    assert sum(handed) <= 2 * 2 * 200  # for line_report and for drop_repeated_lines


def test_similar_sets_of_all_sizes_are_found(spark):
    """Pairs just alike enough, the longer one first or last, across the bounds of the classes of sizes."""
    docs = []
    for n in range(1, 61):
        for m in {n, n * 5 // 4, (n + n * 5 // 4) // 2}:
            shared = -(-4 * (n + m) // 9)
            if shared <= n:
                d = 4 * len(docs)
                short, long = ([f"w{d}_{i}" for i in range(shared)] + [f"{k}{d}_{i}" for i in range(size - shared)] for k, size in (("a", n), ("b", m)))
                docs += [(d + len(docs) % 4 // 2, " ".join(short)), (d + 1 - len(docs) % 4 // 2, " ".join(long))]
    check(spark, docs)


def test_sets_of_unlike_sizes_do_not_meet(spark):
    """Under one common prefix word only sets in the same class of sizes meet, and a long set is looked up, not kept, under its later words."""
    def met(n, m):
        rows = [(1, 0, n, 0, None, 1, list(range(n))), (2, 0, m, 0, None, 1, list(range(m)))]
        sets = spark.createDataFrame(rows, "doc bigint, line int, n int, sig bigint, high bigint, open int, prefix array<int>")
        return line_dedup.earlier_sets(sets, F.lit(True)).distinct().count()

    assert [met(n, n * 5 // 4) for n in (4, 8, 40)] == [1, 1, 1] and [met(m * 5 // 4, m) for m in (4, 8, 40)] == [1, 1, 1]
    assert met(8, 11) == met(11, 8) == met(40, 80) == 0
    for n in (1, 4, 9, 47):
        sets = spark.createDataFrame([(n, list(range(n)))], "n int, prefix array<int>")
        assert len(sets.select(line_dedup.short_prefix()).first()[0]) == n - -(-8 * n // 9) + 1


def test_all_white_space_parts_words(spark):
    check(spark, [(1, "a b c d"), (2, "a\tb\x0bc\fd"), (3, "\ta  b\r\nc d\r"), (4, "a\tb\r"), (6, "\t\r\n\x0b")])


def test_shuffle_files_go_with_the_write(spark):
    dirs = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}

    before = files()
    rows = spark.range(20000).select("id", (F.col("id") % 5000).alias("k"))
    frame = written(rows.alias("l").join(rows.alias("r"), "k").where("l.id < r.id").select("l.id", F.col("r.id").alias("e")).distinct(), "pairs")
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.5)
    assert not files() - before and frame.count() == 30000
