"""SimHash near-duplicates against a plain computation."""

import random

import pytest
import xxhash

from ledgerfold.llm import near_dup
from ledgerfold.llm.components import connected_components


def plain_simhash(text):
    words = [w for w in _split((text or "").translate({c: c + 32 for c in range(65, 91)}))]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _split(text):
    word = ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                yield word
            word = ""
        else:
            word += c


def plain_components(values, close):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if close(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


TEXTS = ["a b c d", "A  b\tC d", "", None, " \n ", "one", "one two", "One two", "x y z", "Ä b c", "ä b c",
         "w " * 5000, "w " * 5000, "the same line\nthe same line", "the same line the same line"]


def test_contract_rows(spark):
    docs = spark.createDataFrame([(100 - i, t, "fp") for i, t in enumerate(TEXTS)] + [(None, "one", "x"), (100, "a b c d", "y")],
                                 "doc_id bigint, text string, component_id string")
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS) + 2
    prints = {100 - i: plain_simhash(t) for i, t in enumerate(TEXTS)}
    root = plain_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for d, p in prints.items():
        first[root[p]] = min(first.get(root[p], d), d)
    for row in got:
        p = prints[row.doc_id] if row.doc_id is not None else plain_simhash("one")
        assert row.fingerprint == f"{p:016x}" and row.component_id == first[root[p]]


def test_empty_table(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_every_close_pair_shares_a_key(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(2)]
    near = [x ^ (1 << i) ^ (1 << j) for x in base for i in range(64) for j in range(i, 64)]  # i = j: the base
    signed = sorted({p - 2**64 if p >= 2**63 else p for p in [*base, *near]})
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    keys = {r.fp: set(r.k) for r in frame.select("fp", near_dup.one_wildcard_keys().alias("k")).collect()}
    assert all(len(k) == 128 for k in keys.values())
    for x in base:
        own = keys[x - 2**64 if x >= 2**63 else x]
        assert all(own & keys[p] for p in signed if ((p ^ x) & (2**64 - 1)).bit_count() <= 2)


def test_rows_are_spread_before_they_are_multiplied(spark):
    nodes = spark.range(50).selectExpr("id % 40 AS fp").groupBy("fp").count().select("fp")
    plan = nodes.repartition(5, near_dup.F.xxhash64("fp")).select("fp", near_dup.F.explode(near_dup.one_wildcard_keys()).alias("key"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(xxhash64(" in text and "REPARTITION_BY_NUM" in text


@pytest.mark.parametrize("paired", [2, 512])
def test_links_connect_what_the_radius_connects(spark, paired):
    rng, prints = random.Random(3), {0, 2**64 - 1, 1 << 63}
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(30):
            value = base
            for _ in range(rng.randrange(4)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    signed = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    found = near_dup.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), paired).collect()
    assert found and all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in found)
    want = plain_components(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    got = plain_components(signed, lambda a, b, has={frozenset((r.a, r.b)) for r in found}: frozenset((a, b)) in has)
    assert got == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 600)] + [(7, 3), (7, 7), (9, 9)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 600)}, 3: 3, 7: 3}


def test_keep_first(spark):
    docs = spark.createDataFrame([(3, "a b c d"), (1, "A B C D"), (2, "something else entirely here"), (1, "A B C D")],
                                 "doc_id bigint, text string")
    assert sorted(r.doc_id for r in near_dup.keep_first(docs).collect()) == [1, 1, 2]
