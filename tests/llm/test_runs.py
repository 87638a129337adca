"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ledgerfold.llm import runs
from ledgerfold.llm.queries import op11_periodic_runs


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            u, v = i, j + q
            if v - u >= max(6, 4 * q) and not any(all(words[x] == words[x + p] for x in range(u, v - p)) for p in range(1, q)):
                out.append((u, v - u, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join("%d,%d,%d\n" % r for r in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def words_at_random(rng):
    n, kinds = rng.randrange(90), rng.choice([1, 2, 3, 9])
    words = [rng.randrange(kinds) for _ in range(n)]
    if n > 10 and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randrange(1, 9)
        words[a:a] = (words[a:a + p] * n)[:rng.randrange(n)]
    return words


def test_blocks_of_texts():
    rng = random.Random(1)
    for _ in range(150):
        texts = [words_at_random(rng) for _ in range(rng.randrange(1, 6))]
        texts += texts[:rng.randrange(3)]
        ids, sizes = np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts])
        got = list(zip(*[x.tolist() for x in runs.runs_of(ids, sizes)]))
        begins = [0, *np.cumsum(sizes).tolist()]
        assert got == [(s + b, s + n + b, q) for t, b in zip(texts, begins) for s, n, q in plain_runs(t)]


def test_one_very_periodic_text():
    ids = np.array([0, 1, 1, 2] * 50_000 + [3] * 50_000, np.int64)
    got = list(zip(*[x.tolist() for x in runs.runs_of(ids, np.array([len(ids)]))]))
    assert got == [(0, 200_000, 4), (200_000, 250_000, 1)]


def test_rules_spell_their_text():
    rng = random.Random(4)
    ids = np.array([rng.randrange(5) for _ in range(3000)], np.int64)
    sizes = np.array([1000, 0, 1, 1999])
    grammar = runs.Grammar(ids, sizes)
    assert len(grammar.node_rule) == 999 + 1998 and len(grammar.size) < len(grammar.node_rule)
    for rule, start in zip(grammar.node_rule.tolist(), grammar.node_start.tolist()):
        n, first = int(grammar.size[rule]), int(grammar.first[rule])
        assert (ids[start:start + n] == ids[first:first + n]).all()


TEXTS = [None, "", " \n\t", "one", "a a a a a a", "a a a a a", "x a b a b a b a b y", "a\x0bb\x0ca\rb a b a b", "Ä ä Ä ä Ä ä Ä ä",
         "a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a", "w " * 5000, "u v w " * 2000 + "x", "a a a a a a"]


@pytest.mark.parametrize("block", [3, runs.BLOCK])
def test_rows(spark, block):
    rows = [(i, t, "n") for i, t in enumerate(TEXTS * 4)] + [(None, "b b b b b b b", "n"), (4, "a a a a a a", "m")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    got = runs.run_digests(runs.find_runs(docs, edit=runs.with_repeated_tail, block=block)).collect()
    assert len(got) == len(rows)
    key = {}
    for i, t, _ in rows:
        if i is not None and len(t or "") < 5000:
            key[i] = plain_row(i, t)
    for r in got:
        if r.doc_id in key:
            assert tuple(r) == key[r.doc_id]
    assert [(r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in got if r.doc_id is None] == [(1, 0, 7, 1, 7000)]


def test_empty_table(spark):
    assert runs.find_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query_on_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {r.doc_id: plain_row(r.doc_id, r.text) for r in docs if r.n_chars < 6000}
    got = op11_periodic_runs(spark, sf).collect()
    assert len(got) == len(docs) and len(want) > 150 and any(r.n_runs for r in got)
    for r in got:
        if r.doc_id in want:
            assert tuple(r) == want[r.doc_id]
