"""Ranked search against a plain one."""

import math
import random
import re

import pytest

from ledgerfold.llm import ranked

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, k):
    texts = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    texts = [(d, t) for d, t in texts if t]
    total, words = len(texts), sum(len(t) for _, t in texts)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for i, terms in asked.items():
        weight = {}
        for t in terms:
            df = sum(t in x for _, x in texts)
            weight[t] = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
        scored = []
        for d, x in texts:
            m = 10 + 90 * len(x) * total // words
            scored.append((sum(w * (10**9 * x.count(t) // (1000 * x.count(t) + 8 * m)) for t, w in weight.items()), d))
        scored = sorted((s for s in scored if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(i, r + 1, d, s) for r, (s, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def words(rng, n):
    return " ".join("w%d" % min(rng.randrange(60), rng.randrange(60)) for _ in range(n))


@pytest.mark.parametrize("docs_of_block, window, short, asked", [(1 << 15, 1 << 12, 64, 10**6), (40, 7, 4, 10**6), (9, 3, 1, 20)])
def test_rows(spark, monkeypatch, docs_of_block, window, short, asked):
    monkeypatch.setattr(ranked, "DOCS", docs_of_block)
    monkeypatch.setattr(ranked, "WINDOW", window)
    monkeypatch.setattr(ranked, "SHORT", short)
    rng = random.Random(6)
    docs = [(rng.randrange(500), words(rng, rng.randrange(1, 60))) for _ in range(300)]
    docs += docs[:9] + [(1000, None), (1001, ""), (1002, " .,! "), (None, "w1 W2 w3"), (None, None), (7, "Ä ä É1-é2 " * 3), (8, "w0 " * 5000), (9, "x" * 50_000)]
    items = [(i, words(rng, 12)) for i in range(12)] + [(3, "w1 extra"), (20, None), (21, ""), (22, "nowhere"), (23, "ä É1"), (None, "w5 w6")]
    frame = spark.createDataFrame([(d, t, "c", 1) for d, t in docs], "doc_id bigint, text string, score string, n int").repartition(4)
    got = ranked.rank_documents(frame, spark.createDataFrame(items, "item_id bigint, text string"), k=10, asked=asked).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(docs, items, 10)


def test_lists_are_skipped():
    """With nine good documents known, the long list brings nothing: it is only looked up."""
    import numpy as np

    n = 20_000
    block_terms = np.concatenate([np.zeros(n, np.int64), np.ones(20, np.int64)])
    doc_sizes = np.ones(n, np.int64)
    doc_sizes[:20] = 2
    terms = np.concatenate([np.tile([0, 1], 20), np.zeros(n - 20, np.int64)])
    block = ranked.Block(np.arange(n), np.ones(n, bool), np.full(n, 5), doc_sizes, terms, np.ones(n + 20, np.int64), n, 5 * n)
    assert len(block_terms) == len(terms)
    best, read = ranked.Best(10), []
    rows = ranked.Long.rows
    ranked.Long.rows = lambda self, window: (read.append((type(self).__name__, window)), rows(self, window))[1]
    try:
        block.search(np.array([0, 1]), np.array([1, 5000]), best)
    finally:
        ranked.Long.rows = rows
    assert best.doc.tolist() == list(range(10)) and ("Long", 1) not in read


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    got = ranked.rank_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
