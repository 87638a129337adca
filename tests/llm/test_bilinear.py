"""Scores of the log-bilinear model: exact counts and base scores, normalisation, gain on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerfold.llm import bilinear as B
from tests.llm.plain import near


def tokens(text):
    return re.findall("[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) + ["\n"]


def held(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7 == 2


def check_rows(docs, got):
    counts = Counter(w for d, t in docs if held(d) is False for w in tokens(t))
    total, words = sum(counts.values()), len(counts)
    want = []
    for d, t in docs:
        mine = tokens(t)
        want.append((d, held(d), len(mine), sum(counts[w] > 0 for w in mine), total, sum(math.log10((counts[w] + 1) / (total + words + 1)) for w in mine)))
    order = lambda r: (repr(r[0]), r[2], r[3], r[5])
    rows = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=order)
    for g, w in zip(rows, sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and near(g[5], w[5])


@pytest.mark.parametrize("head, classes, cached", [(B.HEAD, B.CLASSES, B.CACHED), (5, 4, 40)])
def test_rows(spark, monkeypatch, head, classes, cached):
    for name, value in (("HEAD", head), ("CLASSES", classes), ("CACHED", cached)):
        monkeypatch.setattr(B, name, value)
    docs = [(i, f"Word{i % 7} the end{i % 11} of\tthe  w{i % 3}\nÄÉ é" * (1 + i % 4)) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " \n"), (103, "the " * 20_000), (103, "the " * 20_000), (None, "the unknown")]
    docs += [(next(i for i in range(200, 300) if held(i)), "never seen seen never " * 3)]
    frame = spark.createDataFrame([(d, t, 1.0, "r") for d, t in docs], "doc_id bigint, text string, score double, rare string").repartition(3)
    got = B.score_texts(frame).collect()
    check_rows(docs, got)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_probabilities_add_up(spark):
    """Over all known words and one unknown word of each class, after any context."""
    docs = spark.createDataFrame([(i, f"a{i % 5} b{i % 9}xyz c{i % 13}uvw the of the") for i in range(200)], "doc_id bigint, text string")
    texts = docs.selectExpr("doc_id", "cast(text as binary) text")
    before = (B.HEAD, B.CLASSES, B.CACHED)
    B.HEAD, B.CLASSES, B.CACHED = 8, 3, 1000
    try:
        counts = B.word_counts(texts)
        vocab = B.vocabulary(counts)
        model = B.fit(texts, vocab)
    finally:
        B.HEAD, B.CLASSES, B.CACHED = before
    words = [bytes(r.word) for r in counts.collect()]
    n = len(vocab.share)
    context, _ = vocab.symbols([[b"the", b"a1", b"nothing"]])
    at = np.array([model.log10_of(np.append(context, s), np.array([4]))[-1] for s in range(n)])
    assert abs((10.0 ** at).sum() - 1) < 1e-5
    symbols, place = vocab.symbols([words])
    inside = np.where(symbols < n - len(vocab.endings) - 1, 1.0, (vocab.count[place] + 1) * 10.0 ** vocab.share[symbols])
    unknown = 10.0 ** vocab.share[n - len(vocab.endings) - 1:]
    each = np.bincount(symbols, inside, n)
    each[n - len(vocab.endings) - 1:] += unknown
    assert len(words) == vocab.words and np.allclose(each, 1)


def test_gradients_follow_the_objective():
    """A step up the printed gradients is a step up the log-likelihood ratio against noise."""
    rng = np.random.default_rng(3)
    chain = np.zeros(4000, np.int64)
    for i in range(1, len(chain)):
        chain[i] = (chain[i - 1] * 3 + 1) % 7 if rng.random() < 0.9 else rng.integers(7)
    sizes, frequency = np.array([len(chain)]), np.bincount(chain, minlength=7).astype(float)
    model = B.Model.fresh(frequency)
    first = model.log10_of(chain, sizes).mean()
    for _ in range(60):
        model.train(chain, sizes, frequency, np.random.default_rng(1))
    best = 0.9 * math.log10(0.9 + 0.1 / 7) + 0.1 * math.log10(0.1 / 7)
    assert first < -0.8 and model.log10_of(chain, sizes).mean() > best - 0.1


def test_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in B.score_texts(docs).collect() if r.held_out]
    check_rows([(r.doc_id, r.text) for r in docs.collect()], B.score_texts(docs).collect())
    assert len(got) > 100 and sum(r.score for r in got) > sum(r.base_score for r in got) + 0.05 * sum(r.n_tokens for r in got)


@pytest.mark.parametrize("docs", [[], [(None, "a b")], [(next(i for i in range(99) if held(i)), "a b")]])
def test_no_training_rows(spark, docs):
    got = B.score_texts(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * len(docs)
