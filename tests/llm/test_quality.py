"""Quality classifier: trees against a plain traversal, held-out accuracy, odd rows."""

import zlib

import numpy as np

from ledgerfold.llm import quality
from ledgerfold.llm.queries import QUERIES
from tests.conftest import SF

DOCS = [(1, "Fine words here, and more of them.\nA second line."), (2, None), (3, ""), (3, ""), (None, "no id"), (4, "x" * 200_000),
        (5, "\x00\x01 \n\n"), (6, "ß é 日本 | !! ##")]


def plain_score(model, row):
    total = model.start
    for root in model.roots:
        node = root
        while model.left[node] != node:
            node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
        total += model.value[node]
    return 1 / (1 + np.exp(-total))


def fitted(seed=1, n=600):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(quality.FEATURES))).round(1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(int)
    return x, y, quality.fit_trees(x, y)


def test_flat_traversal_is_the_plain_one():
    x, y, model = fitted()
    assert np.allclose(model.score(x[:80]), [plain_score(model, r) for r in x[:80]])
    fresh, want, _ = fitted(2)
    assert ((model.score(fresh) >= 0.5) == want).mean() > 0.95


def test_one_label_or_none():
    x = np.zeros((3, len(quality.FEATURES)))
    assert (quality.fit_trees(x, np.ones(3)).score(x) > 0.99).all()
    assert (quality.fit_trees(x[:0], np.ones(0)).score(x) == 0.5).all()


def test_odd_rows(spark):
    _, _, model = fitted()
    docs = spark.createDataFrame([(*d, 0.5) for d in DOCS], "doc_id bigint, text string, score double")
    got = quality.score_quality(docs, model).collect()
    assert len(got) == len(DOCS)
    texts = dict(DOCS)
    for r in got:
        assert r.score == model.score(np.array([quality.statistics((texts[r.doc_id] or "").encode())]))[0]
        assert r.predicted == (r.score >= 0.7)
        assert r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert quality.score_quality(docs.limit(0), model).count() == 0
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(
        str(d) for d in docs.collect() if model.score(np.array([quality.statistics((d.text or "").encode())]))[0] >= 0.7)


def test_fit_without_labels(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    assert len(quality.fit_quality(docs, labels).roots) == 0


def test_held_out_accuracy(spark):
    scores = {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, SF).collect()}
    assert len(scores) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if scores[r.doc_id].held_out]
    assert len(held) > 10 and sum(scores[r.doc_id].predicted == r.quality for r in held) >= 0.9 * len(held)


def test_repeated_rows_do_not_weigh(spark, monkeypatch):
    docs = [(i, ("good words. " if i % 3 else "x!! ") * (1 + i % 7)) for i in range(120)]
    trained = []
    monkeypatch.setattr(quality, "fit_trees", lambda x, y, *a, **k: trained.append((x.tolist(), y.tolist())))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id bigint, quality int")
    one = next(i for i in range(120) if zlib.crc32(str(i).encode()) % 4 != quality.HELD_OUT)
    for rows in (docs, docs + [docs[one]] * 500):
        quality.fit_quality(spark.createDataFrame(rows, "doc_id bigint, text string"), labels, rows=50)
    assert trained[0] == trained[1] and len(trained[0][1]) == 50
