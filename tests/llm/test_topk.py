"""Top-k search against all scores, plainly sorted."""

import math
import random

import numpy as np
import pytest

from ledgerfold.llm import topk


def plain(rows, k, every):
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        v = min((v for j, v in good if j == q), key=lambda v: (len(v), v))
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(v) == len(w)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("sizes", [(2048, 16384), (3, 17)])
def test_rows(spark, sizes):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(20)]) for i in range(150)]
    rows += [(150 + i, rows[0][1]) for i in range(30)] + [(200, None), (210, [0.1, None]), (220, [math.nan] * 20), (230, [math.inf] * 20),
                                                          (None, [0.1] * 20), (240, [0.5] * 3), (241, [0.25] * 3), (250, []), (251, []), (17, rows[17][1]),
             (0, rows[0][1]), (0, rows[0][1]), (10, rows[3][1]), (20, [0.5] * 3)]
    frame = spark.createDataFrame([(i, v, 9) for i, v in rows], "vec_id bigint, embedding array<float>, rank int").repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(frame, 10, 10, queries_per_block=sizes[0], candidates_per_block=sizes[1]).collect())
    assert got == plain(rows, 10, 10)
    assert topk.top_k(frame.limit(0)).count() == 0


def test_bounds_prune_and_keep_ties():
    rng = np.random.default_rng(1)
    block = rng.integers(-50, 50, (40, 500))
    block[:, 250:] = block[:, :250]
    ids = np.arange(500) * 2
    queries = rng.integers(-50, 50, (7, 40))
    q, row, score = topk.best_of_block(queries, np.full(7, -1), block, ids, 9)
    for i in range(7):
        all_scores = queries[i] @ block
        want = sorted(range(500), key=lambda j: (-all_scores[j], ids[j]))[:9]
        assert row[q == i].tolist() == want and (score[q == i] == all_scores[want]).all()
