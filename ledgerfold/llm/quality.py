"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text are counts over its bytes, words and lines. Trees are grown on the driver
from a bounded sample of labelled rows (``TRAIN_ROWS``, the rows of smallest hash of the id), level
by level on histograms of at most ``BINS`` quantile bins, with logistic loss. A fitted model is a
few flat arrays (feature, threshold, children, value); scoring walks all rows of a batch down a
tree at once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import free_name, small_batches, text_bytes

TRAIN_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAST_WEIGHT = 5.0
RIDGE = 1.0
ACCEPT = 0.7
HELD_OUT = 2

FEATURES = ["bytes", "words", "mean_word", "lines", "mean_line", "upper", "lower", "digit", "space", "break", "other_ascii",
            "high", "bang", "bar", "stop_comma", "symbol", "control", "distinct_words", "top_word", "distinct_pairs",
            "distinct_lines", "short_lines", "odd_ends", "word_spread", "capitals", "longest_word"]

_CLASS = np.full(256, 10)
for _k, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b"\n\r",
                             b"!?", b"|", b".,;:", b"#$%&*@^~+=<>_\\"]):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 9
_CLASS[:9] = 11
_CLASS[11:13] = 11
_CLASS[14:32] = 11
_CLASS[127] = 11
_WORD_END = np.zeros(256, bool)
_WORD_END[list(b"!|#$%&*@^~+=<>_\\")] = True


def statistics(text: bytes) -> list[float]:
    """The values of FEATURES for one whole text; an empty text has only zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    share = np.bincount(_CLASS, np.bincount(np.frombuffer(text, np.uint8), minlength=256), minlength=12) / n
    upper, lower, digit, space, brk, bang, bar, stop, symbol, high, other, control = share.tolist()
    words, lines = text.split(), text.split(b"\n")
    w = len(words)
    if w:
        sizes = np.fromiter(map(len, words), np.int64, w)
        seen = Counter(words)
        distinct, top = len(seen) / w, max(seen.values()) / w
        pairs = len(set(zip(words, words[1:]))) / max(1, w - 1)
        ends = np.frombuffer(b"".join([x[-1:] for x in words]), np.uint8)
        firsts = np.frombuffer(b"".join([x[:1] for x in words]), np.uint8)
        mean, spread, longest = float(sizes.mean()), float(sizes.std()), float(sizes.max())
        odd, capitals = float(_WORD_END[ends].mean()), float((_CLASS[firsts] == 0).mean())
    else:
        distinct = top = pairs = mean = spread = longest = odd = capitals = 0.0
    return [float(np.log1p(n)), float(np.log1p(w)), mean, float(np.log1p(len(lines))), float(np.log1p(n / len(lines))), upper, lower,
            digit, space, brk, other, high, bang, bar, stop, symbol, control, distinct, top, pairs, len(set(lines)) / len(lines),
            sum(len(x) < 20 for x in lines) / len(lines), odd, spread, capitals, float(np.log1p(longest))]


@dataclass
class Trees:
    """Node arrays of all trees; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -500, 500)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
    """Boosted trees for the chance of y = 1. Without rows of both labels the model is the constant
    label seen, or one half when there is none."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    rate_of_ones = float(y.mean()) if len(y) else 0.5
    start = float(np.log(max(rate_of_ones, 1e-6) / max(1 - rate_of_ones, 1e-6)))
    nodes: list[list] = []
    roots: list[int] = []
    if len(y) and 0 < rate_of_ones < 1:
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
        width = bins
        binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)], axis=1)
        shift = np.arange(x.shape[1]) * width
        raw = np.full(len(y), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            gradient, curve = p - y, p * (1 - p)
            roots.append(len(nodes))
            nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
            open_nodes = [(roots[-1], np.arange(len(y)), 0)]
            while open_nodes:
                node, rows, level = open_nodes.pop()
                g, h = float(gradient[rows].sum()), float(curve[rows].sum())
                split = best_split(binned[rows], gradient[rows], curve[rows], g, h, shift, width) if level < depth else None
                if split is None:
                    nodes[node][4] = -rate * g / (h + RIDGE)
                    raw[rows] += nodes[node][4]
                    continue
                f, b = split
                goes_left = binned[rows, f] <= b
                left = len(nodes)
                nodes += [[0, 0.0, left, left, 0.0], [0, 0.0, left + 1, left + 1, 0.0]]
                nodes[node][:4] = [f, float(edges[f][b]), left, left + 1]
                open_nodes += [(left, rows[goes_left], level + 1), (left + 1, rows[~goes_left], level + 1)]
    columns = list(zip(*nodes)) if nodes else [(0,), (0.0,), (0,), (0,), (0.0,)]
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Trees(*[np.array(c, k) for c, k in zip(columns, kinds)], np.array(roots, np.int64), start, depth)


def best_split(binned, gradient, curve, g, h, shift, width):
    """(feature, bin): rows up to the bin go left; None if no split gains."""
    flat = (binned + shift).ravel()
    k = binned.shape[1]
    left_g = np.bincount(flat, np.repeat(gradient, k), k * width).reshape(k, width).cumsum(axis=1)[:, :-1]
    left_h = np.bincount(flat, np.repeat(curve, k), k * width).reshape(k, width).cumsum(axis=1)[:, :-1]
    gain = left_g**2 / (left_h + RIDGE) + (g - left_g) ** 2 / (h - left_h + RIDGE) - g * g / (h + RIDGE)
    gain[(left_h < LEAST_WEIGHT / 4) | (h - left_h < LEAST_WEIGHT / 4)] = -1
    at = int(gain.argmax())
    return (at // (width - 1), at % (width - 1)) if gain.flat[at] > 1e-6 else None


def is_held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rows: int = TRAIN_ROWS) -> Trees:
    """Trees from labelled documents that are not held out. At most ``rows`` labels are used: those
    of smallest hash of the id. Null labels and ids are left out; of repeated labels of an id the
    larger counts; of rows of one id the text of smallest hash counts, so that at most ``rows`` rows
    are collected."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["quality", "x"])

    small_batches(docs.sparkSession)
    usable = (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & ~is_held_out(id_col))
              .groupBy(F.col(id_col).alias("_labelled")).agg(F.max("quality").cast("int").alias("quality"))
              .orderBy(F.xxhash64("_labelled"), "_labelled").limit(rows))
    slim = docs.select(F.col(id_col).alias("_id"), text_bytes(text_col).alias("_text"))
    # At most ``rows`` ids: broadcast, so that texts are filtered where they are read.
    sample = slim.join(F.broadcast(usable), slim._id == usable._labelled).select("quality", "_text", "_id")
    sample = sample.groupBy("_id", "quality").agg(F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).alias("_text"))
    found = sample.select("quality", "_text").mapInArrow(run, "quality int, x array<double>").collect()
    found.sort(key=lambda r: (r.quality, r.x))  # the same model whatever the order of tasks
    return fit_trees(np.array([r.x for r in found]).reshape(len(found), len(FEATURES)), np.array([r.quality for r in found]))


def score_quality(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row. A null text is empty and is scored
    like any other; a null doc_id stays null and has a null held_out. Other columns are not read."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(2).to_pylist()
            score = model.score(np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), is_held_out(id_col).alias("held_out"),
                       text_bytes(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Trees, text_col: str = "text") -> DataFrame:
    """The rows whose text is accepted, with all their columns; row-local, nothing is shuffled."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            if not texts:
                continue
            score = model.score(np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES)))
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(score >= ACCEPT))

    small_batches(docs.sparkSession)
    return docs.select("*", text_bytes(text_col).alias(free_name("_bytes_of_text", docs.columns))).mapInArrow(run, docs.schema)
