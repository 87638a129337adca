"""Ranked search of texts by term weights, term at a time for short lists and document at a time for long ones.

The documents are read once: a written table keeps, per document, its length and how often it has
each asked term; document frequencies are counted from it. Then every task searches the documents it
holds, block by block. In a block the lists of an item's rare terms are short: they are summed
into accumulators, which are from then on a single list whose bound is its largest sum. This list and
the long ones, each with the bound of its largest part of a score, are walked together by document in
windows. Lists whose bounds together stay below the item's k-th best score so far bring no documents of
their own: they are only looked up for documents that the others bring and that can still reach that
score. The best of each task are merged in two steps.

Items are asked in slices of about ``ASKED`` (item, term) pairs, one after another; their terms
and frequencies are what the driver holds and tasks receive.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfold.llm.common import small_batches, text_bytes
from ledgerfold.sources.scratch import written

K = 10
ASKED = 500_000
DOCS = 1 << 15  # documents of a block
WINDOW = 1 << 12
SHORT = 64  # a list is short if it has at most one of so many documents of the block
WORDS = 1 << 18
LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Stretches of ASCII letters, digits and all characters beyond ASCII; A-Z lower-cased."""
    return text.translate(LOWER).split()


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term), distinct."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item", "terms"])

    kind = items.schema[id_col].dataType.simpleString()
    slim = items.select(F.col(id_col).alias("item"), text_bytes(text_col).alias("text"))
    return slim.mapInArrow(run, f"item {kind}, terms array<binary>").select("item", F.explode("terms").alias("term")).distinct()


def forward_table(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs): per row its number of terms, and the asked ones with their counts."""

    def report(ids, words):
        import pyarrow as pa

        sizes = np.fromiter(map(len, words), np.int64, len(words))
        found = np.fromiter((i for w in words for i in map(number.get, w, repeat(-1))), np.int64, int(sizes.sum()))
        keys = np.repeat(np.arange(len(words)), sizes) * len(number) + found
        keys, counts = np.unique(keys[found >= 0], return_counts=True)
        doc, term = np.divmod(keys, len(number))
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(words)))]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (term, counts)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), *lists], ["doc_id", "n", "terms", "tfs"])

    def run(batches):
        ids, words, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                words.append(terms_of(text))
                held += len(words[-1])
                if held >= WORDS:
                    yield report(ids, words)
                    ids, words, held = [], [], 0
        if ids:
            yield report(ids, words)

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


class Best:
    """The k best (score, doc_id) so far; among equals the smaller id, a missing id last."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.known = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a further document must reach."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score, doc, known):
        score, doc, known = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.known, known)))
        order = np.lexsort((doc, ~known, -score))[:self.k]
        self.score, self.doc, self.known = score[order], doc[order], known[order]


class Block:
    """The lists of one block of documents: by term, places in the block and parts of scores before
    the term's weight."""

    def __init__(self, doc_id, known, length, sizes, terms, tfs, n_docs: int, n_terms: int):
        self.doc_id, self.known, self.count = doc_id, known, len(doc_id)
        doc = np.repeat(np.arange(self.count), sizes)
        m = 100 - 90 + (90 * length * n_docs) // n_terms
        part = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc])
        order = np.argsort(terms, kind="stable")
        self.doc, self.part, terms = doc[order], part[order], terms[order]
        self.terms, start = np.unique(terms, return_index=True)
        self.top = np.maximum.reduceat(self.part, start) if len(start) else start
        edges = np.append(np.arange(0, self.count, WINDOW), self.count)
        keys = terms * (self.count + 1) + self.doc
        self.edges = edges
        self.at = np.searchsorted(keys, self.terms[:, None] * (self.count + 1) + edges[None, :])

    def search(self, asked: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Adds the block's documents that belong to the best for the asked terms."""
        place = np.searchsorted(self.terms, asked)
        good = place < len(self.terms)
        good[good] = self.terms[place[good]] == asked[good]
        place, weight = place[good], weight[good]
        place, weight = place[weight > 0], weight[weight > 0]
        if not len(place):
            return
        sizes = self.at[place, -1] - self.at[place, 0]
        short = sizes * SHORT <= self.count
        lists = [Long(self, p, w) for p, w in zip(place[~short].tolist(), weight[~short].tolist())]
        if short.any():
            lists.append(Summed(self, place[short], weight[short]))
        lists.sort(key=lambda x: x.bound)
        bounds = np.cumsum([x.bound for x in lists])
        for window in range(len(self.edges) - 1):
            least = best.least
            first = int(np.searchsorted(bounds, least))  # lists before it cannot reach the least together
            if first == len(lists):
                return
            brought = [x.rows(window) for x in lists[first:]]
            doc, score = summed(np.concatenate([d for d, _ in brought]), np.concatenate([s for _, s in brought]))
            for i in range(first - 1, -1, -1):
                alive = score + bounds[i] >= least
                doc, score = doc[alive], score[alive]
                if not len(doc):
                    break
                score = score + lists[i].look_up(window, doc)
            alive = score >= least
            if alive.any():
                doc = doc[alive]
                best.add(score[alive], self.doc_id[doc], self.known[doc])


def summed(doc: np.ndarray, score: np.ndarray):
    """Different documents, ascending, with their sums."""
    if not len(doc):
        return doc, score
    order = np.argsort(doc, kind="stable")
    doc, score = doc[order], score[order]
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    return doc[start], np.add.reduceat(score, start)


class Long:
    """A term's list in a block."""

    def __init__(self, block: Block, place: int, weight: int):
        self.at, self.weight, self.doc, self.part = block.at[place].tolist(), weight, block.doc, block.part
        self.bound = weight * int(block.top[place])

    def rows(self, window: int):
        here = slice(self.at[window], self.at[window + 1])
        return self.doc[here], self.part[here] * self.weight

    def look_up(self, window: int, doc: np.ndarray) -> np.ndarray:
        mine, score = self.rows(window)
        if not len(mine):
            return np.zeros(len(doc), np.int64)
        at = np.minimum(np.searchsorted(mine, doc), len(mine) - 1)
        return np.where(mine[at] == doc, score[at], 0)


class Summed(Long):
    """The sums over several short lists, as one list."""

    def __init__(self, block: Block, places: np.ndarray, weights: np.ndarray):
        begin, end = block.at[places, 0], block.at[places, -1]
        sizes = end - begin
        rows = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        self.doc, self.part = summed(block.doc[rows], block.part[rows] * np.repeat(weights, sizes))
        self.at, self.weight = np.searchsorted(self.doc, block.edges).tolist(), 1
        self.bound = int(self.part.max())


def searched(forward: DataFrame, asked: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of each task for each item, items by their number."""

    def run(batches):
        import pyarrow as pa

        best = [Best(k) for _ in asked]

        def search(held):
            table = pa.Table.from_batches(held).combine_chunks()
            ids, terms, tfs = (table.column(c).combine_chunks() for c in ("doc_id", "terms", "tfs"))
            sizes = np.diff(terms.offsets.to_numpy())
            block = Block(ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), table.column("n").to_numpy(), sizes,
                          terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64), n_docs, n_terms)
            for found, mine in zip(best, asked):
                block.search(mine, weights[mine], found)

        held, count = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count >= DOCS:
                search(held)
                held, count = [], 0
        if held:
            search(held)
        sizes = [len(b.score) for b in best]
        if sum(sizes):
            doc, known, score = (np.concatenate([getattr(b, c) for b in best]) for c in ("doc", "known", "score"))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), sizes)), pa.array(doc, mask=~known), pa.array(score)],
                                             ["item", "doc_id", "score"])

    return forward.where("n > 0").mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def first_ranks(hits: DataFrame, keys, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return hits.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", asked: int = ASKED) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item, equal
    scores by ascending doc_id, those without an id last.

    With N documents that have a term, L terms in all of them, n terms and tf occurrences in a
    document and df documents holding a term: weight floor(1000 ln((2N+2)/(2df+1))), length factor
    m = 10 + 90nN div L, score the sum of weight * (10^9 tf div (1000 tf + 8m)) over the item's
    different terms. A null text has no terms; rows of an item_id are one item with all their
    terms (a null item_id as well); every row of ``docs`` is a document, so repeated rows are ranked
    one by one. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pairs = written(item_terms(items, item_col, item_text), "item-terms")
    slices = max(1, -(-pairs.count() // asked))
    kind = pairs.schema["item"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for k_slice in range(slices):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == k_slice) if slices > 1 else pairs
        rows = mine.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        number: dict[bytes, int] = {}
        lists = [np.array(sorted(number.setdefault(bytes(t), len(number)) for t in r.terms), np.int64) for r in rows]
        if not number:
            continue
        forward = written(forward_table(docs, number, id_col, text_col), "terms-of-documents")
        total = forward.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        df = np.zeros(len(number), np.int64)
        for term, count in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = count
        if not total[0]:
            continue
        weights = np.array([math.floor(1000 * math.log((2 * total[0] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        hits = searched(forward, lists, weights, total[0], total[1], k).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(256)))
        hits = first_ranks(first_ranks(hits, ["item", "part"], k).drop("rank", "part"), ["item"], k)
        names = spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], f"item bigint, item_id {kind}")
        out = out.union(hits.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out
