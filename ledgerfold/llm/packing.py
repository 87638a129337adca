"""Order-preserving packing of documents into training sequences.

The tokens of a partition form one stream in the order of its rows. Dynamic programming chooses
the cuts: from a cut at i to a cut at j at most ``size`` tokens later costs the padding of the
sequence, a fixed cost per sequence, and a penalty for where it cuts: nothing at the end of a
document, little at the end of a sentence, more inside one. Padding to ``size`` is linear in j - i,
so the best i is the head of a monotone queue over cost(i) + i; sequences whose length is a power
of two need no padding and are tried one by one. Where no boundary lies within ``size`` tokens of
the last, the sentence is cut.

Nothing is shuffled: each task packs its own partition, in blocks of ``BLOCK`` tokens whose last
sequence is reopened for the next block. Only a partition's very last sequence has no successor to
fill it; it is cut into powers of two where that costs less than padding it.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import small_batches, whole_text

SIZE = 1024
SEQUENCE_COST = 16
SENTENCE_PENALTY = 2
INSIDE_PENALTY = 12
LEAST_POWER = 6
BLOCK = 1 << 18
END_ID = 0
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def padding(length: int, size: int = SIZE) -> int:
    return 0 if length & (length - 1) == 0 else size - length


def candidates(doc_ends: np.ndarray, sentence_ends: np.ndarray, size: int = SIZE) -> tuple[list[int], list[int]]:
    """Positions where a cut may fall, ascending from 0 to the end of the block, no two more than
    ``size`` apart, and the penalty of each: ends of documents and sentences, and the positions
    where a sequence begun at one of them is full."""
    last = int(doc_ends[-1])
    is_end = np.zeros(last + 1, bool)
    is_end[0] = True
    is_end[doc_ends] = True
    is_end[sentence_ends] = True
    ends = np.flatnonzero(is_end)
    asked = is_end.copy()
    full = ends + size
    asked[full[full < last]] = True
    for k in np.flatnonzero(np.diff(ends) > size):
        asked[ends[k] + size:ends[k + 1]:size] = True
    at = np.flatnonzero(asked)
    penalty = np.where(is_end[at], SENTENCE_PENALTY, INSIDE_PENALTY)
    penalty[np.searchsorted(at, doc_ends)] = 0
    return at.tolist(), penalty.tolist()


def power_partners(at: list[int], powers: list[int]) -> tuple[list[int], list[int]]:
    """The indices of the positions a power of two before each position, position by position, and
    how many of them there are up to and with each."""
    places = np.array(at)
    index = np.full(places[-1] + 1, -1, np.int32)
    index[places] = np.arange(len(places), dtype=np.int32)
    before = places[:, None] - np.array(powers)
    found = np.where(before >= 0, index[np.maximum(before, 0)], -1)
    met = found >= 0
    return found[met].tolist(), np.cumsum(met.sum(1)).tolist()


def best_cuts(at: list[int], penalty: list[int], size: int = SIZE) -> list[int]:
    """The cheapest cuts, as positions, the last at ``at[-1]``."""
    powers = [1 << k for k in range(min(LEAST_POWER, size.bit_length() - 1), size.bit_length()) if 1 << k <= size]
    partners, until = power_partners(at, powers)
    fixed = [SEQUENCE_COST + p for p in penalty]
    cost, back = [0] * len(at), [0] * len(at)
    done = 0
    # the monotone queue of sources, from head to tail: key = cost + position ascending
    queue, places, keys, head, tail = [0] * len(at), [0] * len(at), [0] * len(at), 0, 1
    for j in range(1, len(at)):
        here = at[j]
        while places[head] < here - size:
            head += 1
        source = queue[head]
        low = keys[head] + size - here
        if until[j] > done:
            for i in partners[done:until[j]]:
                if cost[i] < low:
                    low, source = cost[i], i
            done = until[j]
        low += fixed[j]
        cost[j], back[j] = low, source
        low += here
        while tail > head and keys[tail - 1] >= low:
            tail -= 1
        queue[tail], places[tail], keys[tail] = j, here, low
        tail += 1
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def closing_cuts(length: int, size: int = SIZE) -> list[int]:
    """The cheapest cut of a stream's last sequence into powers of two, largest first, and a rest."""
    best, parts, cost = [length], [], 0
    least = padding(length, size)
    while length:
        parts.append(1 << (length.bit_length() - 1))
        length -= parts[-1]
        cost += INSIDE_PENALTY + SEQUENCE_COST
        if length and cost + padding(length, size) < least:
            best, least = [*parts, length], cost + padding(length, size)
    return best


class Stream:
    """Packs documents as they come; yields finished pieces."""

    def __init__(self, first_sequence: int, size: int = SIZE, block: int = BLOCK):
        self.size, self.block, self.sequence = size, block, first_sequence
        self.docs: deque = deque()  # (doc_id, ids, place of the first of these ids still open)
        self.stops: list[np.ndarray] = []
        self.open = 0

    def add(self, doc_id, ids: np.ndarray, sentence_ends: np.ndarray):
        ids = np.append(ids, np.uint32(END_ID)).astype("<u4", copy=False)
        self.docs.append([doc_id, ids, 0])
        self.stops.append(sentence_ends + self.open)
        self.open += len(ids)
        return self.cut(False) if self.open >= self.block else []

    def cut(self, last: bool) -> list[tuple]:
        if not self.open:
            return []
        ends = np.cumsum([len(ids) - done for _, ids, done in self.docs])
        stops = np.concatenate(self.stops)
        cuts = best_cuts(*candidates(ends, stops[(stops > 0) & (stops < self.open)], self.size), self.size)
        lengths = np.diff([0, *cuts]).tolist()
        if last:
            lengths = [*lengths[:-1], *closing_cuts(lengths[-1], self.size)]
        elif len(lengths) > 1:
            lengths.pop()
        taken = sum(lengths)
        rows = [row for n in lengths for row in self.take(n)]
        self.open -= taken
        self.stops = [stops[stops > taken] - taken]
        return rows

    def take(self, length: int):
        offset = 0
        while offset < length:
            doc_id, ids, done = self.docs[0]
            n = min(length - offset, len(ids) - done)
            yield (doc_id, done, n, zlib.crc32(ids[done:done + n]), len(ids), self.sequence, offset)
            offset += n
            if done + n == len(ids):
                self.docs.popleft()
            else:
                self.docs[0][2] = done + n
        self.sequence += 1


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """One row per piece of a document in a sequence: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. ``tokenizer`` is the path of a byte-level BPE file.

    A document is its ids and then id 0, so a null or empty text is one token; repeated rows are
    packed one by one; a null doc_id stays null; a text of any length is cut over as many sequences
    as it needs. sequence_id is unique in the result: the partition's number times 2^40 plus a
    count, the same when a task is run again. Other columns are not read.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from ledgerfold.llm.bpe import word_encoder

        encoder = word_encoder(tokenizer)
        stream = Stream(TaskContext.get().partitionId() << 40, size, block)
        kinds = [pa.int64()] * 7
        names = [c.split()[0] for c in PIECES.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            rows = []
            for doc_id, (ids, ends) in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                rows += stream.add(doc_id, ids, ends)
            if rows:
                yield batch_of(rows)
        if rows := stream.cut(True):
            yield batch_of(rows)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, PIECES)
