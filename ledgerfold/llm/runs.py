"""Periodic runs of words, found in a grammar.

The word ids of a block of texts are compressed by Re-Pair: in every round the most frequent pairs of
neighbours are replaced by nonterminals, a pair giving way where a more frequent neighbour overlaps
it; when no pair repeats, what is left of each text is paired up in order, so that a text is one
derivation tree. Texts of a block share their rules, copies share nearly all of them.

A run lies across the boundary between the two halves of exactly one lowest node of its tree. So the
runs across the boundary of each nonterminal are computed once, on the words of its first
occurrence; each is then translated to all places where the nonterminal is derived, and of the
intervals of a period those inside a longer one are dropped. A run of period q has at least 4q
words, so q words beside the boundary stand there twice: these squares are tested for all periods of
all nonterminals at once, first on single words, then on hashes of whole blocks (two moduli of 31
bits); how far the period reaches is a binary search on the hashes.

Blocks hold about ``BLOCK`` words, a longer text is one block; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import small_batches, text_bytes

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
BLOCK = 1 << 18
TESTED = 1 << 22  # (nonterminal, period) combinations that are tested at once
MODULI = ((2147483647, 1234567891), (2147483629, 987654321))  # primes and bases of the hashes
RUNS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class Grammar:
    """Rules over the ids 0..words-1. Of rule r: ``first`` is where it first occurs, ``left`` and
    ``size`` are the words of its left half and of all of it. ``node_rule`` and ``node_start`` list
    every place at which a rule is derived."""

    def __init__(self, ids: np.ndarray, doc_sizes: np.ndarray):
        n = len(ids)
        self.terminals = int(ids.max()) + 1 if n else 0
        self.sizes = np.ones(self.terminals + n, np.int64)
        self.next = self.terminals
        self.first, self.left, self.node_rule, self.node_start = [], [], [], []
        self.known_keys, self.known_rules = np.zeros(0, np.int64), np.zeros(0, np.int64)
        symbols, starts = ids.astype(np.int64), np.arange(n)
        inner = np.ones(n, bool)  # the next symbol is of the same text
        inner[np.cumsum(doc_sizes[doc_sizes > 0]) - 1] = False
        live = inner.copy()  # the pair that begins here may repeat
        while (taken := self.repeated(symbols, inner, live)) is not None:
            symbols, starts, inner, live = self.replace(symbols, starts, inner, live, taken)
        while inner.any():
            symbols, starts, inner, live = self.replace(symbols, starts, inner, live, in_order(inner))
        empty = np.zeros(0, np.int64)
        self.first, self.left, self.node_rule, self.node_start = (
            np.concatenate([empty, *x]) for x in (self.first, self.left, self.node_rule, self.node_start))
        self.size = self.sizes[self.terminals:self.next]

    @staticmethod
    def repeated(symbols, inner, live):
        """Places whose pair repeats and is more frequent than the pairs that overlap it there; None
        if no pair repeats. In a row of equal symbols every other pair counts. Marks pairs that stand
        alone as not live."""
        if len(symbols) < 2:
            return None
        same = np.zeros(len(symbols), bool)
        same[:-1] = inner[:-1] & (symbols[:-1] == symbols[1:])
        place = np.arange(len(symbols))
        row = place - np.maximum.accumulate(np.where(same, -1, place))  # 0 where no equal pair stands
        odd = same & (row % 2 == 0)  # the first pair of a row has number 1
        at = np.flatnonzero(live & ~odd)
        keys = (symbols[at] << 31) | symbols[at + 1]
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        count = counts[inverse]
        live[at[count == 1]] = False
        more = count > 1
        at, count, keys = at[more], count[more], keys[more]
        if not len(at):
            return None
        mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(34)
        rank = np.zeros(len(symbols) + 2, np.int64)
        rank[at + 1] = (count << 30) | mixed.astype(np.int64)
        here = rank[at + 1]
        return at[(here > rank[at]) & (here >= rank[at + 2])]

    def replace(self, symbols, starts, inner, live, taken):
        keys = (symbols[taken] << 31) | symbols[taken + 1]
        distinct, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        found = np.searchsorted(self.known_keys, distinct)
        old = np.zeros(len(distinct), bool)
        inside = found < len(self.known_keys)
        old[inside] = self.known_keys[found[inside]] == distinct[inside]
        made = self.next + np.cumsum(~old) - 1
        made[old] = self.known_rules[found[old]]
        new = np.flatnonzero(~old)
        self.known_keys = np.insert(self.known_keys, found[new], distinct[new])
        self.known_rules = np.insert(self.known_rules, found[new], made[new])
        left = self.sizes[distinct[new] >> 31]
        self.sizes[made[new]] = left + self.sizes[distinct[new] & ((1 << 31) - 1)]
        self.first.append(starts[taken[where[new]]])
        self.left.append(left)
        self.next += len(new)
        self.node_rule.append(made[inverse] - self.terminals)
        self.node_start.append(starts[taken])
        symbols, inner, live = symbols.copy(), inner.copy(), live.copy()
        symbols[taken] = made[inverse]
        inner[taken] = inner[taken + 1]
        live[taken] = inner[taken]
        before = taken[taken > 0] - 1
        live[before] = inner[before]
        keep = np.ones(len(symbols), bool)
        keep[taken + 1] = False
        return symbols[keep], starts[keep], inner[keep], live[keep]


def in_order(inner: np.ndarray) -> np.ndarray:
    """Every other place of each text, if it is not the text's last."""
    place = np.arange(len(inner))
    begins = np.concatenate([[True], ~inner[:-1]])
    offset = place - np.maximum.accumulate(np.where(begins, place, 0))
    return np.flatnonzero(inner & (offset % 2 == 0))


class Hashes:
    """Compares blocks of ids of any place and length."""

    def __init__(self, ids: np.ndarray):
        self.parts = []
        for p, base in MODULI:
            power, n = np.ones(1, np.int64), len(ids) + 1
            while len(power) < n:
                step = int(pow(base, len(power), p))
                power = np.concatenate([power, power * step % p])
            power = power[:n]
            values = (ids + 1) * 1000003 % p
            self.parts.append((p, power, np.concatenate([[0], np.cumsum(values * power[:-1] % p)]) % p))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the blocks of ``length`` at a and at b >= a are the same."""
        out = np.ones(len(a), bool)
        for p, power, total in self.parts:
            out &= (total[a + length] - total[a]) % p * power[b - a] % p == (total[b + length] - total[b]) % p
        return out

    def shift_match(self, at, shift, most, back: bool):
        """How many places from ``at`` on (or before it) have the same id ``shift`` places later; at
        most ``most``."""
        low, high = np.zeros_like(at), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            begin = at - middle if back else at
            good = self.equal(begin, begin + shift, middle)
            low = np.where(good, middle, low)
            high = np.where(good, high, middle - 1)
        return low


def boundary_runs(grammar: Grammar, ids: np.ndarray, hashes: Hashes):
    """(rule, start, end, period) of the runs across the boundary of each rule, as places of its first
    occurrence."""
    size, first = grammar.size, grammar.first
    middle, end = first + grammar.left, first + size
    found = []
    for left in (False, True):
        side = grammar.left if left else size - grammar.left
        periods = np.where(size >= LEAST_LENGTH, np.minimum(side // 2, size // LEAST_EXPONENT), 0)
        rules = np.flatnonzero(periods)
        cut = np.cumsum(periods[rules]) // TESTED
        for part in np.split(rules, np.flatnonzero(np.diff(cut)) + 1) if len(rules) else []:
            many = periods[part]
            rule = np.repeat(part, many)
            q = np.arange(len(rule)) - np.repeat(np.cumsum(many) - many, many) + 1
            # the square of period q beside the boundary: right of it, or left of it
            at = middle[rule] - 2 * q if left else middle[rule]
            for place in ((lambda a, q: a + q - 1, lambda a, q: a) if left else (lambda a, q: a, lambda a, q: a + q - 1)):
                good = ids[place(at, q)] == ids[place(at, q) + q]
                rule, q, at = rule[good], q[good], at[good]
            good = hashes.equal(at, at + q, q)
            rule, q, at = rule[good], q[good], at[good]
            u = at - hashes.shift_match(at, q, at - first[rule], True)
            v = at + 2 * q + hashes.shift_match(at + q, q, end[rule] - at - 2 * q, False)
            good = (u < middle[rule]) & (v > middle[rule]) & (v - u >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q))
            found.append(np.stack([rule[good], u[good], v[good], q[good]]))
    rows = np.concatenate([np.zeros((4, 0), np.int64), *found], axis=1)
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    # the same stretch under several periods has the smallest
    fresh = np.ones(rows.shape[1], bool)
    fresh[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    return rows[:, fresh]


def runs_of(ids: np.ndarray, doc_sizes: np.ndarray):
    """(start, end, period) of all runs of a block of texts, as places in the block, by start and
    period. ``ids`` are the texts' word ids one after another, small numbers from 0."""
    grammar = Grammar(ids, doc_sizes)
    rule, u, v, q = boundary_runs(grammar, ids, Hashes(ids))
    if not len(rule):
        return u, v, q
    begin = np.searchsorted(rule, np.arange(len(grammar.size) + 1))
    many = np.diff(begin)[grammar.node_rule]
    node = np.repeat(np.arange(len(many)), many)
    which = begin[grammar.node_rule[node]] + np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many)
    shift = grammar.node_start[node] - grammar.first[grammar.node_rule[node]]
    u, v, q = u[which] + shift, v[which] + shift, q[which]
    order = np.lexsort((-v, u, q))
    u, v, q = u[order], v[order], q[order]
    reach = q * (len(ids) + 1) + v
    keep = np.ones(len(u), bool)
    keep[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    u, v, q = u[keep], v[keep], q[keep]
    order = np.lexsort((q, u))
    return u[order], v[order], q[order]


class Numbers(dict):
    """Word to number, in order of appearance."""

    def __missing__(self, word):
        self[word] = found = len(self)
        return found


def block_report(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_words, runs, collapsed text) of each (doc_id, words)."""
    sizes = np.array([len(words) for _, words in docs], np.int64)
    total, number = int(sizes.sum()), Numbers()
    ids = np.fromiter((i for _, words in docs for i in map(number.__getitem__, words)), np.int64, total)
    u, v, q = runs_of(ids, sizes)
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, u + q, 1)
    np.add.at(change, v, -1)
    kept = np.cumsum(change[:-1]) == 0
    begins = np.concatenate([[0], np.cumsum(sizes)])
    which = np.searchsorted(u, begins)
    out = []
    for k, (doc_id, words) in enumerate(docs):
        begin, low, high = int(begins[k]), which[k], which[k + 1]
        if low == high:
            out.append((doc_id, len(words), [], b" ".join(words)))
            continue
        runs = [{"start": s, "length": n, "period": p}
                for s, n, p in zip((u[low:high] - begin).tolist(), (v - u)[low:high].tolist(), q[low:high].tolist())]
        rest = [w for w, good in zip(words, kept[begin:begin + len(words)].tolist()) if good]
        out.append((doc_id, len(words), runs, b" ".join(rest)))
    return out


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    Words are stretches without ASCII white space. A run is a stretch with smallest period q (words
    q apart are the same) of at least max(6, 4q) words that no neighbour continues; ``runs`` lists
    start, length and period by start, then period. ``collapsed`` is the text's words joined by one
    space, without those that a run holds beyond its first q words. ``edit`` may change the words of
    a row first. A null text is empty and has no words; repeated rows and texts are each reported; a
    null id stays null. Other columns are not read.
    """

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))]

        def report(rows):
            columns = list(zip(*block_report(rows)))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[3], pa.binary()).cast(pa.string())],
                                              ["doc_id", "n_words", "runs", "collapsed"])

        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.split()
                rows.append((doc_id, edit(doc_id, words) if edit else words))
                held += len(words)
                if held >= block:
                    yield report(rows)
                    rows, held = [], 0
        if rows:
            yield report(rows)

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text")).mapInArrow(run, RUNS)


def with_repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of every tenth id (by CRC-32) the words from some place on repeat with some period."""
    import zlib

    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a:a + p]
    return words[:a] + (part * ((n - a) // p + 1))[:n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """Per row its number of runs, the longest (ties: first, then smallest period) and digests."""
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    best = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    return found.select("doc_id", "runs", "collapsed", F.expr(best).alias("b")).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("b.start")).alias("start"),
        F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
        F.expr("(1000 * b.length) div -b.period").alias("exponent_milli"), F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
