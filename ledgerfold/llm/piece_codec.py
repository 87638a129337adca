"""SentencePiece encoding and decoding with the pieces and scores of a model file.

Encoding is the segmentation of highest total score (Viterbi). A text's spaces become the mark of a
word's begin, one such mark is put in front, and since no piece has a mark behind another character,
words are independent: each different word of a worker is solved once. Words of equal length advance
together: prefix hashes give the hash of every substring, a binary search finds it among the sorted
hashes of the pieces, and the maximum over starts stores score and backpointer for all words at
once. A character in no piece costs the lowest score less 10 and becomes the pieces of its bytes.
Among equal totals the longest last piece wins, end by end.

The chosen pieces are compared with the word afterwards, so a colliding hash cannot pass.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.bpe import grown
from ledgerfold.llm.common import small_batches, text_bytes, whole_text

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LONG = 64
TOGETHER = 8192
ENTRIES = 800_000
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

_made: dict[str, "PieceCodec"] = {}


class PieceCodec:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.full(256, model.unk_id(), np.int32)
        ordinary = []
        self.output: list[bytes] = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.output.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.output.append(b"")
            else:
                ordinary.append(i)
                self.output.append(piece.replace(MARK, " ").encode())
        texts = [self.pieces[i] for i in ordinary]
        if any(MARK in t.lstrip(MARK) for t in texts):
            raise ValueError("a piece crosses the begin of a word")
        self.scores_of = {t: (model.get_score(i), i) for t, i in zip(texts, ordinary)}
        self.longest = max(map(len, texts))
        self.unknown = min(s for s, _ in self.scores_of.values()) - UNKNOWN_PENALTY
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, MULTIPLIER)]), dtype=np.uint64)
        hashes = np.array([self.prefix_hashes(np.array([[ord(c)] for c in t], np.uint64))[-1, 0] for t in texts], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.key_ids = hashes[order], np.array(ordinary, np.int32)[order]
        self.key_scores = np.array([self.scores_of[t][0] for t in texts])[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.int32), 0
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    @staticmethod
    def prefix_hashes(codes: np.ndarray) -> np.ndarray:
        """For columns of code points: hashes of the prefixes of length 0, 1, ..., one row each."""
        out = np.zeros((codes.shape[0] + 1, codes.shape[1]), np.uint64)
        for j in range(codes.shape[0]):
            out[j + 1] = out[j] * MULTIPLIER + codes[j] + np.uint64(1)
        return out

    def solve(self, words: list[str]) -> list[list[int]]:
        """Piece ids of words of one length; -1 stands for a character in no piece. Arrays have one
        row per position and one column per word."""
        n, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).T.astype(np.uint64)
        hashes = self.prefix_hashes(codes)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        back, piece = np.zeros((length + 1, n), np.int32), np.full((length + 1, n), -1, np.int32)
        last = len(self.keys) - 1
        for j in range(1, length + 1):
            for i in range(max(0, j - self.longest), j):
                part = hashes[j] - hashes[i] * self.powers[j - i]
                at = np.minimum(np.searchsorted(self.keys, part), last)
                hit = self.keys[at] == part
                rows = np.flatnonzero(hit)
                gain = self.key_scores[at[rows]] + best[i, rows]
                better = gain > best[j, rows]
                rows = rows[better]
                best[j, rows], back[j, rows], piece[j, rows] = gain[better], i, self.key_ids[at[rows]]
                if i == j - 1 and not hit.all():
                    rows = np.flatnonzero(~hit)
                    gain = self.unknown + best[i, rows]
                    better = gain > best[j, rows]
                    rows = rows[better]
                    best[j, rows], back[j, rows], piece[j, rows] = gain[better], i, -1
        found: list[list[int]] = [[] for _ in words]
        rows, ends = np.arange(n), np.full(n, length)
        while len(rows):
            for r, p in zip(rows.tolist(), piece[ends, rows].tolist()):
                found[r].append(p)
            ends = back[ends, rows]
            rows, ends = rows[ends > 0], ends[ends > 0]
        return [f[::-1] for f in found]

    def solve_alone(self, word: str) -> list[int]:
        """The same for one word of any length, without hashes."""
        best, back = [0.0], [(0, -1)]
        for j in range(1, len(word) + 1):
            top, link = -np.inf, (j - 1, -1)
            for i in range(max(0, j - self.longest), j):
                hit = self.scores_of.get(word[i:j])
                gain = best[i] + (hit[0] if hit else self.unknown if i == j - 1 else -np.inf)
                if gain > top:
                    top, link = gain, (i, hit[1] if hit else -1)
            best.append(top)
            back.append(link)
        found, j = [], len(word)
        while j:
            j, p = back[j]
            found.append(p)
        return found[::-1]

    def spells(self, pieces: list[int], word: str) -> bool:
        at = 0
        for p in pieces:
            size = 1 if p < 0 else len(self.pieces[p])
            if p >= 0 and self.pieces[p] != word[at:at + size]:
                return False
            at += size
        return at == len(word)

    def with_bytes(self, word: str, pieces: list[int]) -> list[int]:
        out, at = [], 0
        for p in pieces:
            if p < 0:
                out += self.byte_ids[list(word[at].encode("utf-8", "surrogatepass"))].tolist()
                at += 1
            else:
                out.append(p)
                at += len(self.pieces[p])
        return out

    def learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        names: list[str] = []
        ids: list[int] = []
        sizes: list[int] = []
        for word in words:
            if word not in self.known:
                by_length.setdefault(len(word), []).append(word)
        for length, group in by_length.items():
            for at in range(0, len(group), TOGETHER):
                part = group[at:at + TOGETHER]
                for word, pieces in zip(part, self.solve(part) if length <= LONG else map(self.solve_alone, part)):
                    if -1 in pieces:
                        pieces = self.with_bytes(word, pieces if self.spells(pieces, word) else self.solve_alone(word))
                    elif "".join(map(self.pieces.__getitem__, pieces)) != word:
                        pieces = self.with_bytes(word, self.solve_alone(word))
                    names.append(word)
                    ids += pieces
                    sizes.append(len(pieces))
        first, n, total = len(self.known), len(self.known) + len(names), self.used + len(ids)
        self.start, self.length, self.flat = grown(self.start, n), grown(self.length, n), grown(self.flat, total)
        self.flat[self.used:total] = ids
        self.length[first:n] = sizes
        self.start[first:n] = self.used + np.cumsum(self.length[first:n]) - self.length[first:n]
        self.known.update(zip(names, range(first, n)))
        self.used = total

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > ENTRIES:
            self.clear()
        if not texts:
            return []
        words: list[str] = []
        counts = []
        for text in texts:
            own = WORD.findall(MARK + text.replace(" ", MARK)) if text else []
            words += own
            counts.append(len(own))
        try:
            index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        except KeyError:
            self.learn(set(words))
            index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        sizes = self.length[index]
        after = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.start[index] - (after - sizes), sizes) + np.arange(int(after[-1]) if len(after) else 0)]
        ends = np.concatenate([[0], after])[np.cumsum(counts)]
        return np.split(ids, ends[:-1])

    def decode(self, ids) -> str:
        """The text of ids; control pieces have none, bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.output.__getitem__, ids))
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")

    def decode_lists(self, ids) -> list[str]:
        """The same for an Arrow array of lists of ids; a null list gives the empty text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
        spelled = pa.array(self.output, pa.large_binary()).take(ids.flatten())
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), spelled), pa.scalar(b"", pa.large_binary()))
        return [(raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace") for raw in joined.to_pylist()]


def codec(path: str) -> PieceCodec:
    """The codec of this process for a model file."""
    if path not in _made:
        _made[path] = PieceCodec(path)
    return _made[path]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, ids): the piece ids of each whole text, one row per row. A null text is empty
    and has no ids; repeated rows are each encoded; a null doc_id stays null. Other columns are not
    read."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()]
            ids = codec(model).encode(texts)
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *ids])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "text", "ids"])

    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, text string, ids array<int>")


def decode(rows: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of its ids; null ids give the empty text."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codec(model).decode_lists(ids), pa.string())], [*batch.schema.names, out_col])

    small_batches(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, `{out_col}` string")


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_hash, same): count and XXH64 of the ids, and whether decoding them
    gives the text back, its marks of a word's begin read as spaces."""
    rows = decode(encode(docs, model, id_col, text_col), model)
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
                       (F.replace(whole_text("text"), F.lit(MARK), F.lit(" ")) == F.col("decoded")).alias("same"))
