"""Token ids of byte-level BPE by the tokenizers library, one encoding per different word.

The pre-tokenizer of such a vocabulary never joins what stands before a single white space with
what follows it, so a text without two white spaces in a row can be cut before every space and line
break, and the ids of each different piece of a group are looked up. Other texts are encoded whole, and the library's
offsets say where their sentences end. Texts are taken in groups of about ``GROUP`` characters; the table
of a worker's pieces is emptied before it would exceed ``TABLE_BYTES``. Neither changes a result.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np

TABLE_BYTES = 200 << 20
PIECE_BYTES = 190  # of a piece besides its characters and ids: text, number, table slot, arrays
GROUP = 1 << 22
FIRST = "\n\n"  # marks a text's first piece, which has no space before it
# All white space of Python but these two characters, and two that other programs count as such. Looking for one after
# the other is much quicker than a pattern.
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"] + ["\u200b", "\u180e"]
SPACE = "\u0120"  # how the vocabulary writes a space
JOINED = 1000
SENTENCE_ENDS = (".", "!", "?")
STOP = re.compile(r"(?<=[.!?])(?=\s|$)|(?<=.)(?=\n)", re.DOTALL)

_made: dict[str, "WordEncoder"] = {}


def single_spaced(text: str) -> bool:
    """White space is single spaces and line breaks between other characters."""
    return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
                or any(c in text for c in OTHER_SPACE))


def grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, len(array)), array.dtype)])


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(SPACE)]] = True
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.held = 0
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.ends, self.breaks = np.zeros(1 << 14, bool), np.zeros(1 << 14, bool)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def whole_with_ends(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text, and after which of them a sentence or line ends."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        offsets = np.array(found.offsets, np.int64).reshape(-1, 2)
        stops = np.fromiter((m.start() for m in STOP.finditer(text)), np.int64)
        last = np.append(offsets[1:, 0] >= offsets[:-1, 1], True)[:len(offsets)]  # a character may be several tokens
        return np.array(found.ids, np.uint32), np.flatnonzero(last & np.isin(offsets[:, 1], stops)) + 1

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The numbers of different pieces; those that are new are learned."""
        found = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return found
        new = [pieces[k] for k in missing.tolist()]
        size = sum(map(len, new)) * 2 + len(new) * PIECE_BYTES
        if self.held + size > TABLE_BYTES and self.known:
            self.clear()
            missing, new = np.arange(len(pieces)), pieces
            size = sum(map(len, new)) * 2 + len(new) * PIECE_BYTES
        self.held += size
        self.learn(new)
        found[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        return found

    def learn(self, new: list[str]) -> None:
        inner = [p for p in new if p[:1] != "\n"]
        outer = [p for p in new if p[:1] == "\n"]
        # Many pieces behind a space are encoded as one text: a token that starts with a space
        # starts a piece, since pieces have no other space.
        texts = [" " + " ".join(inner[at:at + JOINED]) for at in range(0, len(inner), JOINED)]
        ids = np.concatenate([np.zeros(0, np.uint32), *self.whole(texts)])
        starts = np.flatnonzero(self.spaced[ids])
        self.add(inner, ids, np.diff(starts, append=len(ids)), False)
        found = self.whole([p.removeprefix(FIRST) for p in outer])
        self.add(outer, np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(i) for i in found], np.int64), True)

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray, breaks: bool) -> None:
        first, n = len(self.known), len(self.known) + len(pieces)
        self.start, self.length = grown(self.start, n), grown(self.length, n)
        self.ends, self.breaks = grown(self.ends, n), grown(self.breaks, n)
        self.flat = grown(self.flat, self.used + len(ids))
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[first:n] = self.used + np.cumsum(sizes) - sizes
        self.length[first:n] = sizes
        self.ends[first:n] = [p.endswith(SENTENCE_ENDS) for p in pieces]
        self.breaks[first:n] = breaks
        self.known.update(zip(pieces, range(first, n)))
        self.used += len(ids)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends) of each whole text: its ids, and the positions in them at which a sentence
        or line ends."""
        found, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP:
                found += self.encode_group(group)
                group, size = [], 0
        return found + self.encode_group(group)

    def encode_group(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        import pyarrow as pa
        import pyarrow.compute as pc

        found: list = [None] * len(texts)
        marked, cut = [], []
        for k, text in enumerate(texts):
            if not text:
                found[k] = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            elif not single_spaced(text):
                found[k] = self.whole_with_ends(text)
            else:
                marked.append(FIRST + text.replace("\n", " \n"))
                cut.append(k)
        if not cut:
            return found
        parts = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        counts = pc.list_value_length(parts).to_numpy()
        coded = parts.flatten().dictionary_encode()
        index = self.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sizes = self.length[index]
        after = np.cumsum(sizes)
        before = after - sizes
        ids = self.flat[np.repeat(self.start[index] - before, sizes) + np.arange(int(after[-1]))]
        stop = np.zeros(len(ids) + 1, bool)
        stop[after[self.ends[index]]] = True
        stop[before[self.breaks[index]]] = True
        stops = np.flatnonzero(stop)
        last = np.cumsum(counts) - 1
        text_ends = after[last]
        at = 0
        for k, end in zip(cut, text_ends.tolist()):
            low, high = np.searchsorted(stops, [at, end], "right")
            found[k] = ids[at:end], stops[low:high] - at
            at = end
        return found


def word_encoder(path: str) -> WordEncoder:
    """The encoder of this process for a vocabulary file."""
    if path not in _made:
        _made[path] = WordEncoder(path)
    return _made[path]
