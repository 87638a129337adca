"""Packing: every id in one piece, sequences without gaps, cuts as cheap as a plain program's."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerfold.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, "a", "One. Two!\nThree", " lead", "trail ", "two  spaces", "tab\there", "a\n\nb", "nb\xa0sp", "<|endoftext|> in <|endoftext|>x",
       "it's we'll\n'tis", "déjà vu — ok", "\x1c", "word " * 3000 + "end", "x" * 9000, "A. " * 900 + "B", "日本語 テキスト\nです", "a\x85b c", "zero​width b"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_word_table_gives_the_library_s_ids(plain):
    encoder = bpe.WordEncoder(PATH)
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("ab. \n'1é!") for _ in range(60)) for _ in range(300)]
    for (ids, ends), text in zip(encoder.encode(texts), texts):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert all(0 <= e <= len(ids) for e in ends)


@pytest.mark.parametrize("text", ["One. Two! Three?\nFour. End", "One.  Two! Three?\n\nFour. End", " One.\tTwo! Three?\nFour. End "])
def test_sentences_end_in_every_text(plain, text):
    """After the token of each stop, whatever the white space; also after a line without one."""
    (ids, ends), = bpe.WordEncoder(PATH).encode([text])
    pieces = [plain.decode(ids[a:b].tolist()).strip() for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(ids)])]
    assert [x for x in pieces if x] == ["One.", "Two!", "Three?", "Four.", "End"]


def test_small_table_gives_the_same_ids(plain, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_BYTES", 2000)
    monkeypatch.setattr(bpe, "GROUP", 50)
    encoder, rng = bpe.WordEncoder(PATH), random.Random(4)
    texts = [" ".join(rng.choice(["one", "two.", "été", "three!"]) + str(rng.randrange(40)) for _ in range(30)) for _ in range(40)]
    for (ids, _), text in zip(encoder.encode(texts), texts):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert encoder.held < 40_000 and len(encoder.known) < 160


@pytest.mark.parametrize("block", [1 << 18, 1500])
def test_pieces(spark, plain, block):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)] + [(3, ODD[3], 7), (None, "no id", 7)],
                                 "doc_id bigint, text string, offset int").repartition(3)
    rows = packing.pack(docs, PATH, block=block).collect()
    ids = {i: plain.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(ODD)}
    ids[None] = plain.encode("no id", add_special_tokens=False).ids + [0]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(piece) > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, found in pieces.items():
        whole = [k for s, n in found for k in range(s, s + n)]
        times = 2 if d == 3 else 1
        assert sorted(whole) == sorted(list(range(len(ids[d]))) * times)
    for found in sequences.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= 1024


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        size = 64
        doc_ends = np.cumsum([rng.randrange(1, 150) for _ in range(rng.randrange(1, 8))])
        stops = np.array(sorted(rng.sample(range(1, int(doc_ends[-1]) + 1), min(int(doc_ends[-1]), 9))))
        at, penalty = packing.candidates(doc_ends, stops, size)
        cuts = packing.best_cuts(at, penalty, size)

        def price(path):
            return sum(packing.padding(b - a, size) + packing.SEQUENCE_COST + penalty[at.index(b)] for a, b in zip([0, *path], path))

        assert all(b - a <= size for a, b in zip([0, *cuts], cuts)) and cuts[-1] == at[-1]
        assert price(cuts) <= least_without_small_powers(at, penalty, size)


def least_without_small_powers(at, penalty, size):
    """Plain quadratic program in which only the powers of two that the operator tries are free."""
    free = {1 << k for k in range(min(packing.LEAST_POWER, size.bit_length() - 1), size.bit_length())}
    least = [0]
    for j in range(1, len(at)):
        least.append(min(least[i] + (0 if at[j] - at[i] in free else size - (at[j] - at[i])) + packing.SEQUENCE_COST + penalty[j]
                         for i in range(j) if at[j] - at[i] <= size))
    return least[-1]


def test_closing_cuts():
    for n in range(1, 1025):
        parts = packing.closing_cuts(n)
        assert sum(parts) == n
        cost = sum(map(packing.padding, parts)) + (len(parts) - 1) * (packing.INSIDE_PENALTY + packing.SEQUENCE_COST)
        assert cost <= packing.padding(n)


def test_each_different_piece_is_looked_up_once(plain):
    class Counting(dict):
        looked_up = 0

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

    encoder, text = bpe.WordEncoder(PATH), "one two. three\n" * 500 + "end"
    want = plain.encode(text, add_special_tokens=False).ids
    assert encoder.encode([text])[0][0].tolist() == want
    encoder.known = Counting(encoder.known)
    assert encoder.encode([text])[0][0].tolist() == want
    assert encoder.known.looked_up < 10


def test_partners_a_power_before():
    partners, until = packing.power_partners([0, 64, 70, 128, 134], [64, 128])
    assert [partners[a:b] for a, b in zip([0, *until], until)] == [[], [0], [], [1, 0], [2]]


def test_a_group_of_new_pieces_is_gone_through_once(plain):
    """Known pieces of a group with new ones are not looked up a second time."""
    class Counting(dict):
        asked = 0

        def get(self, key, other=None):
            self.asked += 1
            return super().get(key, other)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            self.asked += 1
            return super().__contains__(key)

    encoder = bpe.WordEncoder(PATH)
    known = " ".join(f"w{i}" for i in range(500))
    encoder.encode([known])
    encoder.known = Counting(encoder.known)
    text = "newest " + known + " newer"
    assert encoder.encode([text])[0][0].tolist() == plain.encode(text, add_special_tokens=False).ids
    assert encoder.known.asked <= 510


@pytest.mark.parametrize("seed", range(5))
def test_candidates_are_those_of_sorted_sets(seed):
    rng, size = random.Random(seed), 64
    doc_ends = np.cumsum([rng.randrange(1, 400) for _ in range(9)])
    stops = np.array(sorted(rng.sample(range(1, int(doc_ends[-1])), 8)))
    ends = sorted({0, *doc_ends.tolist(), *stops.tolist()})
    want = {*ends, *(e + size for e in ends if e + size < ends[-1])}
    for a, b in zip(ends, ends[1:]):
        want |= set(range(a + size, b, size))
    at, penalty = packing.candidates(doc_ends, stops, size)
    assert at == sorted(want)
    assert penalty == [0 if a in set(doc_ends.tolist()) else 2 if a in ends else 12 for a in at]
