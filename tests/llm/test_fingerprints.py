"""Fingerprints against a plain vote, edited texts, and the search against all pairs."""

import hashlib
import math
import random

import xxhash
from pyspark.sql import functions as F

from ledgerfold.llm import fingerprints as fp

DOCS = [(1, "One two three four five"), (2, "one two three four six"), (5, ""), (6, None), (9, "solo"), (12, "déjà vu 日本 🙂🙂 x"),
        (20, "w " * 20_000), (21, " \n\t"), (25, "abcdefghijklmnopqrst uvwxyzabcdefghijk " * 4000), (30, "last text of all here")]


def plain_print(text):
    words = text.lower().split()
    votes, total = [0] * 128, 0
    for i, a in enumerate(words):
        b = words[i + 1] if i + 1 < len(words) else None
        chain = lambda *xs: _chain(xs)
        h, g = chain(a, b), chain(a, b, a)
        w = min(32, len(a) + len(b or ""))
        total += w
        for k in range(64):
            votes[64 + k] += w * (h >> k & 1)
            votes[k] += w * (g >> k & 1)
    return sum(1 << k for k in range(128) if votes[k] * 2 > total)


def _chain(parts):
    seed = 42
    for part in parts:
        if part is not None:
            seed = xxhash.xxh64(part.encode(), seed=seed).intdigest()
    return seed


def like(a, b):
    apart = (a ^ b).bit_count()
    return max(0.0, math.cos(math.pi * apart / 128)) if apart else 1.0


def test_contract_rows(spark):
    frame = spark.createDataFrame([(d, t, 3, "z") for d, t in DOCS] + [(9, "solo", 1, "y")], "doc_id bigint, text string, n_chars int, h string")
    got = fp.edited_fingerprints(frame).collect()
    assert len(got) == len(DOCS) + 1
    texts = [(d, t or "") for d, t in DOCS]
    want = {}
    for (d, t), (_, n) in zip(texts, texts[1:] + texts[:1]):
        edited = t[:len(t) - len(t) // 4] + n[:len(t) // 4]
        a, e, b = plain_print(t), plain_print(edited), plain_print(n)
        want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:032x}", f"{e:032x}", like(a, e), like(a, b))
    for r in got:
        w = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == w[:4], r.doc_id
        assert abs(r.near_edited - w[4]) < 1e-9 and abs(r.near_next - w[5]) < 1e-9


def test_odd_ids(spark):
    frame = spark.createDataFrame([(None, "no id"), (0, "zero"), (3, "b"), (3, "a")], "doc_id bigint, text string")
    got = fp.edited_fingerprints(frame).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == [(False, 0, 4), (False, 3, 1), (False, 3, 1), (True, 0, 5)]
    first = next(r for r in got if r.doc_id is None)
    assert first.edited_sha256 == hashlib.sha256(b"no iz").hexdigest()
    assert fp.edited_fingerprints(frame.limit(0)).count() == 0
    single = fp.edited_fingerprints(frame.where("doc_id = 0")).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"zerz").hexdigest()


def test_search_misses_none(spark):
    rng, values = random.Random(4), []
    for _ in range(12):
        base = rng.getrandbits(128)
        for _ in range(20):
            v = base
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.randrange(128)
            values += [v] * rng.choice([1, 1, 2])
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(i, signed(v >> 64), signed(v & (2**64 - 1))) for i, v in enumerate(values)], "id bigint, hi bigint, lo bigint")
    for radius in (0, 2, 3):
        got = sorted(tuple(r) for r in fp.within_radius(frame.where(F.col("id") % 20 == 0), frame, radius).collect())
        want = sorted((q, i, (values[q] ^ v).bit_count()) for q in range(0, len(values), 20) for i, v in enumerate(values)
                      if i != q and (values[q] ^ v).bit_count() <= radius)
        assert got == want and (radius == 0 or len(want) > 20)
