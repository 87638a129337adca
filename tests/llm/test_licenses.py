"""Licence scan against a plain comparison of every unit with every template."""

import random
import textwrap
from pathlib import Path

import regex

from ledgerfold.llm import licenses


def plain(text):
    text = text or ""
    lines = text.split("\n")
    units = list(enumerate(lines)) + ([(-1, text)] if len(lines) > 1 else [])
    hits = []
    for n, unit in units:
        words = regex.sub(r"[^\p{L}\p{N}]+", " ", unit.lower()).strip().split(" ")
        own = set(zip(words, words[1:]))
        for name, texts in licenses.TEMPLATES.items():
            for template in texts:
                other = regex.sub(r"[^\p{L}\p{N}]+", " ", template.lower()).strip().split(" ")
                grams = set(zip(other, other[1:]))
                dice = 2 * len(own & grams) / (len(own) + len(grams))
                if 10 * len(own & grams) >= 4 * (len(own) + len(grams)):
                    hits.append((-dice, name, n))
    hits.sort()
    best = hits[0] if hits else None
    return len({h[2] for h in hits}), sorted({h[1] for h in hits}), best and best[1], best and -best[0], best and best[2]


MIT = licenses.TEMPLATES["MIT"][2]
TEXTS = [None, "", "one", "no licence here at all", "x\nReleased under the MIT License.\ny", "released UNDER the  mit-license", MIT, MIT.replace(". ", ".\n"),
         "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.", "word " * 50_000,
         "Licensed under the Apache License, Version 2.1.", "Licensed under the Apache License, Version 2.0. " * 3, "Lizenz ß é\n\n\nLicensed under CC BY 4.0"]


def test_rows(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], "y"), (4, TEXTS[4], "z")],
                                  "doc_id bigint, text string, best string")
    got = licenses.scan(frame).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        want = plain(TEXTS[4 if r.doc_id is None else r.doc_id])
        assert (r.n_matches, r.licenses, r.best, r.best_dice, r.best_line) == want
    assert sum(bool(r.licenses) for r in got) >= 8
    assert licenses.scan(frame.limit(0)).count() == 0


APACHE = licenses.TEMPLATES["Apache-2.0"][1]
GPL = licenses.TEMPLATES["GPL-3.0"][1]


def wrapped(text, mark="", width=79):
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


PROSE = "\n".join(" ".join(f"w{i * 17 % 101} of the v{i}" for i in range(at, at + 10)) for at in range(0, 90, 10))
PASSAGES = [  # text, matches, licences, line of the best
    (wrapped(MIT) + "\n" + PROSE, 1, ["MIT"], 0),
    (PROSE + "\n" + wrapped(MIT) + "\n" + PROSE, 1, ["MIT"], 9),
    (PROSE + "\n" + wrapped(MIT) + "\n" + PROSE + "\n" + wrapped(MIT) + "\n" + PROSE, 2, ["MIT"], 9),
    (wrapped(APACHE, "# ", 60) + "\n" + PROSE, 1, ["Apache-2.0"], 0),
    ("def f():\n" + wrapped(GPL, " * ", 50) + "\n" + PROSE, 1, ["GPL-3.0"], 1),
    ("Notes on this. Licensed under CC BY-NC 4.0. Contact the authors of the paper for more of the data.", 1, ["CC-BY-NC-4.0"], 0),
    (PROSE + " Released under\nthe MIT License. " + PROSE + " Licensed under CC BY 4.0. " + PROSE, 2, ["CC-BY-4.0", "MIT"], 17),
    (PROSE + "\n" + wrapped(MIT[:len(MIT) // 2]) + "\n" + PROSE, 0, [], None),
]


def test_passages_inside_texts_and_lines(spark):
    frame = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PASSAGES)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(frame).collect()}
    for i, (_, n, names, line) in enumerate(PASSAGES):
        assert (got[i].n_matches, got[i].licenses, got[i].best_line) == (n, names, line), i


def test_no_window_is_missed(spark):
    rng, words = random.Random(4), licenses.plain_words(licenses.TEMPLATES["ISC"][0])
    texts = []
    for _ in range(60):
        part = [f"x{rng.randrange(9)}" if rng.random() < 0.1 else w for w in words if rng.random() > 0.05]
        texts.append(" ".join([f"y{k}" for k in range(40)] + part + [f"z{k}" for k in range(40)]))
    only = {"ISC": [licenses.TEMPLATES["ISC"][0]]}
    grams = set(licenses.plain_bigrams(only["ISC"][0]))

    def windows(text):
        own = [f"{a} {b}" for a, b in zip(text.split(), text.split()[1:])]
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                shared = set(own[i:j]) & grams
                yield 2 * len(shared) / (len(shared) + sum(g not in grams for g in own[i:j]) + len(grams))

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(frame, templates=only).collect()}
    hits = [max(windows(t)) >= 0.8 for t in texts]
    assert [bool(got[i].licenses) for i in range(60)] == hits and 5 < sum(hits) < 55


def test_whole_bodies(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    bodies = {f.stem: f.read_text(encoding="utf-8") for f in folder.glob("*.txt")} | {"MIT": MIT}
    assert set(licenses.TEMPLATES) - set(bodies) == {"CC-BY-4.0", "CC-BY-NC-4.0"}
    short = ["ISC", "BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Apache-2.0"]
    texts = [(name, body) for name, body in bodies.items()] + [(name, PROSE + "\n" + bodies[name] + "\n" + PROSE) for name in short]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id bigint, text string")
    for r in licenses.scan(frame).collect():
        assert r.best == texts[r.doc_id][0] and r.best_dice > (0.97 if r.doc_id < len(bodies) else 0.8)
