"""The stages one by one against plain programs on their own input, and the whole run."""

from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerfold.llm import quality
from ledgerfold.llm.packing import padding
from tests.conftest import SF
from tests.llm.test_line_dedup import plain_removed
from tests.llm.test_near_dup import plain_components, plain_simhash


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            keep = {r.doc_id for r in before if model.score(np.array([quality.statistics((r.text or "").encode())]))[0] >= 0.7}
            assert sorted(map(str, after)) == sorted(str(r) for r in before if r.doc_id in keep)
            bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 0}
            assert len(bad & {r.doc_id for r in after}) <= 0.1 * len(bad) and 0 < len(after) < len(before)
        elif name == "line_dedup":
            gone = plain_removed([(r.doc_id, r.text) for r in before])
            want = {r.doc_id: "\n".join(x for i, x in enumerate(r.text.split("\n")) if (r.doc_id, i) not in gone) for r in before}
            assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after) and len(gone) > 10
        elif name == "near_dedup":
            prints = {r.doc_id: plain_simhash(r.text) for r in before}
            root = plain_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
            first = {}
            for d in sorted(prints):
                first.setdefault(root[prints[d]], d)
            assert sorted(r.doc_id for r in after) == sorted(first.values()) and len(after) < len(before)
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            sizes = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}
            got, sequences = defaultdict(int), defaultdict(int)
            for r in after:
                got[r.doc_id] += r.length
                sequences[r.sequence_id] += r.length
            assert got == sizes and max(sequences.values()) <= 1024
            assert sum(map(padding, sequences.values())) < 0.03 * sum(sizes.values())
        before = after


CLASHING = "doc_id bigint, text string, n_chars bigint, _gone string, _lines int, _doc int, _marks string, _GONE_ int, fp string, component_id int, _bytes_of_text int, __doc int"


def odd_documents(spark):
    texts = [None, "", "one line of words here\nanother line of words", "one line of words here\nanother line of words", "w " * 3000, "a\nb"]
    rows = [(i, t, len(t or ""), "g", 1, 2, "m", 3, "f", 4, 5, 6) for i, t in enumerate(texts)]
    rows += [rows[2], (None, "text without an id\none line of words here", 9, "g", 1, 2, "m", 3, "f", 4, 5, 6), (None, None, 0, "g", 1, 2, "m", 3, "f", 4, 5, 6)]
    return spark.createDataFrame(rows, CLASHING)


def test_stages_keep_other_columns(spark):
    """Columns of the user stay as they are, whatever their names; nulls, repeated rows and very long
    texts pass every stage."""
    docs = odd_documents(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert {tuple(r) for r in out.select(*others).collect()} <= {("g", 1, 2, "m", 3, "f", 4, 5, 6)}
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()
    got = sorted((r.doc_id, r.text) for r in lines if r.doc_id is not None and r.doc_id in (2, 3, 5))
    # the row without an id comes before all others, so its line is the first
    assert got == [(2, "another line of words"), (2, "another line of words"), (3, ""), (5, "a\nb")]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [0, 2, 2, 4, 5]
    assert corpus_pipeline.pack_sequences(spark, docs, SF).where("doc_id IS NULL").count() >= 2


def test_stages_of_an_empty_table(spark):
    empty = odd_documents(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
