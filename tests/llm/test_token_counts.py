"""Token counts: the libraries' own, and what the cache holds."""

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerfold.llm import token_counts as tc

TEXTS = ["", None, "a b", "a b", "<s> </s> <unk>", "  two  spaces\n", "déjà 日本語 🙂", "word " * 30_000, "\x00\x01", "ﬁ ｆｕｌｌ"]
ROWS = [(i, t, -1) for i, t in enumerate(TEXTS)] + [(3, "a b", -1), (None, "no id", -1)]


def rows(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string, n_tokens int")


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith("model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {i: len(model.encode(t or "")) for i, t, _ in ROWS}
    else:
        model = Tokenizer.from_file(path)
        want = {i: len(model.encode(t or "", add_special_tokens=False).ids) for i, t, _ in ROWS}
    got = tc.token_counts(rows(spark), path).collect()
    assert len(got) == len(ROWS)
    texts = {i: t or "" for i, t, _ in ROWS}
    for r in got:
        assert r.n_tokens == want[r.doc_id] and r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 4096)
    assert tc.token_counts(rows(spark).limit(0), path).count() == 0


def test_only_new_contents_are_encoded(spark, tmp_path):
    path, cache = public_tokenizers.path("piece_bpe_32k.model"), str(tmp_path / "cache")
    docs = rows(spark)
    first = sorted(map(str, tc.token_counts(docs, path, cache).collect()))
    different = len({t or "" for _, t, _ in ROWS})
    assert spark.read.parquet(cache).count() == different
    assert sorted(map(str, tc.token_counts(docs, path, cache).collect())) == first
    assert spark.read.parquet(cache).count() == different
    more = docs.union(spark.createDataFrame([(50, "new text", 0)], docs.schema))
    tc.token_counts(more, path, cache).collect()
    assert spark.read.parquet(cache).count() == different + 1
    # Counts come from the cache; another tokenizer does not see them.
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(7).cast("bigint")).write.parquet(str(tmp_path / "other"))
    assert {r.n_tokens for r in tc.token_counts(docs, path, str(tmp_path / "other")).collect()} == {7}
    tc.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), cache).collect()
    assert spark.read.parquet(cache).groupBy("tokenizer").count().count() == 2
