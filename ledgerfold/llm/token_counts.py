"""Token counts through a digest cache.

The cache is a table of (tokenizer, digest, n_tokens): the digest of the tokenizer's file and name,
the digest of a normalised content, and its count. Documents are joined with it on both; only
different contents that are not in it are encoded, once each, and appended. Copies are combined
before the shuffle, so a text that a third of all rows share is one row per task there.

The normalisation must not change a count. The default turns null into the empty text and changes
nothing else, which holds for every tokenizer; ``normalise`` takes another rule.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import small_batches, whole_text
from ledgerfold.sources.scratch import new_path, written

LIMIT = 4096
CACHE = "tokenizer string, digest binary, n_tokens bigint"
_loaded: dict = {}


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts of whole texts by the library the file is for, without begin, end or special tokens."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            _loaded[path] = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return _loaded[path]


def tokenizer_digest(path: str) -> str:
    """Names a tokenizer by its file's content."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def digest(col: Column) -> Column:
    """128 of the bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(col, 256)), 1, 16)


def read_cache(spark, path: str) -> DataFrame:
    """The cache at a path; empty where nothing has been written yet."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)
    return spark.read.schema(CACHE).parquet(path)


def append_misses(docs: DataFrame, tokenizer: str, cache_path: str, text_col: str = "text",
                  normalise: Callable[[Column], Column] = lambda c: c) -> None:
    """Encodes the different contents of ``docs`` that the cache lacks and appends their counts."""

    def run(batches):
        import pyarrow as pa

        count = counter(tokenizer)
        for batch in batches:
            found = pa.array(count(batch.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["digest", "n_tokens"])

    spark = docs.sparkSession
    small_batches(spark)
    name = tokenizer_digest(tokenizer)
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == name).select("digest")
    text = normalise(whole_text(text_col)).alias("content")
    contents = docs.select(text).select(digest(F.col("content").cast("binary")).alias("digest"), "content")
    missing = contents.groupBy("digest").agg(F.first("content").alias("content")).join(known, "digest", "left_anti")
    counts = missing.select("digest", "content").mapInArrow(run, "digest binary, n_tokens bigint")
    counts.select(F.lit(name).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path)


def token_counts(docs: DataFrame, tokenizer: str, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    ``cache_path`` keeps counts between calls; without it the cache starts empty in the shared
    folder. A null text is empty and has no tokens; repeated rows and texts get the same count; a
    null doc_id stays null; texts are encoded whole whatever their length. Other columns are not read.
    """
    spark = docs.sparkSession
    path = cache_path or new_path(spark, "token-cache")
    append_misses(docs, tokenizer, path, text_col, normalise)
    # Writers that met at the same miss may both have appended it. Written, so that the join reads a plain table and adaptive execution can split a digest that
    # very many rows share.
    known = written(spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == tokenizer_digest(tokenizer))
                    .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                       digest(normalise(text).cast("binary")).alias("digest"))
    return rows.join(known, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
