"""The registered queries of this folder: whole tables, production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from ledgerfold.llm import bilinear, fingerprints, licenses, line_dedup, near_dup, packing, piece_codec, quality, ranked, runs, style_tree, token_counts, topk
from ledgerfold.llm.common import table


def op1_html_extraction(spark, sf_dir):
    return style_tree.extract(table(spark, sf_dir, "pages"))


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).withColumn("licenses", F.array_join("licenses", ","))


def op4_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op5_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_piece_codec(spark, sf_dir):
    return piece_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_periodic_runs(spark, sf_dir):
    return runs.run_digests(runs.find_runs(table(spark, sf_dir, "documents"), edit=runs.with_repeated_tail))


def op12_ranked_search(spark, sf_dir):
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_lm_scoring(spark, sf_dir):
    return bilinear.score_texts(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_token_counts, op3_license_scan, op4_quality_classifier, op5_exact_top_k, op6_line_dedup, op7_packing, op8_fingerprints, op9_simhash_near_dedup, op10_piece_codec,
                                   op11_periodic_runs, op12_ranked_search, op13_lm_scoring, pipeline)}
