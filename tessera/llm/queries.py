"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (chunk_dedup, decontaminate, exact_dedup, html_extract, line_dedup, merkle, packing, quality, sharding,
               simhash, token_counts, warc, whitening)

TOKENIZER = "byte_bpe_50k.json"
PASSAGE = 100        # op2: bytes of the shortest passage; copies of whole documents count whatever their length


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_substring_dedup(spark, sf_dir):
    return chunk_dedup.repeated_runs(_table(spark, sf_dir, "documents"), shortest=PASSAGE)


def op3_simhash(spark, sf_dir):
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op4_sharding(spark, sf_dir):
    return sharding.balanced_shards(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), digest_all=True)


def op6_quality(spark, sf_dir):
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_decontamination(spark, sf_dir):
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_html_extraction(spark, sf_dir):
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def op9_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_warc(spark, sf_dir):
    return warc.archived_pages(_table(spark, sf_dir, "pages"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_merkle(spark, sf_dir):
    return merkle.merkle_manifest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_substring_dedup, op3_simhash, op4_sharding, op5_exact_dedup, op6_quality,
                            op7_decontamination, op8_html_extraction, op9_line_dedup, op10_packing, op11_warc, op12_whitening, op13_merkle)}

ORACLES = {"op5_exact_dedup": exact_dedup.SQL, "op9_line_dedup": line_dedup.SQL, "op11_warc": warc.SQL,
           "op13_merkle": merkle.SQL}
