"""From raw documents to packed training sequences, stage by stage.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame`` and works on all rows its
predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, packing, quality, simhash
from tessera.llm.common import staged
from tessera.session import ship_package

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship_package(spark)
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go; ``n_chars`` follows the text."""
    ship_package(spark)
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one document stays."""
    ship_package(spark)
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences of at most 1024 tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality", good_quality), ("line_dedup", without_repeated_lines), ("simhash", one_of_near_copies),
          ("decontamination", without_benchmark), ("packing", packed)]

#: SQL can't express the classifier or the packing; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
