"""Helpers shared by the operators: staged tables and safe column handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path

ASCII_SPACE = " \t\n\x0b\x0c\r"      # [\x20\x09-\x0D]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of the cluster and read it back.

    Cuts the lineage so that later steps (and a lost executor) read the written
    rows instead of recomputing them; the folder is under ``spark.checkpoint.dir``.
    """
    spark: SparkSession = df.sparkSession
    path = staging_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only (null text stays null); other columns, whatever their names, are left behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def without_space(text):
    """The text without any character of ``[\\x20\\x09-\\x0D]``."""
    for ch in ASCII_SPACE:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text
