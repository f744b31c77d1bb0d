"""Operator 5, exact dedup by progressive refinement [native]: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, staged, without_space

PREFIX = 64          # characters of the normalised text in the prefix hash


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX,
                digest_all: bool = False) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without their ASCII white space; a
    null text counts as empty. Of equal texts the row with the most code points,
    then the smallest doc_id (null last) stays; of rows that tie in both, one
    stays. Groups are refined on narrow rows: by length, then by the hash of a
    prefix. Only rows that share both with another row get a full digest;
    ``text_sha256`` is null for the others unless ``digest_all`` asks for it.
    Counts and the row that stays come from partial aggregates, so a group of
    copies of any size is never gathered.
    """
    norm = without_space(F.coalesce("text", F.lit("")))
    base = (documents(docs, id_col, text_col)
            .select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("points"), norm.alias("norm"))
            .select("doc_id", "points", "norm", F.length("norm").alias("len"),
                    F.xxhash64(F.substring("norm", 1, prefix)).alias("head")))
    # pass 1 reads the texts for lengths and prefixes only
    counts = staged(base.groupBy("len", "head").agg(F.count(F.lit(1)).alias("n")), "heads")
    by_len = counts.groupBy("len").agg(F.sum("n").alias("n_len")).where("n_len > 1").select("len")
    open_ = counts.join(by_len, "len", "left_semi").where("n > 1").select("len", "head", F.lit(True).alias("open"))
    # pass 2 digests whole texts of the groups still open
    digest = F.sha2("norm", 256)
    if digest_all:               # the caller reads each digest, so no text has to move
        rows = (base.select("doc_id", "points", "len", "head", digest.alias("sha"))
                .join(open_, ["len", "head"], "left"))
    else:
        rows = base.join(open_, ["len", "head"], "left").withColumn("sha", F.when(F.col("open"), digest))
    rows = staged(rows.select("doc_id", "points", "sha", F.coalesce("open", F.lit(False)).alias("open"),
                              F.monotonically_increasing_id().alias("row")), "digests")
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("x"),
                          F.col("doc_id").alias("id"), F.col("row").alias("row")))
    # written first: so the join below reads plain exchanges, of which a hot one can be split
    groups = staged(rows.where("open").groupBy("sha").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
                    .where("n > 1"), "groups")
    return (rows.join(groups, "sha", "left")
            .select("doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents),
w AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY sha ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY sha) AS n
  FROM d)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM w
"""
