"""Landed JSON responses: envelope unwrapping and page-stop rules.

A response document is one line of a text file. Its rows are the array under
``data``, else ``results``, else ``items`` (an object there is one row); a bare
array is the rows; a bare object is one row; a scalar or an empty line gives no
rows. Documents that do not parse are kept apart or fail the read. Parsing is ``from_json`` with the
row schema (JVM-side); nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.nulls import nan_to_null

ENVELOPE_KEYS = ("data", "results", "items")
POST_ENVELOPE_KEYS = ("data",)            # responses of POST requests only use "data"
# Microsecond timestamps (the default JSON format keeps milliseconds only).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


SCALAR = r'^\s*(null|true|false|-?\d+(\.\d+)?([eE][+-]?\d+)?|"([^"\\]|\\.)*")?\s*$'


def _parsed(text: Column, field: str, row_schema: StructType) -> Column:
    """struct<rows, bad> of the rows under ``field``; bad if anything of it does not fit the schema."""
    schema = StructType([StructField(field, ArrayType(row_schema)), StructField("__bad", StringType())])
    p = F.from_json(text, schema, {**JSON_OPTIONS, "columnNameOfCorruptRecord": "__bad"})
    return F.struct(p[field].alias("rows"), p["__bad"].isNotNull().alias("bad"))


def unwrap(doc: Column, row_schema: StructType, keys: tuple[str, ...] = ENVELOPE_KEYS) -> Column:
    """struct<rows: array<row>, bad: boolean> of one response document (string column).

    ``keys`` are the envelope fields; the first one that is present counts, whatever
    its value: an array is the rows, an object one row, null no rows. ``bad`` marks a
    document that is no JSON or whose rows do not fit ``row_schema``."""
    start = F.ltrim(doc)
    present = F.json_object_keys(doc)                       # NULL unless doc is a whole object
    in_list = lambda x: _parsed(F.concat(F.lit('{"rows":['), x, F.lit("]}")), "rows", row_schema)
    none = F.struct(F.array().cast(ArrayType(row_schema)).alias("rows"), F.lit(False).alias("bad"))
    broken = F.struct(F.array().cast(ArrayType(row_schema)).alias("rows"), F.lit(True).alias("bad"))
    out = F.when(start.startswith("["), _parsed(F.concat(F.lit('{"rows":'), doc, F.lit("}")), "rows", row_schema))
    out = out.when(start.startswith("{") & present.isNull(), broken)
    for k in keys:
        value = F.get_json_object(doc, f"$.{k}")
        here = F.array_contains(present, k)
        out = out.when(here & value.startswith("{"), in_list(value)).when(here, _parsed(doc, k, row_schema))
    return out.when(start.startswith("{"), in_list(doc)).when(doc.rlike(SCALAR), none).otherwise(broken)


def read_responses(spark: SparkSession, path: str, row_schema: StructType, keep_doc_columns=(),
                   keys: tuple[str, ...] = ENVELOPE_KEYS, corrupt_column: str | None = None) -> DataFrame:
    """The rows of all response documents under ``path``; NaN counts as missing (N3).

    A document that is broken, or of which a value does not fit ``row_schema``,
    fails the read. With ``corrupt_column`` it becomes one row instead, with its
    text in that column and the others NULL; none of its rows is returned."""
    docs = spark.read.text(path).select(*keep_doc_columns, "value", unwrap(F.col("value"), row_schema, keys).alias("__u"))
    bad = F.col("__u.bad")
    if corrupt_column is None:
        message = F.concat(F.lit("response document that does not fit the schema: "), F.substring("value", 1, 200))
        docs = docs.withColumn("__rows", F.when(bad, F.raise_error(message)).otherwise(F.col("__u.rows")))
        rows = docs.select(*keep_doc_columns, F.explode("__rows").alias("__r")).select(*keep_doc_columns, "__r.*")
    else:
        one = F.array(F.lit(None).cast(row_schema))
        docs = docs.withColumn("__rows", F.when(bad, one).otherwise(F.col("__u.rows")))
        rows = docs.select(*keep_doc_columns, F.when(bad, F.col("value")).alias(corrupt_column),
                           F.explode("__rows").alias("__r"))
        rows = rows.select(*keep_doc_columns, "__r.*", corrupt_column)
    return nan_to_null(rows, row_schema.fieldNames())


def paginate(pages: DataFrame, page_column: str, limit: int = 100, max_pages: int | None = None) -> DataFrame:
    """Rows of pages 1..max_pages (default: all) up to the first short or empty page (kept, as the
    client appends it before stopping) or the first missing page (not kept).

    ``pages`` holds one row per record with its page number. The stop page comes
    from the per-page counts (one row per page, one more than the last page at most)."""
    max_pages = max_pages or (1 << 31) - 2
    counts = (pages.where(F.col(page_column).between(1, max_pages))
              .groupBy(page_column).agg(F.count(F.lit(1)).alias("__n")))
    spine = counts.agg(F.max(page_column).alias("__hi")).select(
        F.explode(F.sequence(F.lit(1), F.least(F.coalesce(F.col("__hi") + 1, F.lit(1)), F.lit(max_pages))))
        .alias(page_column))
    per_page = spine.join(counts, page_column, "left")
    stop = per_page.agg(
        F.min(F.when(F.col("__n").isNotNull() & (F.col("__n") < limit), F.col(page_column))).alias("short"),
        F.min(F.when(F.col("__n").isNull(), F.col(page_column))).alias("missing")).take(1)[0]   # one row
    p = F.col(page_column)
    keep = (p >= 1) & (p <= max_pages)
    if stop["short"] is not None:
        keep = keep & (p <= stop["short"])
    if stop["missing"] is not None:
        keep = keep & (p < stop["missing"])
    return pages.where(keep)
