"""Log scans over a folder of text logs in the format
``YYYY-MM-DD HH:MM:SS - name - LEVEL - module:func:line - message``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.time import parse_ntz, wall_text

# Level names in increasing severity.
LEVELS = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"]
CHUNK = 1 << 15                  # lines of a split handled as one window
SHARE = 16 << 20                 # bytes of log text for each task of the windows (about)
LINE_FORMAT = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - (.*?) - ([A-Z]+) - (.*?) - (.*)$"


def format_line(ts, name, level, location, message):
    """Columns → one log line in the format above."""
    return F.concat_ws(" - ", wall_text(ts), name, level, location, message)


def _listing(spark: SparkSession, path: str, glob: str = "*", below: bool = False) -> DataFrame:
    """``path, modificationTime, length`` of the files (metadata only); ``below`` goes into subfolders."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(below).lower())
            .load(path).select("path", "modificationTime", "length"))


def newest_file(spark: SparkSession, folder: str, glob: str = "*", rolled: bool = False) -> str | None:
    """Path of the most recently modified file (metadata listing only).

    With ``rolled`` every subfolder is one log, cut into parts that go on in the
    order of their names, and the path is that of the newest such subfolder.
    """
    log = F.regexp_replace("path", "/[^/]*$", "") if rolled else F.col("path")
    row = (_listing(spark, folder, glob, rolled).groupBy(log.alias("log")).agg(F.max("modificationTime").alias("at"))
           .orderBy(F.col("at").desc(), F.col("log").desc()).select("log").first())
    return row["log"] if row else None


def scan(spark: SparkSession, path: str, min_level: str = "INFO", tail: int | None = None,
         newest_only: bool = False) -> DataFrame:
    """Lines that contain a level name at or above ``min_level`` (DEBUG keeps every
    line), parsed into (ts, logger, level, location, message, line). ``tail``
    keeps the last n lines by timestamp (top-k, not a sort of the whole log)."""
    src = newest_file(spark, path) if newest_only else path
    lines = spark.read.text(src).withColumnRenamed("value", "line")
    lvl = min_level.upper()
    if lvl != "DEBUG":
        allowed = LEVELS[LEVELS.index(lvl):]
        lines = lines.where(F.col("line").rlike("|".join(allowed)))
    parsed = lines.select(
        parse_ntz(F.regexp_extract("line", LINE_FORMAT, 1), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.regexp_extract("line", LINE_FORMAT, 2).alias("logger"),
        F.regexp_extract("line", LINE_FORMAT, 3).alias("level"),
        F.regexp_extract("line", LINE_FORMAT, 4).alias("location"),
        F.regexp_extract("line", LINE_FORMAT, 5).alias("message"),
        "line")
    if tail is not None:
        parsed = parsed.orderBy(F.col("ts").desc_nulls_last(), F.col("line").desc()).limit(tail)
    return parsed


def _allowed(min_level: str) -> list[str] | None:
    """Level names at or above ``min_level``; None where every line passes (DEBUG)."""
    level = min_level.upper()
    return None if level == "DEBUG" else LEVELS[LEVELS.index(level):]


def _with_fields(df: DataFrame, line: str, out: str, where: Column) -> DataFrame:
    """``out``: struct ``ts, logger, level, location, message`` of the lines in the format (``where``), else NULL.

    A line is cut at its separators, which is what LINE_FORMAT matches wherever the
    third part is a level; other lines go through the expression itself.
    """
    part = lambda k: F.get("__cut", F.lit(k))
    plain = (F.size("__cut") == 5) & part(2).rlike(r"^[A-Z]+\z")
    for end in "\u0085\u2028\u2029":                           # line ends to an expression, not to the text source
        plain = plain & ~F.contains(line, F.lit(end))
    day = F.substring(line, 1, 19)
    ts = F.when(~day.startswith("0000"), day.try_cast("timestamp_ntz")).alias("ts")
    names = ("logger", "level", "location", "message")
    fields = (F.when(plain, F.struct(ts, *[part(k + 1).alias(n) for k, n in enumerate(names)]))
              .otherwise(F.struct(ts, *[F.regexp_extract(line, LINE_FORMAT, k + 2).alias(n) for k, n in enumerate(names)])))
    return (df.withColumn("__cut", F.when(where, F.split(line, " - ", 5)))       # its own step: cut once, used five times
            .withColumn(out, F.when(where, fields)).drop("__cut"))


def records(spark: SparkSession, path: str, rolled: bool = False) -> DataFrame:
    """Every line of the logs under ``path`` with the fields of the record it belongs to:
    ``file, block, pos, ts, logger, level, location, message, line, continues``.

    A line that is not in the log's format (a traceback, a second line of a message)
    goes on with the last record before it in its file (with ``rolled``: in the files in
    order of their names, which are one log), and ``continues`` is true. Lines before the
    first record have null fields. (file, block, pos) is the order of the lines: the
    split's first byte and the position inside it. Files in subfolders are read too.

    A window covers at most ``CHUNK`` lines of a split, and one row a chunk carries its
    last record over to the next ones. The number of tasks follows the bytes of
    the logs, so neither a file nor a task's share of the lines grows with them.
    Both reads number the lines alike: the numbers keep filters from reaching the scan.
    """
    size = _listing(spark, path, below=True).agg(F.sum("length").alias("n")).first()["n"] or 0
    tasks = max(1, -(-size // SHARE))
    lines = (spark.read.option("recursiveFileLookup", "true").text(path)
             .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
             .withColumns({"chunk": F.floor(F.col("pos") / CHUNK), "is_head": F.col("line").rlike(LINE_FORMAT)}))
    key = ["chunk", "block", "file"]
    before = (Window.partitionBy(*([] if rolled else ["file"])).orderBy("file", "block", "chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = (lines.groupBy(*key).agg(F.max(F.when(F.col("is_head"), F.struct("pos", "line"))).alias("end"))
             .select(*key, F.last("end.line", ignorenulls=True).over(before).alias("last")))
    carry = _with_fields(carry, "last", "carried", F.col("last").isNotNull()).drop("last")
    inside = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    whole = (_with_fields(lines, "line", "head", F.col("is_head")).repartition(tasks, *key)
             .withColumn("own", F.last("head", ignorenulls=True).over(inside)).join(carry, key)
             .withColumn("record", F.coalesce("own", "carried")))
    return whole.select("file", "block", "pos", "record.ts", "record.logger", "record.level", "record.location",
                        "record.message", "line", (~F.col("is_head")).alias("continues"))


def tail(spark: SparkSession, folder: str, lines: int = 50, min_level: str = "INFO", glob: str = "*",
         whole_records: bool = False, rolled: bool = False) -> DataFrame:
    """The last ``lines`` lines, in file order, of the newest file of ``folder`` (none: no rows);
    with ``rolled``, of its newest subfolder, the files of which are one log.

    A line passes if it contains a level name at or above ``min_level`` (DEBUG: every
    line). With ``whole_records`` the level of its record decides instead, so
    tracebacks stay with their error. Columns: those of ``records`` without the order.
    """
    newest = newest_file(spark, folder, glob, rolled)
    if newest is None:
        out = spark.createDataFrame([], "file string, block long, pos long, ts timestamp_ntz, logger string, level string, "
                                        "location string, message string, line string, continues boolean")
    else:
        out = records(spark, newest, rolled)
        allowed = _allowed(min_level)
        if allowed:
            out = out.where(F.col("level").isin(allowed) if whole_records else F.col("line").rlike("|".join(allowed)))
    order = ["file", "block", "pos"]
    last = out.orderBy(*[F.col(c).desc() for c in order]).limit(lines)
    return last.orderBy(*order).drop(*order)
