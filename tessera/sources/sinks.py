"""Sinks: CSV report tables, bundles of named tables with a manifest, file manifests."""

from __future__ import annotations

import hashlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, **options) -> None:
    w = df.write.mode(mode).option("header", str(header).lower())
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)


def write_bundle(spark: SparkSession, tables: dict[str, DataFrame], folder: str, fmt: str = "parquet",
                 mode: str = "overwrite") -> DataFrame:
    """Write several named tables, one folder each under its full name (empty
    tables allowed; the manifest's names are cut to 31 characters and made unique), counting rows while writing (``observe``), and a
    ``_manifest`` table (name, path, rows, format) beside them."""
    base = folder.rstrip("/")
    entries, taken = [], set()
    for name, df in tables.items():
        short, k = name[:31], 1
        while short in taken:
            k += 1
            short = f"{name[:30 - len(str(k))]}~{k}"
        taken.add(short)
        obs = Observation(f"bundle_{name}")
        target = f"{base}/{name}"
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt).option("header", "true") \
            .save(target)
        entries.append((short, target, int(obs.get["rows"]), fmt))
    manifest = spark.createDataFrame(entries, "name string, path string, rows long, format string")
    manifest.coalesce(1).write.mode(mode).parquet(f"{base}/_manifest")
    return spark.read.parquet(f"{base}/_manifest")


def _digests(block_bytes: int):
    """Batches of (path, length, modificationTime) → the same with md5 and sha256, each file read in blocks."""
    def run(batches):
        for batch in batches:
            md5, sha256 = [], []
            for path in batch.column("path").to_pylist():
                fs, inner = pafs.FileSystem.from_uri(quote(path, safe="/:@"))     # Spark gives the plain path
                sums = hashlib.md5(), hashlib.sha256()
                with fs.open_input_stream(inner, compression=None) as stream:
                    while block := stream.read(block_bytes):
                        for h in sums:
                            h.update(block)
                md5.append(sums[0].hexdigest())
                sha256.append(sums[1].hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(md5, pa.string()), pa.array(sha256, pa.string())],
                                             names=[*batch.schema.names, "md5", "sha256"])
    return run


def file_manifest(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = True,
                  block_bytes: int = 8 << 20) -> DataFrame:
    """(path, length, modificationTime, md5, sha256) of the files under ``folder``.

    Spark lists the files, which leaves empty ones out; the tasks read each in blocks of ``block_bytes`` with running
    digests, so a task's memory does not depend on the size of a file. The file system must be one that
    pyarrow can open (local, HDFS, object stores).
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(folder)
             .select("path", "length", "modificationTime"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(
        _digests(block_bytes), "path string, length long, modificationTime timestamp, md5 string, sha256 string")
