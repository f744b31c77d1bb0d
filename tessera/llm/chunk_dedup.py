"""Operator 2, substring dedup: content-defined chunks, deduplicated by digest.

A gear rolling hash runs over the bytes of a text. It depends on the last bytes
only, and a chunk ends where its top bits are zero, so the cuts of a passage are
the same wherever it stands, and an insertion moves only the cuts beside it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, staged

BITS = 5                 # a cut every 2**BITS bytes on average
LONGEST = 512            # a stretch without a cut is cut after so many bytes
SHORTEST_RUN = 100       # bytes of repeated chunks in a row that are reported and deleted
REACH = 16               # bytes that the gear hash sees
FLUSH = 100_000          # chunk rows of a batch, about
SAMPLE = 20_000          # documents in which hot digests are looked for
HOT_SHARE = 1e-3         # a digest with this share of all chunks is hot
SALT = 64                # tasks that a hot digest is dealt to


def gear_table(seed: int = 42) -> np.ndarray:
    """256 random 32-bit words, made by a rule."""
    return np.array([int.from_bytes(hashlib.blake2b(bytes([seed, b]), digest_size=4).digest(), "little")
                     for b in range(256)], np.uint32)


GEAR = gear_table()


def cuts(data: bytes, bits: int = BITS, longest: int = LONGEST) -> np.ndarray:
    """End offsets of the chunks of ``data``; the last is its length.

    The rolling form is h = (h << 2) + gear[byte] in 32 bits, so a hash sees the
    last ``REACH`` bytes; here it is computed for all bytes at once by doubling.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    g = GEAR[np.frombuffer(data, np.uint8)]
    h, width = g.copy(), 1
    while width < REACH:                               # windows of 2, 4, ... bytes by doubling
        h[width:] += h[:-width] << np.uint32(2 * width)
        width *= 2
    ends = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    ends = np.unique(np.append(ends, n))
    gap = np.diff(ends, prepend=0)
    if (gap > longest).any():                          # long stretches: equal steps from the last cut
        more = [np.arange(e - d + longest, e, longest) for e, d in zip(ends, gap) if d > longest]
        ends = np.unique(np.concatenate([ends, *more]))
    return ends


def chunk_rows(docs: DataFrame, bits: int = BITS, longest: int = LONGEST) -> DataFrame:
    """A row per chunk: ``d1, d2`` (128-bit digest), ``doc_id, key`` (of the document's row), ``i, start, size`` (bytes), ``last``."""
    kind = pa.schema([(c, pa.int64()) for c in ("d1", "d2", "doc_id", "key")] + [(c, pa.int32()) for c in ("i", "start", "size")] + [("last", pa.bool_())])

    def split(batches):
        from pyspark import TaskContext
        key = TaskContext.get().partitionId() << 33
        parts, have = [], 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                key += 1
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                ends = cuts(data, bits, longest)
                if not len(ends):
                    continue
                at = ends.tolist()
                digests = np.frombuffer(b"".join([hashlib.blake2b(data[x:y], digest_size=16).digest()
                                                  for x, y in zip([0, *at], at)]), "<i8")
                start = np.concatenate(([0], ends[:-1]))
                n = len(at)
                parts.append((digests[::2], digests[1::2], [doc_id] * n, np.full(n, key), np.arange(n), start, ends - start, np.arange(1, n + 1) == n))
                have += n
                if have >= FLUSH:
                    yield _batch(parts, kind)
                    parts, have = [], 0
        if parts:
            yield _batch(parts, kind)

    return docs.mapInArrow(split, "d1 long, d2 long, doc_id long, key long, i int, start int, size int, last boolean")


def _batch(parts: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*parts))
    return pa.RecordBatch.from_arrays(
        [pa.array([x for c in col for x in c] if f.name == "doc_id" else np.concatenate(col), f.type)
         for col, f in zip(cols, kind)], schema=kind)


def hot_digests(docs: DataFrame, bits: int = BITS, longest: int = LONGEST, sample: int = SAMPLE) -> DataFrame:
    """``d1, d2`` of at most ``1 / HOT_SHARE`` digests that hold at least that share of the chunks of about ``sample`` documents.

    It only decides how chunks are dealt to tasks; the runs found are the same whatever it holds.
    """
    n = docs.count()
    some = chunk_rows(docs.sample(min(1.0, sample / max(n, 1)), seed=7), bits, longest)
    counts = staged(some.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")), "chunk-sample")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return staged(counts.where(F.col("n") >= max(2, total * HOT_SHARE)).orderBy(F.desc("n")).limit(int(1 / HOT_SHARE))
                  .select("d1", "d2"), "hot-chunks")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
                  longest: int = LONGEST, shortest: int = SHORTEST_RUN) -> DataFrame:
    """Runs of chunks that occurred before: ``doc_id, start, stop, n_bytes, n_chunks, first_doc_id``.

    A chunk is a repeat if a chunk of its 128-bit digest stands at an earlier
    place, in the order of doc_id (null last), row, offset. Repeats next to each
    other form a run; runs of at least ``shortest`` bytes and those that span their whole text are returned, with byte
    offsets into the UTF-8 text and the document in which the run's first chunk
    first occurred. ``shortest=1`` gives every repeated chunk. A null or empty text has no chunks. Rows with equal ids are
    documents of their own.

    Chunks cross one exchange, to the earliest chunk of their digest; repeats
    cross another, to the others of their document. A digest that holds many
    of the chunks is dealt to ``SALT`` tasks, each of which finds an earliest chunk of its own;
    the earliest of those is found by a partial aggregate of at most ``SALT / HOT_SHARE`` rows. No pairs are made.
    """
    base = documents(docs, id_col, text_col)
    hot = F.broadcast(hot_digests(base, bits, longest).withColumn("hot", F.lit(True)))           # 1 / HOT_SHARE rows at most
    chunks = chunk_rows(base, bits, longest).join(hot, ["d1", "d2"], "left")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("key", "i"), F.lit(SALT))).otherwise(0).cast("int")
    order = Window.partitionBy("d1", "d2", "salt").orderBy(F.col("doc_id").asc_nulls_last(), "key", "i")
    rows = (chunks.withColumn("salt", salt).withColumn("nth", F.row_number().over(order))
            .withColumn("first_doc_id", F.first("doc_id").over(order)))
    place = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "key", "i")
    rows = staged(rows.where("nth > 1 OR hot").select("key", "i", "start", "size", "last", "doc_id", "first_doc_id", "nth",
                                                      *[F.when(F.col("hot"), F.col(d)).alias(d) for d in ("d1", "d2")]), "repeats")
    earliest = (rows.where("d1 IS NOT NULL AND nth = 1").groupBy("d1", "d2").agg(F.min(place).alias("first")))
    rows = rows.join(F.broadcast(earliest), ["d1", "d2"], "left")
    is_first = (F.col("key") == F.col("first.key")) & (F.col("i") == F.col("first.i"))
    repeats = (rows.where(~F.coalesce(is_first, F.lit(False)))
               .withColumn("first_doc_id", F.when(F.col("first").isNull(), F.col("first_doc_id")).otherwise(F.col("first.doc_id"))))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("i"))
    runs = (repeats.select("key", "i", "start", "size", "last", "doc_id", "first_doc_id").withColumn("run", F.col("i") - rank)
            .groupBy("key", "run").agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"),
                                       F.max(F.col("start") + F.col("size")).alias("stop"),
                                       F.count(F.lit(1)).alias("n_chunks"), F.bool_or("last").alias("last"),
                                       F.min_by("first_doc_id", "i").alias("first_doc_id")))
    whole = F.col("last") & (F.col("start") == 0)
    return runs.where((F.col("stop") - F.col("start") >= shortest) | whole).select("doc_id", "start", "stop", (F.col("stop") - F.col("start")).alias("n_bytes"), "n_chunks", "first_doc_id")


def delete_runs(docs: DataFrame, runs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the byte ranges of ``runs`` in ``text_col``; ids must be unique.

    A cut that falls inside a character drops the character.
    """
    @F.pandas_udf("string")
    def without(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, cut in zip(text, spans):
            if t is not None and cut is not None and len(cut):
                data, at, kept = t.encode(), 0, []
                for x in sorted(cut, key=lambda c: c["start"]):
                    kept.append(data[at:x["start"]])
                    at = x["stop"]
                t = b"".join([*kept, data[at:]]).decode("utf-8", "ignore")
            out.append(t)
        return pd.Series(out, dtype=object)

    spans = runs.groupBy(F.col("doc_id").alias("__chunk_doc")).agg(
        F.collect_list(F.struct("start", "stop")).alias("__chunk_spans"))
    return (docs.join(spans, F.col(id_col).cast("long") == F.col("__chunk_doc"), "left")
            .withColumn(text_col, without(F.col(text_col), F.col("__chunk_spans")))
            .drop("__chunk_doc", "__chunk_spans"))
