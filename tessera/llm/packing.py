"""Operator 10, packing: bounded-space online packing of token sequences.

Each input partition keeps a fixed number of open windows. A document's whole
windows go out as they are; its rest goes to the open window it fits best. When
none fits and all are open, the fullest window is emitted. Windows still open at
a partition's end are merged afterwards by the same rule, in groups of partitions.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import documents, staged

OPEN = 64               # open windows per partition
MERGED = 64             # partitions whose leftovers meet in one task
SPAN = 1 << 40          # window numbers per partition

_COLS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset", "fill")
_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, "
           "fill long")


class OpenWindows:
    """At most ``limit`` open windows of ``size`` tokens, by free space."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit, self.free = size, limit, []

    def place(self, length: int, number) -> tuple:
        """(window, offset) for ``length`` tokens; ``number`` names the window if a new one is opened."""
        i = bisect_left(self.free, (length,))
        if i < len(self.free):
            free, window = self.free.pop(i)
        else:
            if len(self.free) >= self.limit:
                self.free.pop(0)                      # the fullest is emitted
            free, window = self.size, number
        if free > length:
            insort(self.free, (free - length, window))
        return window, self.size - free


def _pieces(tokenizer: str, text, size: int, end_id: int):
    """(start, length, crc32) of consecutive cuts of the document's ids; all but the last have ``size``."""
    wide, buf, start = size * 4, b"", 0
    for part in bpe.id_blocks(tokenizer, text):
        buf = buf + part if buf else part
        at = 0
        while len(buf) - at >= wide:
            yield start, size, zlib.crc32(buf[at:at + wide])
            at, start = at + wide, start + size
        buf = buf[at:]
    buf += end_id.to_bytes(4, "little")
    yield start, len(buf) // 4, zlib.crc32(buf)


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", open_windows: int = OPEN) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and then ``end_id``; a null or empty text is that id
    alone. Pieces of a sequence lie gapless from offset 0 and hold at most
    ``size`` ids. Rows with equal or null ids are documents of their own. The
    pieces are written once to the shared folder; only leftover windows (at most
    ``open_windows`` per partition) are shuffled.
    """
    def place(batches):
        base = TaskContext.get().partitionId() * SPAN
        windows, n = OpenWindows(size, open_windows), 0
        for b in batches:
            out = [[] for _ in _COLS]
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                cut = list(_pieces(tokenizer, text, size, end_id))
                total = cut[-1][0] + cut[-1][1]
                for start, length, crc in cut:
                    n += 1
                    window, offset = (base + n, 0) if length == size else windows.place(length, base + n)
                    for col, v in zip(out, (doc, start, length, crc, total, window, offset, None)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], list(_COLS))
        left = [(w, size - free) for free, w in windows.free]
        if left:
            none = pa.nulls(len(left), pa.int64())
            yield pa.RecordBatch.from_arrays([none] * 5 + [pa.array([w for w, _ in left], pa.int64()), none,
                                                          pa.array([f for _, f in left], pa.int64())], list(_COLS))

    rows = staged(documents(docs, id_col, text_col).mapInArrow(place, _SCHEMA), "pieces")
    pieces = rows.where("fill is null").drop("fill")
    left = rows.where("fill is not null").select("window", "fill")
    moves = merge_leftovers(left, size, open_windows)
    return (pieces.join(moves, "window", "left")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    F.coalesce("to", "window").alias("sequence_id"),
                    (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")))


def merge_leftovers(left: DataFrame, size: int, open_windows: int = OPEN) -> DataFrame:
    """``window, to, shift``: where each leftover window goes, and by how much its pieces move.

    Level by level, the leftovers of ``MERGED`` neighbouring partitions meet in
    one task (at most ``MERGED * open_windows`` rows) until one group is left.
    """
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        windows = OpenWindows(size, open_windows)
        pdf = pdf.sort_values(["fill", "window"], ascending=[False, True])
        put = [windows.place(f, w) for w, f in zip(pdf["window"].tolist(), pdf["fill"].tolist())]
        fill = {w: size - free for free, w in windows.free}
        return pd.DataFrame({"window": pdf["window"], "to": [w for w, _ in put], "shift": [o for _, o in put],
                             "fill": pd.array([fill.get(w) if o == 0 else None for w, o in put], "Int64")})

    span, moves = SPAN * MERGED, None
    top = left.agg(F.max("window")).first()[0]
    while True:
        step = staged(left.groupBy(F.expr(f"window div {span}").alias("g")).applyInPandas(
            lambda pdf: merge(pdf[["window", "fill"]]), "window long, to long, shift long, fill long"), "leftovers")
        here = step.select("window", "to", "shift")
        if moves is None:
            moves = here
        else:
            again = here.select(F.col("window").alias("to"), F.col("to").alias("to2"), F.col("shift").alias("shift2"))
            moves = moves.join(again, "to", "left").select(
                "window", F.coalesce("to2", "to").alias("to"),
                (F.col("shift") + F.coalesce("shift2", F.lit(0))).alias("shift"))
        if top is None or top < span:
            return moves
        left = step.where("fill is not null").select("window", "fill")
        span *= MERGED
