"""Operator 11, WARC: archives with an index first, read back by coalesced byte ranges."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staging_path
from .common import staged

LEAST_BYTES = 100            # shorter payloads are always stored
ARCHIVE_BYTES = 1 << 30      # a new archive begins past this size
GAP = 64 << 10               # byte ranges closer than this are read together
RANGE_BYTES = 8 << 20        # the most that one read covers, unless a single record is longer
TASK_BYTES = 64 << 20        # compressed bytes that a reading task gets, about

INDEX = ("archive string, offset long, length long, url string, payload_digest string, record_type string, "
         "record_id string, refers_to_id string")
RECORDS = ("archive string, offset long, page_id long, url string, record_type string, record_id string, "
           "refers_to_id string, payload_digest string, payload binary")
#: fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _open(uri: str):
    """File system and path of a URI as Spark writes it (``file:/a`` or ``scheme://...``)."""
    from pyarrow import fs as pafs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def _line(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(kind: str, record_id: str, url: str | None, digest: str, date: str, page_id: int | None, payload: bytes | None,
           refers_to_id: str | None = None) -> bytes:
    """One record: headers, block and the two empty lines after it. A revisit has an empty block."""
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to_id is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers_to_id}>"]
    block = b"" if payload is None else HTTP_HEAD % len(payload) + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


def _responses(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """The rows to write: ``page_id, url, digest, kind, record_id, refers_to_id, html`` (html null in revisits)."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"),
                    (F.octet_length(html) >= least).alias("long")))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id").alias("id"),
                     F.col("url").isNull().alias("no_url"), F.col("url").alias("u"), F.col("c").alias("c"))
    groups = (base.where("long").groupBy("digest", "page_id", "url").agg(F.count(F.lit(1)).alias("c"))
              .groupBy("digest").agg(F.min(order).alias("first"), F.sum("c").alias("n")).where("n > 1")
              .select("digest", "first"))
    groups = staged(groups, "warc-groups")            # written first: its size is known to the join, and a hot one can be split
    j = base.join(groups, "digest", "left")
    grouped = F.col("long") & F.col("first").isNotNull()
    is_first = (grouped & F.col("page_id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.u")))
    first_id = F.concat(F.lit("urn:sha256:"), "digest")
    cols = ["page_id", "url", "digest"]

    def rows(df, kind, own, refers, text):
        return df.select(*cols, F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"),
                         own.alias("record_id"), refers.alias("refers_to_id"), text.alias("html"))

    null = F.lit(None).cast("string")
    stored = F.coalesce(is_first, F.lit(False)) | ~F.coalesce(grouped, F.lit(False))
    tied = is_first & (F.col("first.c") > 1)
    out = rows(j.where(~F.coalesce(tied, F.lit(False))), F.when(stored, "response").otherwise("revisit"),
               F.when(is_first, first_id), F.when(~stored, first_id), F.when(stored, F.col("html")))
    if groups.where("first.c > 1").isEmpty():
        return out
    # rows alike in page, url and payload that come first: one of them is stored, the others revisit it
    alike = (j.where(tied).groupBy(*cols).agg(F.first("html").alias("html"), F.count(F.lit(1)).alias("c"))
             .select(*cols, "html", F.explode(F.sequence(F.lit(1), F.col("c"))).alias("k")))
    one = F.col("k") == 1
    return out.unionByName(rows(alike, F.when(one, "response").otherwise("revisit"), F.when(one, first_id),
                                F.when(~one, first_id), F.when(one, F.col("html"))))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """Write a record per row to ``*.warc.gz`` files in the shared ``folder``; returns the written index.

    Index columns: ``archive, offset, length, url, payload_digest, record_type,
    record_id, refers_to_id``; offset and length are those of the record's own
    gzip member. Of rows with equal payloads of ``least`` bytes or more one is
    stored (the smallest page_id, null last, then url); the others are revisits of it
    without a payload. A null html is an empty payload. A null url or page_id has
    no header line.

    Each attempt of a task writes files under names of its own, and its index
    rows name them: files of a lost or repeated attempt are never read. A task
    holds one record at a time.
    """
    date = date or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    folder = folder.rstrip("/")
    kind = _arrow(INDEX)

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(folder)
        out = name = None
        size = 0
        try:
            for b in batches:
                index = []
                for r in b.to_pylist():
                    if out is None or size >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(_open(name)[1], compression=None)
                    record_id = r["record_id"] or f"urn:uuid:{uuid.uuid4()}"
                    payload = None if r["html"] is None else r["html"].encode()
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = z.compress(record(r["kind"], record_id, r["url"], r["digest"], date, r["page_id"], payload,
                                               r["refers_to_id"])) + z.flush()
                    out.write(member)
                    index.append((name, size, len(member), r["url"], r["digest"], r["kind"], record_id, r["refers_to_id"]))
                    size += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*index), kind)] if index else
                                                 [pa.array([], f.type) for f in kind], schema=kind)
        finally:
            if out is not None:
                out.close()

    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)
    return staged(_responses(pages, id_col, url_col, html_col, least).mapInArrow(write_part, INDEX), "warc-index")


def read_records(index: DataFrame, gap: int = GAP, range_bytes: int = RANGE_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records that ``index`` (any rows of a written index) selects, with their payload.

    The rows are cut into ranges of (archive, offset) and sorted; within a task
    neighbouring records of an archive become one read of at most
    ``range_bytes`` unless a gap of more than ``gap`` bytes lies between them. A payload
    that does not have its digest raises. Revisits have a null payload. Rows
    selected twice are returned twice; an empty selection gives no rows.
    """
    spark = index.sparkSession
    total = index.agg(F.sum("length")).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, math.ceil(total / task_bytes))
    ranges = (index.select("archive", "offset", "length").repartitionByRange(n, "archive", "offset")
              .sortWithinPartitions("archive", "offset"))
    kind = _arrow(RECORDS)

    def runs(batches):
        """Neighbouring records: archive and (offset, length) pairs."""
        run, at = [], None
        for b in batches:
            for name, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if run and (name != at or offset - sum(run[-1]) > gap or offset + length - run[0][0] > range_bytes):
                    yield at, run
                    run = []
                at = name
                run.append((offset, length))
        if run:
            yield at, run

    def read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = held = None
        try:
            for name, run in runs(batches):
                if name != held:
                    if handle is not None:
                        handle.close()
                    fs, path = _open(name)
                    handle, held = fs.open_input_file(path), name
                start = run[0][0]
                data = memoryview(handle.read_at(max(o + k for o, k in run) - start, start))
                rows = []
                for offset, length in run:
                    fields, block = parse(zlib.decompress(data[offset - start:offset - start + length], 31))
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    payload = None
                    if fields["warc-type"] != "revisit":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name} at {offset}: the payload does not have its digest")
                    refers = fields.get("warc-refers-to")
                    page = fields.get("page-id")
                    rows.append((name, offset, None if page is None else int(page), fields.get("warc-target-uri"),
                                 fields["warc-type"], fields["warc-record-id"][1:-1], refers and refers[1:-1], digest, payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
        finally:
            if handle is not None:
                handle.close()

    return ranges.mapInArrow(read_part, RECORDS)


def archived_pages(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives, read every record back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    One row per row of ``pages``, repeated rows included. ``payload_bytes`` and
    ``payload_digest`` of a revisit are those of the payload that it refers to,
    found by its record id. Empty tables give no rows; other columns, whatever their
    names, are left behind. ``folder`` must be shared by driver and executors
    (default: under ``spark.checkpoint.dir``).
    """
    folder = folder or staging_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, **options)
    got = staged(read_records(index).select("page_id", "record_type", "record_id", "refers_to_id",
                                            F.octet_length("payload").cast("long").alias("payload_bytes"),
                                            F.sha2("payload", 256).alias("payload_digest")), "warc-records")
    first = got.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    known = got.where("refers_to_id IS NOT NULL").select("refers_to_id").distinct()
    first = staged(first.join(known, "refers_to_id", "left_semi"), "warc-first")
    return (got.join(first, "refers_to_id", "left")
            .select("page_id", F.coalesce("b", "payload_bytes").alias("payload_bytes"),
                    F.coalesce("d", "payload_digest").alias("payload_digest"), "record_type", "refers_to"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
w AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM w
"""
