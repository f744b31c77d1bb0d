"""Workbooks (.xlsx) as a Spark source and sink.

Reading: ``binaryFile`` lists the files; ``mapInPandas`` opens each one (zip +
XML, standard library only) in the task that holds it and emits one row per
sheet row: (path, sheet, row_idx, cells array<string>). Typing a sheet is a
plain projection over that table. A task holds the (packed) files of one batch and
``BATCH_ROWS`` rows of a sheet at a time.

Writing: each partition becomes one workbook file (inline strings, numbers as
numbers) written row by row by its task under a deterministic name, so a retried
task overwrites its own file.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RAW_SCHEMA = "path string, sheet string, sheet_index int, row_idx int, cells array<string>"
# Fixed value: rows per worksheet in the .xlsx format.
SHEET_MAX_ROWS = 1_048_576
SHEET_MAX_BYTES = 1 << 30    # of a written sheet before packing (about): larger parts need ZIP64, which not all readers take
BATCH_ROWS = 10_000          # sheet rows a task holds at a time
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(ref: str) -> int:
    letters = _REF.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


def _parse_workbook(path: str, data: bytes):
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in root.findall("m:si", _NS)]
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target") for r in rels.findall("pr:Relationship", _NS)}
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        for si, sheet in enumerate(wb.find("m:sheets", _NS).findall("m:sheet", _NS)):
            rid = sheet.get(f"{{{_NS['r']}}}id")
            t = target[rid].lstrip("/")
            t = t if t.startswith("xl/") else f"xl/{t}"
            with z.open(t) as fh:
                parents: list = []
                for event, el in ET.iterparse(fh, ("start", "end")):
                    if event == "start":
                        parents.append(el)
                        continue
                    parents.pop()
                    if el.tag != f"{{{_NS['m']}}}row":
                        continue
                    cells: dict[int, str | None] = {}
                    for c in el.findall("m:c", _NS):
                        kind = c.get("t")
                        v = c.find("m:v", _NS)
                        if kind == "inlineStr":
                            val = _text(c.find("m:is", _NS))
                        elif v is None:
                            val = None
                        elif kind == "s":
                            val = shared[int(v.text)]
                        elif kind == "b":
                            val = "true" if v.text == "1" else "false"
                        else:
                            val = v.text
                        cells[_col_index(c.get("r"))] = val
                    width = max(cells) + 1 if cells else 0
                    yield (path, sheet.get("name"), si, int(el.get("r")) - 1, [cells.get(i) for i in range(width)])
                    parents[-1].remove(el)                     # the sheet keeps no row


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for path, content in zip(b["path"], b["content"]):
            rows = _parse_workbook(path, content)
            while part := list(islice(rows, BATCH_ROWS)):
                yield pd.DataFrame(part, columns=["path", "sheet", "sheet_index", "row_idx", "cells"])


def read_raw(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """(path, sheet, sheet_index, row_idx, cells) for every row of every sheet."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(_reader, RAW_SCHEMA)


def sheet_names(raw: DataFrame) -> DataFrame:
    return raw.select("path", "sheet_index", "sheet").distinct()


def _pick_sheet(raw: DataFrame, sheet: str | int | None) -> DataFrame:
    if sheet is None:
        return raw.where(F.col("sheet_index") == 0)
    if isinstance(sheet, int):
        return raw.where(F.col("sheet_index") == sheet)
    return raw.where(F.col("sheet") == sheet)


def read_range(raw: DataFrame, sheet: str | int | None = None, start_row: int = 0, end_row: int | None = None,
               start_col: int = 0, end_col: int | None = None, schema: StructType | None = None) -> DataFrame:
    """A typed table from a sheet: skip ``start_row`` rows, the next row is the
    header, then ``end_row - start_row`` data rows (all when None); columns
    ``[start_col, end_col)`` (start_col ignored when end_col is None).

    Column names come from ``schema`` when given; otherwise from the header row
    of one file (one row brought to the driver)."""
    rows = _pick_sheet(raw, sheet)
    lo = start_col if end_col is not None else 0
    cells = F.slice("cells", lo + 1, (end_col - lo) if end_col is not None else 1 << 20)
    data = rows.where(F.col("row_idx") > start_row)
    if end_row is not None:
        data = data.where(F.col("row_idx") <= start_row + (end_row - start_row))
    if schema is None:
        header = rows.where(F.col("row_idx") == start_row).select(cells.alias("h")).first()
        names = [h if h is not None else f"column_{i}" for i, h in enumerate(header["h"] if header else [])]
        return data.select(*[cells[i].alias(n) for i, n in enumerate(names)])
    return data.select(*[cells[i].try_cast(f.dataType).alias(f.name) if f.dataType.simpleString() != "string"
                         else cells[i].alias(f.name) for i, f in enumerate(schema.fields)])


def read_sheet(raw: DataFrame, sheet: str | int | None = None, schema: StructType | None = None) -> DataFrame:
    return read_range(raw, sheet, 0, None, 0, None, schema)


# ---- writing ----

_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
       '{sheets}</Types>')
_CT_SHEET = ('<Override PartName="/xl/worksheets/sheet{n}.xml" '
             'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
         'officeDocument" Target="xl/workbook.xml"/></Relationships>')


def _row_xml(r: int, row: Sequence) -> str:
    """Row ``r`` (from 1) of a sheet."""
    parts = [f'<row r="{r}">']
    for c, v in enumerate(row):
        if v is None or (isinstance(v, float) and v != v):
            continue
        ref = f"{_col_letters(c)}{r}"
        if isinstance(v, bool):
            parts.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float)):
            parts.append(f'<c r="{ref}"><v>{v!r}</v></c>')
        else:
            parts.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}'
                         "</t></is></c>")
    parts.append("</row>")
    return "".join(parts)


def _write_workbook(out, sheets: dict[str, Iterable[Sequence]], size: list[int] | None = None) -> None:
    """Writes an .xlsx of {sheet name: rows of values} to the stream ``out``, a row at a time; nothing is kept.

    ``size[0]`` counts the bytes of the rows as they are written.
    """
    names = [n[:31] for n in sheets]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   _CT.format(sheets="".join(_CT_SHEET.format(n=i + 1) for i in range(len(names)))))
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml",
                   '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
                   + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                             for i, n in enumerate(names)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{_NS["pr"]}">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/'
                             f'officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                             for i in range(len(names))) + "</Relationships>")
        for i, rows in enumerate(sheets.values()):
            with z.open(f"xl/worksheets/sheet{i + 1}.xml", "w") as part:
                part.write(f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_NS["m"]}">'
                           "<sheetData>".encode())
                for r, row in enumerate(rows):
                    xml = _row_xml(r + 1, row).encode()
                    part.write(xml)
                    if size is not None:
                        size[0] += len(xml)
                part.write(b"</sheetData></worksheet>")


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """Build an .xlsx from {sheet name: rows of values}. Sheet names are cut to 31 characters."""
    buf = io.BytesIO()
    _write_workbook(buf, sheets)
    return buf.getvalue()


def _cell_value(v):
    if isinstance(v, pd.Timestamp):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if hasattr(v, "item"):
        return v.item()
    return v


def write_workbooks(df: DataFrame, folder: str, sheet: str, leading_rows: Sequence[Sequence] = ()) -> DataFrame:
    """Write each partition of ``df`` as ``folder/part-NNNNN-KKK.xlsx`` with one sheet
    (header row first, after optional ``leading_rows``); a partition larger than
    a sheet is split into several files; a task holds one batch of rows at a
    time. Returns the lazy (path, rows) manifest; the files are written when it
    is evaluated."""
    cols = df.columns
    lead = [list(r) for r in leading_rows]
    base = folder.rstrip("/")

    def write_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        room = max(1, SHEET_MAX_ROWS - len(lead) - 1)          # data rows per file
        values = ([_cell_value(v) for v in rec] for b in batches for rec in b.itertuples(index=False, name=None))
        written: list[tuple[str, int]] = []
        first = next(values, None)
        while first is not None or not written:                # a file a turn, at least one
            target = f"{base}/part-{pid:05d}-{len(written):03d}.xlsx"
            uri = "file://" + target[len("file:"):] if target.startswith("file:/") and not target.startswith(
                "file://") else target
            filesystem, fpath = pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)
            filesystem.create_dir(fpath.rsplit("/", 1)[0], recursive=True)
            n, size = 0, [0]

            def data():
                nonlocal n
                rec = first
                while rec is not None:
                    n += 1
                    yield rec
                    rec = next(values, None) if n < room and size[0] < SHEET_MAX_BYTES else None

            with filesystem.open_output_stream(fpath) as fh:
                _write_workbook(fh, {sheet: chain(lead, [cols], data())}, size)
            written.append((target, n))
            first = next(values, None)
        yield pd.DataFrame({"path": [p for p, _ in written], "rows": [n for _, n in written]})

    return df.mapInPandas(write_part, "path string, rows long")


def cells_as(raw_cells: Column, i: int, type_name: str) -> Column:
    return raw_cells[i].try_cast(type_name)
