"""Round trips through the file formats, in a temp folder."""

import hashlib
import os
import re
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import csv as cs
import pytest

from tessera.sources import json_pages as jp
from tessera.sources import logs as lg
from tessera.sources import sinks as sk
from tessera.sources import workbook as wb


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_round_trip_columns_filter_range(spark, employees, tmp_dir):
    out = f"{tmp_dir}/emp"
    sk.write_csv(employees, out)
    back = cs.read_csv(spark, out)
    assert back.count() == 5
    assert cs.read_csv(spark, out, columns=["salary", "name"]).columns == ["salary", "name"]
    assert cs.read_csv_isin(spark, out, "department", ["IT", None]).count() == 2
    rng = cs.read_csv_date_range(spark, out, "hire_date", "2019-01-01", "2021-03-10")
    assert sorted(r["id"] for r in rng.collect()) == [1, 2, 3]          # end date inclusive (midnight)


def test_csv_union_by_name_and_bad_values(spark, tmp_dir):
    write_text(f"{tmp_dir}/a/a.csv", "id,name\n1,x\n2,y\n")
    write_text(f"{tmp_dir}/b/b.csv", "id,name,extra\n3,z,e\n")
    u = cs.read_csv_union(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"])
    rows = {r["id"]: r for r in u.collect()}
    assert len(rows) == 3 and rows[1]["extra"] is None and rows[3]["extra"] == "e"
    assert len(cs.read_csv_union(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"], concat=False)) == 2
    write_text(f"{tmp_dir}/bad/bad.csv", "n,d\n1.5,2024-01-02\nabc,not a date\n")
    bad = cs.read_csv(spark, f"{tmp_dir}/bad", "n string, d string")
    from tessera.operators.cleaning import convert_types
    conv = convert_types(bad, {"n": "numeric", "d": "datetime"}).collect()
    assert conv[0]["n"] == 1.5 and conv[1]["n"] is None and conv[1]["d"] is None


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_json_envelopes(spark, tmp_dir):
    docs = [{"data": [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]},
            {"results": [{"id": 3, "name": "c"}]},
            {"items": [{"id": 4, "name": "d"}]},
            [{"id": 5, "name": "e"}, {"id": 6, "name": "f"}],
            {"id": 7, "name": "g"},
            42]
    write_text(f"{tmp_dir}/resp/r.json", "\n".join(json.dumps(d) for d in docs))
    got = sorted(r["id"] for r in jp.read_responses(spark, f"{tmp_dir}/resp", ROW).collect())
    assert got == [1, 2, 3, 4, 5, 6, 7]                                  # the scalar gives no rows
    post = jp.read_responses(spark, f"{tmp_dir}/resp", ROW, keys=jp.POST_ENVELOPE_KEYS).collect()
    # POST responses know only "data": a "results"/"items" object is one (mostly empty) row
    assert sorted(r["id"] for r in post if r["id"] is not None) == [1, 2, 5, 6, 7]
    assert sum(1 for r in post if r["id"] is None) == 2


def test_json_documents_kept_apart(spark, tmp_dir):
    good = ['{"data": {"id": 1, "name": "a"}}', '{"data": null, "results": [{"id": 9}]}', '{"data": [{"id": 2}], "items": 3}',
            '{"results": []}', "[]", "", '"text"', "null", '{"id": 3, "name": null}', '{"data": [{"id": 4, "extra": [1]}]}']
    bad = ['{"data": [{"id": 5}', '[{"id": 6}', "oops", '{"data": [{"id": "x"}, {"id": 7}]}', '{"data": "text"}', '{"id": 1.5e']
    write_text(f"{tmp_dir}/mixed/r.json", "\n".join(good + bad))
    got = jp.read_responses(spark, f"{tmp_dir}/mixed", ROW, corrupt_column="broken").collect()
    assert sorted(r["id"] for r in got if r["broken"] is None) == [1, 2, 3, 4]
    assert sorted(r["broken"] for r in got if r["broken"] is not None) == sorted(bad)
    assert all(r["id"] is None and r["name"] is None for r in got if r["broken"] is not None)
    with pytest.raises(Exception, match="does not fit the schema"):
        jp.read_responses(spark, f"{tmp_dir}/mixed", ROW).collect()


def test_json_pages_stop_rules(spark):
    def pages(sizes):
        rows = [(p, i) for p, n in enumerate(sizes, start=1) for i in range(n)]
        return spark.createDataFrame(rows, "page int, i int")

    assert jp.paginate(pages([100, 100, 40]), "page", 100).count() == 240      # short page kept, then stop
    assert jp.paginate(pages([100, 40, 100]), "page", 100).count() == 140
    assert jp.paginate(pages([100, 100, 100]), "page", 100, max_pages=2).count() == 200
    gap = spark.createDataFrame([(1, 0)] * 100 + [(3, 0)] * 100, "page int, i int")
    assert jp.paginate(gap, "page", 100).count() == 100                         # missing page 2 stops


def test_workbook_sheets_and_ranges(spark, tmp_dir):
    data = wb.workbook_bytes({
        "employees": [["Report"], [], ["id", "name", "salary"], [1, "Alice", 50000], [2, "Bob", 60000.5],
                      [3, None, 1]],
        "sales": [["product", "amount"], ["A", 10], ["B", 20]]})
    os.makedirs(f"{tmp_dir}/wb", exist_ok=True)
    with open(f"{tmp_dir}/wb/book.xlsx", "wb") as fh:
        fh.write(data)
    raw = wb.read_raw(spark, f"{tmp_dir}/wb")
    assert sorted(r["sheet"] for r in wb.sheet_names(raw).collect()) == ["employees", "sales"]
    first = wb.read_sheet(raw)                                           # default: first sheet
    assert first.count() == 5
    sales = wb.read_sheet(raw, "sales", T.StructType([T.StructField("product", T.StringType()),
                                                      T.StructField("amount", T.LongType())]))
    assert sorted((r["product"], r["amount"]) for r in sales.collect()) == [("A", 10), ("B", 20)]
    rng = wb.read_range(raw, "employees", start_row=2, end_row=4, start_col=1, end_col=3)
    assert rng.columns == ["name", "salary"]
    assert [(r["name"], r["salary"]) for r in rng.orderBy("salary").collect()] == [("Alice", "50000"),
                                                                                  ("Bob", "60000.5")]
    by_index = wb.read_range(raw, 1)
    assert by_index.columns == ["product", "amount"]


def test_workbook_writer_splits_large_partitions(spark, employees, tmp_dir, monkeypatch):
    monkeypatch.setattr(wb, "SHEET_MAX_ROWS", 4)                     # 1 header + 3 data rows per file
    manifest = wb.write_workbooks(employees.coalesce(1), f"{tmp_dir}/split", "emp").collect()
    assert sorted(r["rows"] for r in manifest) == [2, 3]
    back = wb.read_sheet(wb.read_raw(spark, f"{tmp_dir}/split"), "emp")
    assert back.count() == 5


def test_workbook_writer_round_trip(spark, employees, tmp_dir):
    manifest = wb.write_workbooks(employees.repartition(2), f"{tmp_dir}/out", "emp").collect()
    assert sum(r["rows"] for r in manifest) == 5
    raw = wb.read_raw(spark, f"{tmp_dir}/out")
    back = wb.read_sheet(raw, "emp", T.StructType([T.StructField("id", T.LongType()),
                                                   T.StructField("name", T.StringType())]))
    assert sorted(r["id"] for r in back.collect()) == [1, 2, 3, 4, 5]


def test_log_scan(spark, tmp_dir):
    lines = ["2024-01-01 10:00:00 - app - INFO - m:f:1 - started",
             "2024-01-01 10:00:01 - app - DEBUG - m:f:2 - detail",
             "2024-01-01 10:00:02 - app - WARNING - m:f:3 - slow",
             "2024-01-01 10:00:03 - app - ERROR - m:f:4 - failed"]
    write_text(f"{tmp_dir}/logs/app.log", "\n".join(lines))
    assert lg.scan(spark, f"{tmp_dir}/logs", "DEBUG").count() == 4
    assert lg.scan(spark, f"{tmp_dir}/logs", "INFO").count() == 3
    w = lg.scan(spark, f"{tmp_dir}/logs", "WARNING").collect()
    assert [r["level"] for r in w] == ["WARNING", "ERROR"]
    tail = lg.scan(spark, f"{tmp_dir}/logs", "DEBUG", tail=1).first()
    assert tail["message"] == "failed"
    assert lg.newest_file(spark, f"{tmp_dir}/logs").endswith("app.log")


def test_log_records_across_splits(spark, tmp_path):
    """Lines of tracebacks keep their record's fields wherever the splits fall; tail equals the file's last lines."""
    lines = ["no record yet"]
    for i in range(120):
        level = ["INFO", "ERROR", "DEBUG", "WARNING"][i % 4]
        lines.append(f"2024-01-01 10:{i // 60:02d}:{i % 60:02d} - app - {level} - m:f:{i} - message {i}")
        if level == "ERROR":
            lines += ["Traceback (most recent call last):"] + [f"  frame {i}.{j}" for j in range(i % 30)] + [""]
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "old.log").write_text("2030-01-01 00:00:00 - app - ERROR - m:f:1 - newest stamp, older file\n")
    os.utime(folder / "old.log", (1, 1))
    (folder / "new.log").write_text("\n".join(lines) + "\n")
    want, record = [], None
    for x in lines:
        record = x.split(" - ", 4) if re.match(r"\d{4}-", x) else record
        want.append((record[2] if record else None, record[4] if record else None, x, not re.match(r"\d{4}-", x)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split in ("500", "128MB"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = lg.tail(spark, str(folder), 10_000, "DEBUG").select("level", "message", "line", "continues").collect()
            assert [tuple(r) for r in got] == want
            if split == "500":
                assert lg.records(spark, str(folder / "new.log")).select("block").distinct().count() > 5
            last = [r["line"] for r in lg.tail(spark, str(folder), 7, "DEBUG").collect()]
            assert last == lines[-7:]
            shown = [r["line"] for r in lg.tail(spark, str(folder), 25, "WARNING").collect()]
            assert shown == [x for x in lines if any(v in x for v in ("WARNING", "ERROR", "CRITICAL"))][-25:]
            whole = [r["line"] for r in lg.tail(spark, str(folder), 60, "ERROR", whole_records=True).collect()]
            assert whole == [w[2] for w in want if w[0] == "ERROR"][-60:]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.unset("spark.sql.files.openCostInBytes")
    empty = tmp_path / "none"
    empty.mkdir()
    assert lg.tail(spark, str(empty)).count() == 0


def test_manifest_reads_in_blocks(spark, tmp_path):
    content = {"a b.bin": os.urandom(10_007), "d%20e.bin": b"y", "c.bin": b"x" * 4096}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "empty.bin").write_bytes(b"")          # Spark's listing leaves it out
    got = sk.file_manifest(spark, str(tmp_path), "*.bin", block_bytes=1024).collect()
    assert sorted((r["length"], r["md5"], r["sha256"]) for r in got) == sorted(
        (len(x), hashlib.md5(x).hexdigest(), hashlib.sha256(x).hexdigest()) for x in content.values())


def test_bundle_and_manifest(spark, employees, tmp_dir):
    m = sk.write_bundle(spark, {"employees": employees, "x" * 40: employees.where("false")}, f"{tmp_dir}/b")
    rows = {r["name"]: r["rows"] for r in m.collect()}
    assert rows == {"employees": 5, "x" * 31: 0}
    twins = sk.write_bundle(spark, {"y" * 31 + "a": employees, "y" * 31 + "b": employees.limit(2)}, f"{tmp_dir}/twins").collect()
    assert len({r["name"] for r in twins}) == 2 and sorted(spark.read.parquet(r["path"]).count() for r in twins) == [2, 5]
    files = sk.file_manifest(spark, f"{tmp_dir}/b/employees", "*.parquet").collect()
    for f in files:
        local = f["path"].replace("file:", "")
        with open(local, "rb") as fh:
            content = fh.read()
        assert f["md5"] == hashlib.md5(content).hexdigest()
        assert f["sha256"] == hashlib.sha256(content).hexdigest() and f["length"] == len(content)


def test_csv_union_scans_each_layout_once(spark, tmp_path):
    from tessera.sources.csv import read_csv_union
    heads = ["a,b", "b,a", "a,c"]
    paths = []
    for i in range(12):
        p = tmp_path / f"f{i}.csv"
        p.write_text(f"{heads[i % 3]}\n{i},{i * 10}\n" + (f"{i},\n" if i == 3 else ""))
        paths.append(str(p))
    out = read_csv_union(spark, paths)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 3
    want = [{0: (i, i * 10, None), 1: (i * 10, i, None), 2: (i, None, i * 10)}[i % 3] for i in range(12)] + [(3, None, None)]
    assert sorted(map(repr, (tuple(r) for r in out.select("a", "b", "c").collect()))) == sorted(map(repr, want))
    assert len(read_csv_union(spark, paths, concat=False)) == 12
    given = read_csv_union(spark, paths[::3], schemas=["a int, b int"] * 4)
    assert given._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1 and given.count() == 5


def test_rolled_logs_are_one_log(spark, tmp_path, monkeypatch):
    """A log cut into files goes on from file to file; windows of a few lines; fields as the format's expression gives them."""
    monkeypatch.setattr(lg, "CHUNK", 3)
    heads = ["2024-01-01 10:00:00 - app - ERROR - m:f:1 - one - two - three", "2024-01-01 10:00:01 - a - b - WARNING - m:f:2 - x",
             "2024-01-01 10:00:02 -  - INFO - m - ", "2024-01-01 10:00:03 - - INFO - X - Y - z", "2024-13-01 10:00:04 - app - INFO - m:f:3 - ok",
             "2024-01-01 10:00:05 - app - info - m:f:4 - no - WARNING - a - b", "2024-01-01 10:00:06 - app - info - m:f:4 - no level"]
    text = ["before"]
    for i in range(40):
        text += [heads[i % len(heads)]] + [f"  frame {i}.{j}" for j in range(i % 7)]
    (tmp_path / "a-old").mkdir()
    (tmp_path / "a-old" / "part-0.txt").write_text(heads[0] + "\n")
    os.utime(tmp_path / "a-old" / "part-0.txt", (1, 1))
    (tmp_path / "b-new").mkdir()
    cuts = [0, 1, 20, 21, 24, 90, len(text)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / "b-new" / f"part-{k}.txt").write_text("".join(x + "\n" for x in text[a:b]))
    want, record = [], None
    for x in text:
        m = re.match(lg.LINE_FORMAT, x)
        record = m or record
        want.append((*(record.groups()[1:] if record else [None] * 4), x, m is None))
    got = lg.tail(spark, str(tmp_path), 1000, "DEBUG", rolled=True)
    assert [tuple(r) for r in got.select("logger", "level", "location", "message", "line", "continues").collect()] == want
    assert got.where("line like '2024-13%' and ts is null").count() == sum(x.startswith("2024-13") for x in text)
    assert [r["line"] for r in lg.tail(spark, str(tmp_path), 9, "DEBUG", rolled=True).collect()] == text[-9:]
    apart = lg.records(spark, str(tmp_path))                       # every file a log by itself
    assert apart.count() == len(text) + 1
    firsts = {r["line"]: r["level"] for r in apart.where("file like '%part-2%' or file like '%part-3%'").collect() if r["continues"]}
    part = lambda k: text[cuts[k]:cuts[k + 1]]
    for k in (2, 3):
        for x in part(k):
            if x.startswith("2024"):
                break
            if re.match(lg.LINE_FORMAT, x) is None:
                assert firsts[x] is None


def test_log_queries_write_their_logs_with_many_tasks(spark, monkeypatch):
    from tessera.plans import catalog_sources as cat
    from tests.conftest import SF
    monkeypatch.setattr(cat, "LOG_LINES", 1000, raising=False)
    path = cat._log_with_tracebacks(spark, SF, "many-tasks")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count() + spark.read.parquet(f"{SF}/orders.parquet").count()
    assert files.count() >= lines // 1000


def test_workbooks_are_written_and_read_row_by_row(spark, tmp_dir, monkeypatch):
    """Memory of a task does not grow with the sheet: 60,000 rows cost little more than 6,000, both ways."""
    import io
    import tracemalloc

    import pandas as pd

    def peak(f):
        tracemalloc.start()
        out = f()
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, top

    def write(n):
        out = io.BytesIO()
        wb._write_workbook(out, {"s": ([i, f"name {i % 50}", i / 4, None, True] for i in range(n))})
        return out.getvalue()

    def read(data):
        parts = wb._reader(iter([pd.DataFrame({"path": ["p"], "content": [data]})]))
        return sum(len(p) for p in parts)

    small, write_small = peak(lambda: write(6_000))
    large, write_large = peak(lambda: write(60_000))
    assert write_large < 3 * len(large) + write_small                # the packed bytes in the test's own buffer
    monkeypatch.setattr(wb, "BATCH_ROWS", 1000)
    assert read(large[:]) == 60_000
    assert peak(lambda: read(large))[1] < 2 * peak(lambda: read(small))[1] + 3 * len(large)

    monkeypatch.setattr(wb, "SHEET_MAX_BYTES", 2000)                 # a sheet is also cut by its bytes
    df = spark.range(100).selectExpr("id", "repeat('x', 50) AS s").coalesce(1)
    manifest = wb.write_workbooks(df, f"{tmp_dir}/bytes", "s").collect()
    assert len(manifest) > 3 and sum(r["rows"] for r in manifest) == 100
    back = wb.read_sheet(wb.read_raw(spark, f"{tmp_dir}/bytes"), "s", df.schema).collect()
    assert sorted(r["id"] for r in back) == list(range(100))
