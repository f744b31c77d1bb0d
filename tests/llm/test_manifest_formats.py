"""WARC archives, embedding whitening and the Merkle manifest against plain versions."""

import gzip
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle, warc, whitening

LONG = "<html>" + "x" * 200 + "</html>"


def _frame(spark, rows, schema, clash=()):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.lit("?") for c in clash})


# ---- 11: WARC
PAGES = [(3, "http://c/", LONG), (1, "http://a/\r\nX: y", LONG), (2, None, LONG), (None, "http://n/", LONG), (4, "http://d/", "short"),
         (5, "http://e/", "short"), (6, "http://f/", None), (7, "http://g/", ""), (8, "http://h/", "é" * 50), (9, "http://i/", "é" * 50),
         (10, "http://j/", "é" * 49), (11, "http://j/", "é" * 49), (12, "u", "y" * 300000), (13, "u", "z\r\n\r\nWARC/1.1\r\n\r\n" * 20),
         (20, "t", "tie " * 40), (20, "t", "tie " * 40), (20, "u", "tie " * 40), (21, "t", "tie " * 40),
         (None, None, "alone " * 30), (None, None, "alone " * 30)]


def plain_warc(rows):
    """Expected rows as (page_id, bytes, digest, type, refers_to), counted."""
    groups = {}
    for page_id, url, html in rows:
        data = (html or "").encode()
        groups.setdefault(data, []).append((page_id is None, page_id or 0, url is None, url or "", page_id))
    out = Counter()
    for data, own in groups.items():
        own.sort()
        for k, x in enumerate(own):
            stored = k == 0 or len(data) < 100
            out[x[-1], len(data), hashlib.sha256(data).hexdigest(), "response" if stored else "revisit",
                None if stored else own[0][-1]] += 1
    return out


def test_archived_pages(spark):
    pages = _frame(spark, PAGES, "page_id long, url string, html string", ("digest", "offset", "kind", "first", "n", "c", "archive"))
    got = warc.archived_pages(pages.repartition(3))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, got.collect())) == plain_warc(PAGES)
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_archives_are_readable_records(spark, tmp_path):
    pages = _frame(spark, PAGES, "page_id long, url string, html string")
    index = warc.write_archives(pages.repartition(2), f"file:{tmp_path}/w", archive_bytes=600, date="2020-01-01T00:00:00Z")
    rows = index.collect()
    assert len(rows) == len(PAGES) and len({r.archive for r in rows}) > 2
    by_file = {}
    for r in rows:
        by_file.setdefault(r.archive, []).append((r.offset, r.length, r))
    for name, own in by_file.items():
        own.sort(key=lambda x: x[0])
        data = open(name.removeprefix("file:"), "rb").read()
        assert [o for o, _, _ in own] == np.cumsum([0] + [k for _, k, _ in own])[:-1].tolist() and sum(own[-1][:2]) == len(data)
        whole = gzip.decompress(data)                         # a plain multi-member gzip file
        assert whole.count(b"WARC-Record-ID") == len(own)
        for o, k, r in own:
            fields, block = warc.parse(zlib.decompress(data[o:o + k], 31))
            assert fields["warc-type"] == r.record_type and fields["warc-date"] == "2020-01-01T00:00:00Z"
            assert fields["content-length"] == str(len(block)) and ("x" in fields) is False
    stored = {(r.page_id): r for r in warc.read_records(index).collect() if r.page_id is not None}
    assert stored[13].payload.decode() == PAGES[13][2] and stored[12].payload.decode() == PAGES[12][2] and stored[6].payload == b""
    assert stored[3].payload is None and stored[3].record_type == "revisit"


def test_selected_records_and_ranges(spark, tmp_path):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"),
                                    F.repeat(F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit(" ")), 5).alias("html"))
    index = warc.write_archives(pages.coalesce(2), f"{tmp_path}/w")
    want = {r.page_id: r.html for r in pages.collect()}
    for gap, most in ((0, 1), (1 << 20, 1 << 20), (300, 2000)):
        some = index.where("url LIKE '%7' OR url LIKE '%8'")
        got = warc.read_records(some, gap=gap, range_bytes=most, task_bytes=4000).collect()
        assert {r.page_id: r.payload.decode() for r in got} == {k: v for k, v in want.items() if k % 10 in (7, 8)}
    assert warc.read_records(index.limit(0)).count() == 0
    wrong = index.select("archive", "offset", "length").first()
    with open(wrong.archive, "r+b") as f:                     # a payload that is not the one written
        f.seek(wrong.offset)
        fields, block = warc.parse(zlib.decompress(f.read(wrong.length), 31))
        z = zlib.compressobj(9, zlib.DEFLATED, 31)
        f.seek(wrong.offset)
        f.write(z.compress(warc.record("response", "urn:x", None, fields["warc-payload-digest"][7:], "d", 0, b"other")) + z.flush())
    with pytest.raises(Exception, match="digest"):
        warc.read_records(index.where(F.col("archive") == wrong.archive).where(F.col("offset") == wrong.offset)).count()


# ---- 12: whitening
def test_cross_products_are_exact():
    rng = np.random.default_rng(5)
    for rows, high in ((1, 3), (63, 1000), (64, 1 << 20), (200, 1 << 45), (130, 1)):
        u = rng.integers(-high, high, (rows, 7))
        u[:, 3] = 5                                           # a constant dimension has no planes
        s, c = whitening.block_sums(u)
        big = u.astype(object)
        assert (c == big.T @ big).all() and (s == big.sum(axis=0)).all()


VECTORS = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(6).normal(0, 0.3, (300, 12)) * np.arange(1, 13))]
BAD = [(900, None), (901, []), (902, [None] + [0.0] * 11), (903, [float("nan")] + [0.0] * 11), (904, [float("-inf")] + [0.0] * 11),
       (905, [1.0] * 5)]


def test_whitening(spark):
    rows = VECTORS + VECTORS[:4] + [(None, VECTORS[7][1])] + BAD
    df = _frame(spark, rows, "vec_id long, embedding array<float>", ("n", "w", "v", "component", "s", "i"))
    x = np.floor(1024 * np.array([np.float32(v) for _, v in rows[:305]], float)).astype(int) + 100000
    n, s = len(x), x.sum(axis=0)
    c = (x - s / n).T @ (x - s / n) / n
    e, vec = np.linalg.eigh(c)
    e, vec = e[::-1], vec[:, ::-1]
    for block in (64, 8192):
        got = whitening.whiten(df.repartition(3), block_rows=block).toPandas()
        assert len(got) == n * 8 and set(got.n) == {n} and got.identity_error.max() < 1e-9
        assert sorted(got[got.component == 1].vec_id.fillna(-1)) == sorted(-1 if r[0] is None else r[0] for r in rows[:305])
        by = {r[0]: k for k, r in enumerate(rows[:300])}
        for r in got[got.vec_id.notna()].itertuples():
            k = by[int(r.vec_id)]
            assert r.deviation == ((n * x[k] - s) ** 2).sum() == int(r.deviation_exact)
            want = (x[k] - s / n) @ vec[:, r.component - 1] / np.sqrt(e[r.component - 1])
            assert abs(abs(r.whitened) - abs(want)) < 1e-8
            assert abs(r.explained / (e[r.component - 1] / np.trace(c)) - 1) < 1e-9
        for k in range(1, 9):                                  # one sign for all rows
            own = got[(got.component == k) & got.vec_id.notna()].drop_duplicates("vec_id").set_index("vec_id").whitened
            want = np.array([(x[by[int(i)]] - s / n) @ vec[:, k - 1] for i in own.index])
            assert abs(np.sign(own.to_numpy() * want).sum()) == len(own)


def test_whitening_without_variance(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame(BAD[:5], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], kind)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = whitening.whiten(spark.createDataFrame([(k, [float(k), 2.0 * k, -float(k)]) for k in range(5)], kind)).toPandas()
    assert len(flat) == 15 and flat[flat.component > 1].whitened.isna().all() and flat.identity_error.max() < 1e-9
    wide = whitening.whiten(spark.createDataFrame([(k, [1e7 * k * k, 1.0 * k]) for k in range(40)], kind)).collect()
    assert all(r.deviation is None or r.deviation == int(r.deviation_exact) for r in wide) and any(r.deviation is None for r in wide)


# ---- 13: Merkle manifest
def plain_merkle(rows):
    """Expected rows as tuples, from lists level by level."""
    sha = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, t, lang, src, n):
        return sha(*map(field, (d, src, lang, n, t)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
        return levels

    def way(levels, r):
        for level in levels[:-1]:
            yield (r % 2, level[r ^ 1] if r ^ 1 < len(level) else None)
            r //= 2
    langs = {}
    for d, t, lang, src, n in rows:
        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        own = leaf(d, t, lang, src, n)
        langs.setdefault(lang, []).append((d is None, d or 0, own, d, leaf(d, t, lang, src, n + 1) if hit else own))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([x[2] for x in sorted(langs[k])]) for k in order}
    top = tree([trees[k][-1][0] for k in order])
    out = []
    for j, k in enumerate(order):
        for r, (_, _, own, d, node) in enumerate(sorted(langs[k])):
            steps = [*way(trees[k], r), *way(top, j)]
            for right, h in steps:
                node = sha(node) if h is None else sha(h, node) if right else sha(node, h)
            out.append((d, own, trees[k][-1][0], top[-1][0], sha("".join(h or "" for _, h in steps)), node, node == top[-1][0]))
    return sorted(out, key=repr)


KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("bits,per", [(1, 1), (1, 6), (2, 21), (3, 90)])
def test_merkle(spark, bits, per):
    rng = np.random.default_rng(per)
    rows = [(int(rng.integers(0, 10 ** 6)), f"text {k} é", lang, "s", k) for lang, m in (("en", per), ("de", per // 2), (None, 1), ("é", 1), ("z" * 9, 3))
            for k in range(m)]
    rows += [(None, "x", "en", None, None), (None, "x", "en", None, 3), (5, "t", "en", "s", 1), (5, "t", "en", "s", 1), (5, "", "en", "s", 1),
             (6, None, "en", "s", 1), (7, "w " * 40000, "", "s", 2 ** 63 - 1)]
    df = _frame(spark, rows, KIND, ("h", "r", "t", "block", "d0", "node", "up", "path", "leaf", "root"))
    got = merkle.merkle_manifest(df.repartition(3), bits=bits)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_merkle(rows)


def test_merkle_edges(spark):
    assert merkle.merkle_manifest(spark.createDataFrame([], KIND)).count() == 0
    one = merkle.merkle_manifest(spark.createDataFrame([(1, "a", "en", "s", 1)], KIND)).collect()
    assert [tuple(r) for r in one] == plain_merkle([(1, "a", "en", "s", 1)])


def test_merkle_plan_keeps_blocks_together(spark):
    rows = spark.range(2000).select(F.lit("=en").alias("t"), F.col("id").alias("r"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    up = rows.limit(0).select("t", "r", F.lit(None).cast(merkle._UP).alias("up"))
    plan = merkle._below(rows, up, 8)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 1 and "Join" not in plan and "SinglePartition" not in plan
