"""Each operator against a brute-force version, on odd rows and on the smallest documents."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import (bpe, chunk_dedup, decontaminate, exact_dedup, graph, html_extract, line_dedup, packing, quality,
                         sharding, simhash, token_counts)

from .conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def rows(df, *cols):
    return sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect())))


# ---- 1 and 10: tokens
def test_token_counts(odd, none, small, tok):
    assert token_counts.token_counts(none, PATH).count() == 0
    for docs in (odd, small):
        want = [(r.doc_id, len((r.text or "").encode()), n := len(tok.encode(r.text or "", add_special_tokens=False)), n > 1024)
                for r in docs.collect()]
        got = rows(token_counts.token_counts(docs, PATH), "doc_id", "n_bytes", "n_tokens", "over_limit")
        assert got == sorted(map(repr, want))


def test_chunks_are_safe(tok):
    rng = np.random.default_rng(1)
    parts = ["a", "don't", "x ", "é", " ", "\t", "1,2", "a.b", ".", ",", "日本", "\r\n", "\x1c", "\u0085", "Foo", "Z,", "🙂",
             "​", "᠎", "<|endoftext|>"]
    for _ in range(1500):
        x = "".join(rng.choice(parts) + rng.choice(["", " ", "  ", "\n", " \n"]) for _ in range(rng.integers(0, 12)))
        assert np.frombuffer(b"".join(bpe.id_blocks(PATH, x)), "<u4").tolist() == tok.encode(x, add_special_tokens=False).ids
    long = " ".join(parts * 300)
    assert "".join(bpe.blocks(long, 100)) == long


@pytest.mark.parametrize("open_windows", [1, 64])
def test_packing(odd, none, small, tok, open_windows):
    assert packing.pack(none, PATH).count() == 0
    for docs in (odd, small.repartition(5)):
        got = packing.pack(docs, PATH, size=128, open_windows=open_windows).toPandas()
        want = Counter()
        for r in docs.collect():
            ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            want[r.doc_id, len(ids), tuple((a, len(ids[a:a + 128]), zlib.crc32(ids[a:a + 128].tobytes())) for a in range(0, len(ids), 128))] += 1
        pieces = Counter()
        for (d, n, cuts), k in want.items():
            for c in cuts:
                pieces[d, n, c] += k
        assert pieces == Counter((None if d != d else int(d), n, (s, m, c)) for d, n, s, m, c in
                                 got[["doc_id", "doc_tokens", "start", "length", "ids_crc32"]].itertuples(index=False))
        for _, g in got.sort_values("offset").groupby("sequence_id"):
            assert g.length.sum() <= 128 and (g.length.cumsum() - g.length).tolist() == g.offset.tolist()


def test_leftovers_merge_over_levels(spark):
    left = spark.createDataFrame([(p * packing.SPAN + 1, 30) for p in range(200)], "window long, fill long")
    moves = packing.merge_leftovers(left, 100).toPandas()
    assert sorted(moves.window) == [p * packing.SPAN + 1 for p in range(200)]
    per = moves.groupby("to")["shift"].apply(sorted)
    assert all(s == list(range(0, 30 * len(s), 30)) and len(s) <= 3 for s in per) and len(per) <= 70


# ---- 2: substring dedup
def test_cuts_follow_content():
    data = bytes(np.random.default_rng(2).integers(97, 123, 20000, dtype=np.uint8))
    h, want = 0, []
    for i, b in enumerate(data):
        h = ((h << 2) + int(chunk_dedup.GEAR[b])) & 0xFFFFFFFF
        if h >> (32 - chunk_dedup.BITS) == 0:
            want.append(i + 1)
    got = chunk_dedup.cuts(data, longest=1 << 30).tolist()
    assert [x for x in got if x > 16 and x < len(data)] == [x for x in want if x > 16 and x < len(data)]
    moved = chunk_dedup.cuts(b"inserted text " + data, longest=1 << 30)
    assert len(set((moved - 14).tolist()) & set(got)) > 0.98 * len(got)
    assert chunk_dedup.cuts(b"a" * 2000, longest=512)[-1] == 2000 and len(chunk_dedup.cuts(b"")) == 0


def test_repeated_runs(spark, odd, none):
    assert chunk_dedup.repeated_runs(none).count() == 0
    assert {r.doc_id for r in chunk_dedup.repeated_runs(odd).collect()} <= {4, 5, 6}
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 9)))
    texts = [" ".join(word() for _ in range(200)) for _ in range(40)]
    passage = " ".join(word() for _ in range(60))
    planted = {i: t[:300 + i] + " " + passage + " " + t[300 + i:] if i % 4 == 0 else t for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    runs = chunk_dedup.repeated_runs(docs)
    got = runs.collect()
    assert {r.doc_id for r in got} == {i for i in planted if i % 4 == 0 and i > 0} and {r.first_doc_id for r in got} == {0}
    seen, want = set(), defaultdict(list)                     # brute force over chunks
    for i, t in sorted(planted.items()):
        data, at = t.encode(), 0
        for e in chunk_dedup.cuts(data).tolist():
            if data[at:e] in seen:
                if want[i] and want[i][-1][1] == at:
                    want[i][-1][1] = e
                else:
                    want[i].append([at, e])
            seen.add(data[at:e])
            at = e
    assert sorted((r.doc_id, r.start, r.stop) for r in got) == sorted(
        (i, a, b) for i, v in want.items() for a, b in v if b - a >= chunk_dedup.SHORTEST_RUN)
    cut = {r.doc_id: r.text for r in chunk_dedup.delete_runs(docs, runs).collect()}
    assert cut[0] == planted[0] and len(cut[4]) < len(planted[4]) - 200


def test_short_runs(spark):
    texts = ["A short note.", "A short note.", "Other words", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r.doc_id, r.start, r.stop, r.n_bytes, r.first_doc_id) for r in chunk_dedup.repeated_runs(docs).collect()] == [(1, 0, 13, 13, 0)]
    tail = "so the very same end of a text stands here, long enough for a cut and yet below a hundred bytes"
    docs = spark.createDataFrame([(0, "first one " + tail), (1, "not the second " + tail)], "doc_id long, text string")
    assert chunk_dedup.repeated_runs(docs).count() == 0
    got = chunk_dedup.repeated_runs(docs, shortest=1).collect()
    assert got and all(r.n_bytes < 100 and r.doc_id == 1 for r in got)


def test_query_leaves_short_runs(spark, tmp_path):
    from tessera.llm import queries
    common = "so the very same end of a text stands here, long enough for a cut and yet below a hundred bytes"
    passage = " ".join(f"word{k}" for k in range(60))
    spark.createDataFrame([(0, "first one " + common), (1, "not the second " + common), (2, passage + " tail of its own"),
                           (3, "a head of its own " + passage)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in queries.op2_substring_dedup(spark, str(tmp_path)).collect()} == {3}


@pytest.mark.parametrize("share", [1e-3, 0.02, 0.9])
def test_hot_chunks(spark, monkeypatch, share):
    """A passage in a third of the rows: the same runs however its chunks are dealt."""
    monkeypatch.setattr(chunk_dedup, "HOT_SHARE", share)
    rng = np.random.default_rng(8)
    own = lambda n: "".join(rng.choice(list("abcdefghijklmnop "), n))
    passage = own(400)
    docs = [(i if i % 50 else None, own(300) + (passage if i % 3 == 0 else "") + own(200)) for i in range(300)]
    docs += [(7, docs[8][1]), (8, docs[8][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    seen, want = {}, Counter()
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        data, at, run = text.encode(), 0, None
        for e in chunk_dedup.cuts(data).tolist():
            if data[at:e] in seen:
                run = [run[0], e, run[2]] if run and run[1] == at else [at, e, seen[data[at:e]]]
            else:
                if run:
                    want[doc_id, *run] += 1
                run, seen[data[at:e]] = None, doc_id
            at = e
        if run:
            want[doc_id, *run] += 1
    got = chunk_dedup.repeated_runs(df.repartition(4), shortest=1).collect()
    assert Counter((r.doc_id, r.start, r.stop) for r in got) == Counter((d, a, b) for d, a, b, _ in want.elements())
    assert Counter((r.doc_id, r.start, r.first_doc_id) for r in got if r.first_doc_id is not None and r.doc_id is not None) == Counter(
        (d, a, f) for d, a, b, f in want.elements() if f is not None and d is not None)


# ---- 3: SimHash
def brute_components(prints, radius=3):
    at = sorted(set(prints))
    root = {f: f for f in at}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(at):
        for b in at[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in at}


def brute_print(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash(odd, none, small):
    assert simhash.simhash_components(none).count() == 0
    for docs in (odd, small):
        data = [(r.doc_id, brute_print(r.text[:20000] if r.doc_id in (5,) and docs is odd else r.text)) for r in docs.collect()]
        group = brute_components([f for _, f in data])
        ids = defaultdict(list)
        for d, f in data:
            ids[group[f]] += [d] if d is not None else []
        want = [(d, f"{f:016x}", min(ids[group[f]], default=None)) for d, f in data]
        assert rows(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id") == sorted(map(repr, want))


def test_shards_in_parts_and_trees(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 30, dtype=np.int64)
    near = [int(b) ^ int(sum(1 << int(x) for x in rng.choice(62, k, replace=False))) for b in base for k in (0, 1, 2, 3, 4, 2, 3)]
    near = sorted(set(near))
    want = brute_components(near)
    for shard in (4096, 7):                            # 7: hot shards fall into parts
        links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in near], "fp long"), shard=shard)
        got = {r.node: r.label for r in graph.connected_components(links).collect()}
        same = lambda m: Counter(frozenset(x for x in near if m.get(x, x) == v) for v in {m.get(x, x) for x in near})
        assert same(got) == same(want)


def test_chain_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (None, 3)], "a long, b long")
    got = graph.connected_components(chain).collect()
    assert len(got) == 61 and len({r.label for r in got}) == 1
    assert graph.connected_components(chain.limit(0)).count() == 0


def test_keep_one(odd, small):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    n = len(set(brute_components([brute_print(r.text) for r in odd.collect()]).values()))
    assert kept.count() == n and None not in {r.doc_id for r in kept.where("text = ''").collect()}
    comps = simhash.simhash_components(small)
    assert sorted(r.doc_id for r in simhash.keep_one(small).collect()) == sorted(
        r[0] for r in comps.select("component_id").distinct().collect())


# ---- 4: sharding
@pytest.mark.parametrize("shards", [3, 40])
def test_sharding(spark, odd, none, small, shards):
    assert sharding.balanced_shards(none).count() == 0
    hot = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"t{i // 2}") for i in range(600)], "doc_id long, text string")
    for docs in (odd, small, hot):
        got = sharding.balanced_shards(docs, shards).toPandas()
        n = got.groupby("shard").size().reindex(range(shards), fill_value=0)
        assert len(got) == docs.count() and n.max() - n.min() <= 1
        assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard").slot)
        assert rows(docs.selectExpr("doc_id", "coalesce(octet_length(text), 0) + 16 s"), "doc_id", "s") == sorted(
            repr((None if d != d else int(d), int(s))) for d, s in zip(got["doc_id"], got["size"]))
    if shards == 3:                                    # two thirds are linked: pairs stay whole, most of the hot group too
        text = {r.doc_id: r.text for r in hot.collect()}
        where = defaultdict(Counter)
        for d, s in zip(got["doc_id"], got["shard"]):
            where[text[d]][s] += 1
        assert max(where.pop("hot").values()) >= 150 and sum(len(s) > 1 for s in where.values()) <= 3


@pytest.mark.parametrize("members", [2, 3, 4])
def test_shards_exchange_units(spark, members):
    """Full shards: the rounds themselves gather the groups, and the placement leaves them where they are."""
    n, shards = 12_000, 10
    units = (spark.range(n).select(F.unhex(F.md5(F.floor(F.col("id") / members).cast("string"))).alias("hub"),
                                   F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"))
             .groupBy("hub", "shard").agg(F.count("*").alias("size"))
             .select("hub", F.lit(0).cast("long").alias("part"), "size", "shard"))
    groups = n // members

    def cut(df):
        return df.groupBy("hub").agg(F.count_distinct("shard").alias("n")).where("n > 1").count()

    out = sharding.propagate(units, n, shards)
    assert out.agg(F.sum("size")).first()[0] == n
    assert cut(units) > 0.5 * groups and cut(out) <= 0.02 * groups
    load = [r["n"] for r in out.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert max(load) <= 1.05 * n / shards              # the slack is gone
    places = sharding.place(out, n, shards)
    kept = places.join(out.groupBy("hub").agg(F.max_by("shard", "size").alias("was")), "hub").where("shard = was").count()
    assert kept >= 0.95 * groups


def test_quotas_balance():
    asked = np.array([[0, 30, 0], [10, 0, 0], [5, 50, 0]])
    q = sharding._quotas(asked, np.array([0, 0, 0]), 0)
    assert (q <= asked).all() and (q.sum(0) - q.sum(1) <= 2).all() and 8 <= q[0, 1] <= 12
    assert (sharding._quotas(asked, np.array([100, 100, 100]), 0) == asked).all()


@pytest.mark.parametrize("rows_, members, linked", [(4000, 2, 4000), (4000, 4, 4000), (4000, 3, 2400), (4000, 7, 4000)])
def test_sharding_keeps_groups_whole_in_full_shards(spark, rows_, members, linked):
    docs = spark.createDataFrame([(i, f"g{i // members}" if i < linked else f"own {i}") for i in range(rows_)],
                                 "doc_id long, text string")
    got = sharding.balanced_shards(docs, 10).toPandas()
    n = got.groupby("shard").size()
    cut = (got[got.doc_id < linked].groupby(got.doc_id // members).shard.nunique() > 1).sum()
    assert len(got) == got.doc_id.nunique() == rows_ and len(n) == 10 and n.min() == n.max()
    assert cut == 0 if members < 7 else cut < 10      # 400 rows a shard are no multiple of 7


# ---- 5: exact dedup
def test_exact_dedup(odd, none, small):
    assert exact_dedup.exact_dedup(none).count() == 0
    for docs in (odd, small):
        for whole in (True, False):
            got = exact_dedup.exact_dedup(docs, digest_all=whole).toPandas()
            groups = defaultdict(list)
            for r in docs.collect():
                t = r.text or ""
                groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), r.doc_id is None, r.doc_id or 0, r.doc_id))
            want = Counter((d, min(g)[3], len(g)) for g in groups.values() for *_, d in g)
            none_ = lambda x: None if x != x else int(x)
            assert want == Counter((none_(d), none_(k), n) for d, k, n in zip(got.doc_id, got.keep_id, got.group_size))
            assert got.kept.sum() == len(groups)


# ---- 6: quality
def test_quality(spark, odd, none, small):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    empty = quality.quality_scores(none, labels)
    assert empty.count() == 0
    got = quality.quality_scores(odd, labels.limit(0)).toPandas()
    assert len(got) == len(ODD) and (got.score == 0.5).all()
    ten = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas().set_index("doc_id").quality
    out = quality.quality_scores(ten, spark.read.parquet("/root/testdata/sf0.1/labels.parquet")).toPandas()
    assert len(out) == 10000 and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in out.doc_id]).all()
    held = out[out.held_out & out.doc_id.isin(marks.index)]
    y = held.doc_id.map(marks)
    assert ((held.predicted == y).mean()) > 0.97 and held[y == 1].predicted.mean() > 0.98
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns


def test_hinge_fit_separates():
    rng = np.random.default_rng(5)
    x = [np.unique(rng.integers(0, 50, 5) + 50 * (i % 2)).astype(np.int32) for i in range(200)]
    w, b = quality.hinge_fit(x, np.arange(200) % 2, np.ones(100))
    assert all((w[f].sum() + b > 0) == (i % 2) for i, f in enumerate(x))


# ---- 7: decontamination
ITEM = ("Alice has 12 apples and gives 5 kg of pears to her friend Bob before the long train to Paris leaves at night. "
        "How many apples does Alice have when Bob arrives in Paris with 12 more apples?")


def test_decontamination(spark, odd, none):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (None, ITEM), (3, "two words"), (4, "")], "item_id long, text string")
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.limit(0)).count() == 0
    swapped = ITEM.replace("Alice", "Maria").replace("Bob", "Ivan").replace("12", "31").replace("Paris", "Rome").replace(" 5 ", " 9 ")
    head, tail = swapped.split(". ")                    # the second sentence gives every slot another value
    broken = head + ". " + tail.replace("Maria", "Olga").replace("Ivan", "Pete").replace("Rome", "Oslo").replace("31", "77")
    noise = " ".join(f"w{chr(97 + i % 26)}x{chr(97 + i % 7)}" for i in range(400))
    docs = spark.createDataFrame([
        (1, f"{noise}\n{ITEM}\n{noise}"), (2, f"{noise} . {swapped}\n{noise}"), (3, ITEM[:70] + noise), (4, noise), (5, None),
        (6, ITEM.lower().replace("apples", "plums")), (7, (noise + " ") * 1200 + ITEM), (8, broken)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert {k for k in got if k[0] != 8} == {(1, 1), (2, 1), (7, 1)}
    assert got[1, 1].n_changed == 0 and got[2, 1].n_changed >= 5 and got[1, 1].coverage == 1.0
    assert got[2, 1].coverage == 1.0 > got[8, 1].coverage       # contradicting values do not count as covered
    blocks = decontaminate.contaminated(docs, bench, block_chars=50)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(got)
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()) == [3, 4, 5, 6]


def found_in(item, *texts):
    bench = decontaminate.Benchmark([(1, item)], decontaminate.WINDOW)
    return [next(iter(bench.matches(t, decontaminate.SHARE)), None) for t in texts]


def test_decontamination_of_number_series():
    item = "Sort the numbers 17, 4, 9, 12, 45, 6, 8, 21, 5, 7, 2, 30, 11, 19"
    other = "Sort the numbers 18, 3, 10, 13, 46, 60, 80, 22, 50, 70, 20, 31, 12, 15"
    same, changed, twice, words = found_in(item, f"noise here {item} and more", other, other.replace("22", "18").replace("50", "18")
                                           .replace("70", "18").replace("15", "18"), "Sort the numbers one by one " * 5)
    assert same[2:] == (1.0, 0) and changed[2:] == (1.0, 14) and twice is None and words is None


def test_decontamination_whatever_the_case():
    german = ("Der Bäcker verkauft am Morgen 12 Brote und am Abend 7 Brote an die Kinder der Stadt Bremen. Wie viele Brote hat "
              "der Bäcker am Ende der Woche verkauft?")
    for item in (ITEM, german, "Which of these came first: The Lord Of The Rings, The Return Of The King or The Hobbit?"):
        assert all(m[2:] == (1.0, 0) for m in found_in(item, item, item.lower(), item.upper(), item.title()))
        assert found_in(item, item.lower().replace("e", "o")) == [None]


def test_decontamination_of_short_items_and_scripts_without_spaces():
    same, case, number, apart, part = found_in("Solve 12 apples", "x solve it? Solve 12 apples. y", "SOLVE 12 APPLES", "Solve 13 apples",
                                               "solve the 12 apples", "solve 12")
    assert same == case == (1, 1, 1.0, 0) and number is apart is part is None
    assert found_in("Paris", "from Paris to", "paris", "Parisian") == [(1, 1, 1.0, 0)] * 2 + [None]
    for item in ("小明有十二个苹果他给了小红五个还剩几个苹果", "東京から大阪までの距離は何キロですか", "เมืองหลวงของประเทศไทยคืออะไร", "日本の首都"):
        same, other = found_in(item, f"前の文章です{item}次の文章です", item[::-1])
        assert same[2:] == (1.0, 0) and other is None


def test_decontamination_signs_and_short_questions():
    item = "Compute the value of 12 + 30 now"
    assert [m is not None for m in found_in(item, *[item, "compute the value of 13 + 31 now", "Compute the value of 12 - 30 now",
                                                  "Compute the value of 12 / 30 now", "Compute the value of 12 30 now"])] == [
        True, True, False, False, False]
    assert found_in("What is 12 + 30?", "So: What is 13 + 31? Well", "What is 13 - 31?") == [(1, 1, 1.0, 2), None]


def test_decontamination_of_windows_that_many_items_share():
    import time
    stem = "Which of the following is the best description of "
    letters = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    items = [(k, stem + " ".join(letters(k * m + m) for m in (1, 3, 7, 11, 13, 17, 19, 23, 29, 31, 37))) for k in range(30_000)]
    bench = decontaminate.Benchmark(items, decontaminate.WINDOW)
    doc = (stem + "something else entirely. ") * 100 + items[777][1] + "."
    began = time.time()
    assert [m[0] for m in bench.matches(doc, decontaminate.SHARE)] == [777] and time.time() - began < 1


def test_decontamination_of_planted_questions(spark):
    """Copies with other numbers and names, against a search of every item at every place."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    name = lambda: word().capitalize()
    number = lambda: str(rng.integers(2, 900))
    shapes = [[word() if rng.random() < 0.7 else rng.choice(["#", "@"]) for _ in range(rng.integers(8, 25))] for _ in range(40)]
    fill = lambda shape: " ".join(number() if w == "#" else name() if w == "@" else w for w in shape)
    items = [(k, "so " + fill(s)) for k, s in enumerate(shapes)]
    noise = lambda: " ".join(word() if rng.random() < 0.8 else name() if rng.random() < 0.5 else number() for _ in range(30))
    docs, want = [], set()
    for d in range(120):
        k = int(rng.integers(0, len(shapes)))
        if d % 3 == 0:
            docs.append((d, noise() + ". so " + fill(shapes[k]) + ". " + noise()))
            want.add((d, k))
        elif d % 3 == 1:                                       # half of the words replaced
            docs.append((d, noise() + ". so " + fill([w if j % 2 else word() for j, w in enumerate(shapes[k])])))
        else:
            docs.append((d, noise()))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert {r.doc_id for r in decontaminate.drop_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench)
            .collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_decontamination_finds_verbatim_items(spark, small):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = {(d.doc_id, b.item_id) for d in small.collect() for b in bench.collect() if b.text in d.text}
    assert want and {(r.doc_id, r.item_id) for r in decontaminate.contaminated(small, bench).collect()} == want


# ---- 8: HTML
PAGE = """<html lang=en><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav><div class="sidebar box"><p>Side text</div>
<script>var t="<p>no</p>";</script><!-- <p>no</p> --><article><header><h1>Title &amp; more</h1></header>
<p>First <b>bold<br>line</b>  &lt;tag&gt;.<p>Second&nbsp;one.<aside>Aside</aside><div class=comments><p>Nice post</p></div>
<form><p>Name</p></form><p hidden>gone</p><blockquote>Quote.</blockquote></article><footer>End</footer>"""


def test_html(spark):
    assert html_extract.main_text(PAGE) == "Title & more\nFirst bold line <tag>.\nSecond one.\nQuote."
    plain = "The cat and the dog are in the house with a lot of friends. " * 4
    page = f"<div><a href=1>one</a> <a href=2>two</a></div><h2>Short</h2><p>{plain}</p><p>Tiny.</p><p>{plain}</p><div><a>m</a></div>"
    assert html_extract.main_text(page) == "\n".join(["Short", plain.strip(), "Tiny.", plain.strip()])
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (None, None, None, "x"), (2, "u", "", "x"), (2, "u", "<p", "x"),
                                   (3, "u", "<article>" + "<p>a b</p>" * 20000, "x")],
                                  "page_id long, url string, html string, text string")
    got = {(r.page_id, r.n_chars) for r in html_extract.extract_pages(pages).collect()}
    assert got >= {(None, 0), (2, 0), (3, 79999)} and html_extract.extract_pages(pages.limit(0)).count() == 0


PROSE = ("The mayor said on Monday that the bridge over the river will be closed for three months, because the old "
         "pillars have to be replaced before the winter and the work cannot be done while cars are on it. ")


@pytest.mark.parametrize("before,after", [
    ('<div class="layout has-sidebar"><article>', "</article><div class='sidebar'>Links</div></div>"),
    ('<main class="site-main no-comments">', "</main>"), ('<article class="post related-off">', "</article>"),
    ('<div class="search-page-off"><article>', "</article></div>"), ("<form action=/x><article>", "</article></form>"),
    ('<a name="top"><div>', "</div>"), ("<div title=it's>", "</div>"), ("<article><video src=a>", "</article>"),
    ("<article><svg width=1>", "</article>"), ("<form><div>", "</div></form>"), ('<a href="/x"><div><h2>T</h2>', "</div>"),
    ("<article><!-- never closed>", "</article>"), ("<div><p class=x <p>", "</div>")])
def test_html_keeps_the_article(before, after):
    paragraphs = [f"{k}. {PROSE}I don't know." for k in range(5)]
    page = f"<html><body><nav><a href=/>Home</a></nav>{before}" + "".join(f"<p>{p}</p>" for p in paragraphs) + f"{after}<footer>Imprint</footer>"
    got = html_extract.main_text(page).split("\n")
    assert [x for x in got if x not in ("T", "0")] == paragraphs


def test_html_marked_elements_stay_out():
    page = (f"<article><p>{PROSE}</p><p>{PROSE}</p></article><div class='comments'><p>{PROSE * 3}</p><p>{PROSE * 3}</p></div>"
            f"<div class='page-sidebar'><p>{PROSE}</p></div><aside><article><p>{PROSE}</p></article></aside>")
    assert html_extract.main_text(page) == "\n".join([PROSE.strip()] * 2)


@pytest.mark.parametrize("piece", ["<a ", '<p title="', "<p title='x", "<!", "<!--", "</", "<p", "<div>", "<svg>", "<script", "<div></p>", "<a href=x>y", "=  "])
def test_html_of_a_megabyte_left_open(piece):
    import time
    page = f"<article><p>{PROSE}</p>" + piece * (1_000_000 // len(piece)) + "</div>" * 1000
    began = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - began < 4


def test_html_of_other_languages_and_short_paragraphs():
    menu = "<div><a href=1>Koti</a> <a href=2>Uutiset</a></div>"
    finnish = "Kissa ja koira asuvat vanhassa talossa metsän laidalla, jossa lapset leikkivät joka päivä kesällä ja talvella. " * 2
    dutch = "De kat en de hond wonen samen met veel vrienden aan het water, waar kinderen elke dag na school komen spelen. " * 2
    for text in (finnish, dutch, "小さな町の図書館は毎日たくさんの子どもたちが集まります。" * 8):
        page = f"{menu}<div><h2>Otsikko</h2><p>{text}</p><p>{text}</p></div><footer>Loppu</footer>"
        assert html_extract.main_text(page) == "\n".join(["Otsikko", text.strip(), text.strip()])
    short = [f"Line {i} of a poem that has no long paragraph at all." for i in range(6)]
    page = f"{menu}<div>{''.join(f'<p>{x}</p>' for x in short)}</div><div>Copyright</div><div class=footer>{'<p>End</p>' * 90}</div>"
    assert html_extract.main_text(page) == "\n".join(short)
    assert html_extract.main_text(menu * 40) == html_extract.main_text("<div><p>Too little</p></div>") == ""


def test_html_articles_of_the_test_pages(spark):
    import html
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert html_extract.main_text(r.html) == "\n".join(b for b in blocks if b)


# ---- 9: line dedup
def brute_lines(docs, min_words):
    """Every line inside a run of min_words words or more that occurs earlier; all runs are tried."""
    from hashlib import md5
    order = sorted({(d is None, d or 0, md5(f"{'-' if d is None else d}|{t}".encode()).digest(), t) for d, t in docs if t is not None})
    count = lambda x: len(re.findall(LINE_WORD, x))
    seen, out = set(), {}
    for key in order:
        ls = key[3].split("\n")
        full = [(i, x, count(x)) for i, x in enumerate(ls) if count(x)]
        cut = set()
        for a in range(len(full)):
            words, run = 0, 0
            for b in range(a, len(full)):
                words, run = words + full[b][2], hash((run, b > a and full[b][0] > full[b - 1][0] + 1, full[b][1]))
                if words >= min_words:
                    if run in seen:
                        cut |= set(range(full[a][0], full[b][0] + 1))
                    seen.add(run)
        out[key[2], key[3]] = "\n".join(x for i, x in enumerate(ls) if i not in cut)
    return out


UNSPACED = re.sub(r"\\x\{(\w+)\}", r"\\u\1", line_dedup.UNSPACED)
LINE_WORD = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]+"


@pytest.mark.parametrize("min_words", [10, 1, 3])
def test_line_dedup(spark, odd, none, small, min_words):
    from hashlib import md5
    assert line_dedup.line_dedup(none).count() == 0
    rng = np.random.default_rng(6)
    parts = ["", "  ", "a", "b", "c d", "the same line", "of six words and no more", "own {i} x", "图书馆", "a line of ten words that stands well by itself here"]
    mixed = spark.createDataFrame([(i, "\n".join(x.format(i=i) for x in rng.choice(parts, rng.integers(0, 25)))) for i in range(150)],
                                  "doc_id long, text string")
    for docs in (odd, small, mixed):
        out = line_dedup.line_dedup(docs.withColumn("was", docs["text"]), min_words=min_words)
        assert out.columns[:len(docs.columns)] == docs.columns
        want = brute_lines([(r.doc_id, r.text) for r in docs.collect()], min_words)
        for r in out.collect():
            if r.was is None:
                assert r.text is None and r.n_lines == 0
            else:
                k = md5(f"{'-' if r.doc_id is None else r.doc_id}|{r.was}".encode()).digest()
                assert r.text == want[k, r.was] and r.n_lines == r.was.count("\n") + 1


def test_passages_whatever_their_neighbours(spark):
    import corpus_pipeline
    line = "This work is licensed under the General Public Licence, version two or any later one."
    x, y = "a first line of seven words here", "and four more words"
    docs = spark.createDataFrame([(1, f"a\n{line}\nb"), (2, f"c\n{line}\nd"), (3, f"{line}\ne\n{line}"),
                                  (4, f"{x}\n{y}"), (5, f"w\n{x}\n{y}\np"), (6, f"q\nw\n{x}\n{y}\nr"), (7, f"{y}\nt\n\n{x}"), (8, None),
                                  (9, "w"), (10, "a\na\na"), (11, "Short\nDate: today\nMenu"), (12, "Short\nDate: today\nMenu")],
                                 "doc_id long, text string")
    # 6 keeps nothing of the run w, x, y: x, y meets document 4, w with them document 5
    want = {1: f"a\n{line}\nb", 2: "c\nd", 3: "e", 4: f"{x}\n{y}", 5: "w\np", 6: "q\nr", 7: f"{y}\nt\n\n{x}", 8: None, 9: "w",
            10: "a\na\na", 11: "Short\nDate: today\nMenu", 12: "Short\nDate: today\nMenu"}
    for out in (line_dedup.line_dedup(docs), corpus_pipeline.without_repeated_lines(spark, docs, "")):
        assert {r.doc_id: r.text for r in out.collect()} == want


def test_line_dedup_of_many_lines(spark):
    """One text of 20,000 short lines, and one of as many blank ones inside a passage; both are copied."""
    long = "\n".join(f"line {i} {i * 7919 % 1009}" for i in range(20000))
    blank = "five words stand up here" + "\n" * 20000 + "and five more down there"
    docs = spark.createDataFrame([(1, long), (2, blank), (3, f"x\n{long}\ny"), (4, f"x\n{blank}\ny")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_cut) for r in line_dedup.line_dedup(docs).collect()}
    assert got == {1: (long, 0), 2: (blank, 0), 3: ("x\ny", 20000), 4: ("x\ny", 20001)}


def test_line_dedup_stays_native(small):
    plan = line_dedup.line_dedup(small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    plan = exact_dedup.exact_dedup(small, digest_all=True)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_words_are_counted_up_to_the_most_asked(spark):
    """As many as the word pattern finds, in any script and white space, but never more than asked."""
    from pyspark.sql import functions as F

    from tessera.llm import line_dedup as ld
    lines = ["", " ", "\t\x0b \x0c\r", "a", " a  b\tc\x0bd ", "漢字 ab漢c字d", "ไทย", "x y z\u0085w", "a " * 9, "a " * 10, " a" * 11 + " ",
             "漢" * 10, "漢" * 9 + "a", "ab" * 500, "w " * 500, "😀 é 漢", "a\x00b c"]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    whole = F.size(F.regexp_extract_all("x", F.lit(ld.WORD), F.lit(0)))
    for most in (1, 3, 10):
        assert df.where(ld._words(F.col("x"), most) != F.least(whole, F.lit(most))).count() == 0
