"""The registered queries with SQL, and the pipeline stage by stage."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "scripts"))

import __spark_entry__ as entry
import corpus_pipeline
from oracle_check import canon
from tessera.llm import decontaminate, line_dedup, queries, simhash

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert names >= set(queries.QUERIES) | {"pipeline"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    assert canon(entry.queries()[name](spark, SF).toPandas()) == canon(con.execute(queries.ORACLES[name]).df())


def test_stages(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, SF), "test")
        assert docs.columns == first.columns
        a, b = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in docs.collect()}
        if name == "line_dedup":
            assert b == {r.doc_id: r.text for r in line_dedup.line_dedup(before).collect()}
        else:
            assert b.items() <= a.items()
        if name == "simhash":
            assert set(b) == {r.component_id for r in simhash.simhash_components(before).collect()}
        if name == "decontamination":
            hit = {r.doc_id for r in decontaminate.contaminated(before, bench).collect()}
            assert set(b) == set(a) - hit
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in docs.collect()}


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        if "sequence_id" not in docs.columns:
            docs = corpus_pipeline.staged(docs, "none")
