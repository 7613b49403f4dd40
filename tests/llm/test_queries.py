"""Every registered query over the driver's small tables: equal to its SQL, or whole where SQL can't say it."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from skyfold.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="driver tables not found")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = database.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == table_of(columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op10_license_scan"}))
def test_queries_without_sql_judge_the_whole_table(spark, database, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    documents = database.execute("select count(*) from documents").fetchall()[0][0]
    if name.startswith("op6_"):
        asked = database.execute("select count(*) from embeddings where vec_id % 50 = 0").fetchall()[0][0]
        assert len(found) == 5 * asked
    else:
        assert found["doc_id"].nunique() == documents


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "MinHash near-dedup", "suffix-array dedup", "mixing sources", "best-fit packing"]
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR).cache()
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= kept
        if name in ("quality rules", "MinHash near-dedup"):
            assert len(ids) < len(kept)
        else:
            assert ids == kept
        if name != names[-1]:
            assert out.columns == columns
        docs, kept = out, ids
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in whole.select("doc_id").collect()} == kept
