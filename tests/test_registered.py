"""Every registered query equals its SQL on DuckDB, whole tables on both sides."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from registered.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="driver tables not found")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.sql(f"create view {file.stem} as select * from '{file}'")
    return con


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = database.sql(ORACLES[name])
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == table_of(expected.columns, expected.fetchall())
    assert got[1], "an empty result proves nothing"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_one_row_of_each_kind_of_check_fails(spark):
    failed = {r["check_name"] for r in QUERIES["dq_suite"](spark, SF_DIR).where("not passed").collect()}
    assert failed == {"not_null", "unique", "no_rows_where", "column_set"}


def test_no_catalogue_entry_is_left(spark):
    QUERIES["external_table"](spark, SF_DIR)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("external_")]


def test_entry(spark):
    df = entry.entry(spark)
    assert "temp_max_abs" in df.columns and df.count() > 0


def test_scratch_lies_in_the_shared_folder(spark):
    from registered.tables import scratch

    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark).startswith(f"{shared}/skyfold-")
    assert scratch(spark) != scratch(spark)
