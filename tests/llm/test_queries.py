"""Registered queries against their SQL checks and their contracts."""

from __future__ import annotations

import zlib

import pytest

import __spark_entry__ as entry_points
import check_oracle
from ledgerloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op3_sharding", "op6_pii", "op10_quality_rules")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, connection, name):
    line = check_oracle.compare(spark, connection, SF_DIR, name)
    assert line.startswith("OK"), line


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(entry_points.queries())
    assert {name.split("_")[0] for name in queries.QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding_covers_all_documents(spark):
    rows = queries.op3_sharding(spark, SF_DIR).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
        assert r["law"] == "rows" and 0 <= r["shard"] < 16 and r["grown_shard"] is None
