"""Queries that SQL can express against their DuckDB SQL on sf0.001; the others run."""

import duckdb
import pytest

from candlewick.llm.queries import ORACLES, QUERIES

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(spark, name):
    df = QUERIES[name](spark, SF001)
    key = "doc_id" if "doc_id" in df.columns else None
    if key is None:  # searches: tested in their own files
        assert df.count()
        return
    ids = {r[0] for r in df.select("doc_id").collect()}
    docs = {r[0] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id").collect()}
    assert ids and ids <= docs and (name == "pipeline" or ids == docs)
