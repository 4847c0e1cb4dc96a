"""Every registered query against its DuckDB oracle SQL on sf0.001
(the driver does the same on sf0.01 with ``tools/oracle_check.py``)."""

import math
from decimal import Decimal

import duckdb
import pytest

from candlewick.plans.catalog import ORACLES, QUERIES
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    rel = con.sql(ORACLES[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(rel.columns, rel.fetchall())


def test_injection_without_checkpoint_folder(spark, monkeypatch):
    """With no shared folder the lineage is not cut; results are the same."""
    from candlewick import session
    from candlewick.plans import q_clean

    with_cut = sorted(map(tuple, q_clean.messy(spark, SF001).collect()), key=repr)
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    without = sorted(map(tuple, q_clean.messy(spark, SF001).collect()), key=repr)
    assert with_cut == without
