"""Every registered query against its DuckDB twin on the smallest test data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.registry import QUERIES as MAIN
from tidemark.registry_tables import QUERIES as TABLES

QUERIES = MAIN | TABLES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dd = con.sql(E.oracle_sql()[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dd)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_query_runs(spark):
    missing = sorted(set(QUERIES) - set(E.oracle_sql()))
    for name in missing:
        df = E.queries()[name](spark, SF)
        assert df.schema is not None
        df.limit(5).collect()


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "profit" in df.columns
