"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(repr(_norm(x)) for x in r) for r in pdf[cols].itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(E._QUERIES)))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _rows(got) == _rows(exp)


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(E._QUERIES) - set(E.oracle_sql())
    assert missing <= set(getattr(E, "NO_ORACLE", ()))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0
