"""Every registered query with an oracle equals its DuckDB SQL (sf0.001, order-insensitive)."""

import math

import pytest

import __spark_entry__ as E
from churnlane.plans import registry
from tests.conftest import SF_SMALL

E.queries()                    # loads the registry
QUERIES = registry.QUERIES     # the library's own; tests/llm covers the training-data queries
ORACLE = registry.ORACLE


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if type(v).__name__ == "Decimal":
        return round(float(v), 9)
    return v


def _rows(rows, cols, order):
    idx = [cols.index(c) for c in order]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    rel = con.sql(ORACLE[name])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    assert _rows(rows, cols, order) == _rows(orows, ocols, order)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "senior", "tenure", "monthly", "total", "prediction"]
    assert df.count() > 0


def test_every_query_is_value_checked():
    assert set(QUERIES) == set(ORACLE)
