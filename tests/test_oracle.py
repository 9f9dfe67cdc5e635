"""Every registered query against its DuckDB oracle SQL at sf0.001."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, decimal.Decimal):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in t))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


#: Queries the entry adds from the training-data subpackage; tests/llm checks those.
ADDED = set(E.LLM.QUERIES if E.LLM else ()) | {"pipeline"}


def test_every_query_has_oracle():
    assert set(E.oracle_sql()) - ADDED == set(E.queries()) - ADDED


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - ADDED))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    cols = sorted(df.columns)
    got = _sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    dcols = [x[0] for x in res.description]
    assert sorted(dcols) == cols
    want = _sorted([tuple(_norm(r[dcols.index(c)]) for c in cols) for r in res.fetchall()])
    assert got == want


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.count() > 0
    assert out.columns == ["rule_id", "ticker", "date", "value"]
