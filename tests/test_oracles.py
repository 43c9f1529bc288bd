"""Every registered query against its DuckDB oracle (sf0.001), as the
driver's correctness gate does at sf0.01; queries without an oracle must
run and return rows."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = os.environ.get("STARCAST_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
QUERIES = entry_mod.queries()
ORACLES = entry_mod.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        return v
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert canon(rows, cols) == canon(res.fetchall(), ocols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and "cold_start" in df.columns and len(df.columns) == 35
