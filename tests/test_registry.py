"""Every query with SQL gives the rows that DuckDB gives, over the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def canon(df):
    def one(x):
        if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
            return "[" + ",".join(one(y) for y in x) + "]"
        if x is None or type(x).__name__ in ("NaTType", "NAType") or (isinstance(x, float) and math.isnan(x)):
            return "null"
        x = x.item() if hasattr(x, "item") else x
        if isinstance(x, bool):
            return str(x)
        return f"{float(x):.9g}" if isinstance(x, (int, float)) else str(x)

    return sorted(tuple(one(x) for x in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in os.listdir(FOLDER):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{FOLDER}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("p")) + ["p3_found", "p20_p80", "pair_scores", "page_fields", "price_history", "props_unnest"])
def test_query_equals_sql(spark, duck, name):
    got, expected = entry.queries()[name](spark, FOLDER).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert canon(got) == canon(expected)


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
