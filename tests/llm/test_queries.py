"""The queries that SQL can express give the rows that DuckDB gives; the others run over the smallest tables."""

import math
import os

import pytest

from machiya.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
COLUMNS = {
    "p1_found": ["groupId", "propertyId"], "p2_found": ["propertyId", "id"], "p4_found": ["groupId", "fieldName", "propertyId"], "p5_found": ["_cityName", "_period", "fieldName"],
    "p6_found": ["propertyId1", "propertyId2"], "p8_found": ["doc_id", "item_id"], "p9_found": ["source"], "p10_found": ["doc_id"],
}


def canon(df):
    def one(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return "null"
        return f"{float(x):.9g}" if isinstance(x, (int, float)) else str(x)

    return sorted(tuple(one(x.item() if hasattr(x, "item") else x) for x in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{FOLDER}/{file}'")
    assert canon(queries.QUERIES[name](spark, FOLDER).toPandas()) == canon(con.sql(queries.SQL[name]).df())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = df.collect()
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows)
