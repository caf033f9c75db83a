"""Every query with oracle SQL agrees with DuckDB on the smallest tables:
column names, column types and the order-insensitive value multiset."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLES
from tools.oracle_check import SPARK_TO_DUCK, canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema} == {d[0]: str(d[1]) for d in res.description}
    assert canon(rows, df.columns) == canon(res.fetchall(), ocols)
