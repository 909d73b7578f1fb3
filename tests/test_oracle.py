"""The driver's correctness gate, in pytest: Spark query == DuckDB oracle SQL (sf0.001).

Columns compared by name, rows as an order-insensitive multiset of exact values."""

import duckdb
import pytest

from churnkit.plans.catalog import QUERIES as SQL_QUERIES
from churnkit.plans.jobs import JOB_QUERIES
from churnkit.plans.oracle import ORACLE
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"
QUERIES = {**SQL_QUERIES, **JOB_QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "orders", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_key_is_registered():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_spark_matches_duckdb(spark, con, name):
    sc, sr = rows_of(QUERIES[name](spark, SF).toPandas())
    dc, dr = rows_of(con.execute(ORACLE[name]).fetchdf())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
