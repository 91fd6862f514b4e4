"""Every registered query against its DuckDB SQL on the sf0.001 tables, and
the driver contract of ``__spark_entry__``."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from voltlake.plans.registry import QUERIES  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def test_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"bzn", "hourly_datetime", "green_energy", "non_green_energy",
                               "total_energy", "green_proportion"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    got = digest(sdf.toPandas())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL form")
    exp = digest(con.execute(sql).fetchdf())
    assert got[:3] == exp[:3], (got[:2], exp[:2])
