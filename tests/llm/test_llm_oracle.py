"""Queries of the training-data operators that SQL can express, against DuckDB."""

import os
import sys

import duckdb
import pytest

from tests_llm_data import SF
from voltlake.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "scripts"))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    from check_oracle import digest
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = digest(QUERIES[name](spark, SF).toPandas()), digest(con.execute(ORACLE[name]).fetchdf())
    assert got[:3] == want[:3]


def test_entry_registers_all(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert set(ORACLE) <= set(entry.oracle_sql())
