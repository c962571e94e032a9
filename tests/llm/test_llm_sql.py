"""Queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest
from conftest import STAR

from checks.compare import rows_of
from stockrecon.llm.oracles import ORACLES
from stockrecon.llm.queries import QUERIES

FOLDER = f"{STAR}/sf0.001"


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "conversations"):
        made.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return made


@pytest.mark.parametrize("name", list(ORACLES))
def test_engines_agree(spark, connection, name):
    df, result = QUERIES[name](spark, FOLDER), connection.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(result.columns)
    rows = rows_of(df.columns, df.collect())
    assert rows and rows == rows_of(result.columns, result.fetchall())
