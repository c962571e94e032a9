"""Run every query on Spark and its SQL in DuckDB and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [name ...]
"""

import sys
import time
from datetime import date, datetime

import duckdb

from checks.oracles import all_oracles
from checks.queries import all_queries
from stockrecon.session import build_session

STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def star_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in STAR:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(value):
    """One spelling per value; floats to twelve digits."""
    if value is None:
        return ""
    if isinstance(value, float):
        return f"{value:.12g}"
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder: str, name: str) -> str:
    """Empty when both engines agree, else what differs."""
    df = all_queries()[name](spark, folder)
    result = connection.sql(all_oracles()[name])
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} != {sorted(result.columns)}"
    kinds = dict(zip(result.columns, [str(t) for t in result.types]))
    plain = {"bigint": {"BIGINT"}, "string": {"VARCHAR"}, "double": {"DOUBLE"}, "date": {"DATE"},
             "timestamp_ntz": {"TIMESTAMP"}}
    types = [f"{c} {t}/{kinds[c]}" for c, t in df.dtypes if kinds[c] not in plain.get(t, set())]
    if types:
        return f"types {types}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(result.columns, result.fetchall())
    if ours != theirs:
        left, right = set(ours) - set(theirs), set(theirs) - set(ours)
        return f"{len(ours)} rows != {len(theirs)}; e.g. {sorted(left)[:2]} / {sorted(right)[:2]}"
    return "" if ours else "agree, but empty"


def main(folder: str, names: list[str]) -> int:
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = star_connection(folder), 0
    for name in names or list(all_queries()):
        start = time.time()
        try:
            problem = compare(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
