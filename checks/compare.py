"""Run queries beside their oracle and report where they differ: python -m checks.compare [folder] [name ...]"""

from __future__ import annotations

import importlib
import sys
import time
from pathlib import Path

import duckdb

from stayline.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def canonical(rows, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def compare(spark, connection, folder: str, query, sql: str) -> str | None:
    """None where both agree, else what differs."""
    frame = query(spark, folder)
    got = canonical([tuple(row) for row in frame.collect()], frame.columns)
    answer = connection.execute(sql)
    columns = [column[0] for column in answer.description]
    wanted = canonical(answer.fetchall(), columns)
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(columns)}"
    if got == wanted:
        return None
    missing, extra = list(set(wanted) - set(got))[:2], list(set(got) - set(wanted))[:2]
    return f"{len(got)} rows instead of {len(wanted)}; {sorted(columns)}\n  missing {missing}\n  extra {extra}"


def main(arguments: list[str]) -> int:
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    entry = importlib.import_module("__spark_entry__")
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in arguments[1:] or oracles:
        begun = time.monotonic()
        try:
            problem = compare(spark, connection, folder, queries[name], oracles[name])
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{name:32s} {time.monotonic() - begun:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{failures} differences")
    return int(failures > 0)


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(sys.argv[1:]))
