"""Compare registered queries with their SQL: row count, column names, types of value, values."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, float):
        return f"float:{value!r}"
    if isinstance(value, datetime.date):
        return value.isoformat()
    return "null" if value is None else f"{type(value).__name__}:{value}"


def _table(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda n: names[n])
    return [names[n] for n in order], sorted(tuple(_plain(row[n]) for n in order) for row in rows)


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}


def spark_table(frame):
    types = sorted((name, TYPES[kind]) for name, kind in frame.dtypes)
    return types, *_table(frame.columns, [tuple(row) for row in frame.collect()])


def duck_table(connection, sql: str):
    result = connection.execute(sql)
    types = sorted((column[0], str(column[1])) for column in result.description)
    return types, *_table([column[0] for column in result.description], result.fetchall())


def differences(spark, connection, sf_dir: str, query, sql: str) -> str:
    """Empty when both sides agree, else what differs first."""
    types, _, got = spark_table(query(spark, sf_dir))
    wanted_types, _, wanted = duck_table(connection, sql)
    if types != wanted_types:
        return f"columns {[t for t in types if t not in wanted_types]} != {[t for t in wanted_types if t not in types]}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for left, right in zip(got, wanted):
        if left != right:
            return f"{left} != {right}"
    return ""


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from viewlog.session import build_session

    sf_dir, *chosen = sys.argv[1:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = []
    for name in chosen or queries:
        start = time.time()
        try:
            problem = differences(spark, connection, sf_dir, queries[name], sql[name])
        except Exception as error:  # keep going, report at the end
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.2f}s {problem}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} of {len(chosen or queries)} differ: {bad}")


if __name__ == "__main__":
    main()
