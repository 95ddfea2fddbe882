"""Compare catalog queries with their SQL in DuckDB: ``python tests/oracle.py <sf_dir> [name prefix ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else repr(number)
    return "null" if value is None else str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, connection, sf_dir, name, fn, sql):
    """Row count, and a message when the results differ."""
    df = fn(spark, sf_dir)
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got[1]), None
    cursor = connection.execute(sql)
    want = _table([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return len(got[1]), f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra, missing = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
        return len(got[1]), (
            f"{len(got[1])} rows != {len(want[1])}; only here {sorted(extra)[:2]}; only in SQL {sorted(missing)[:2]}"
        )
    return len(got[1]), None


def main(sf_dir, prefixes):
    import __spark_entry__ as entry
    from tidegauge.session import get_session

    spark = get_session(
        "oracle", master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql, bad = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            rows, problem = compare(spark, connection, sf_dir, name, fn, sql.get(name))
        except Exception as error:  # noqa: BLE001
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{kind:5}{rows:8} {time.time() - started:6.1f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
