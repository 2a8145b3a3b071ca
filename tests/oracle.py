"""Run registered queries against their DuckDB oracles and compare whole results."""

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(_cell(row[i])) for i in order) for row in rows)


# Spark type -> DuckDB types that hold the same values.
SAME = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"},
}


def compare(frame, connection, sql: str) -> str | None:
    """None if both give the same columns, types and rows; else what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    by_name = dict(zip(names, types))
    for name, kind in frame.dtypes:
        allowed = SAME.get(kind, {kind.upper()})
        if by_name[name] not in allowed:
            return f"type of {name}: {kind} != {by_name[name]}"
    found = [tuple(row) for row in frame.collect()]
    if len(found) != len(expected):
        return f"rows {len(found)} != {len(expected)}"
    mine, theirs = _rows(frame.columns, found), _rows(names, expected)
    for a, b in zip(mine, theirs):
        if a != b:
            return f"first difference: {a} != {b}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tillwork.session import local_session

    spark = local_session()
    connection = connect(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            if name in oracles:
                problem = compare(frame, connection, oracles[name])
                rows = connection.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchall()[0][0]
            else:
                problem, rows = None, frame.count()
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", "-"
        if problem or not rows:
            bad += 1
        print(f"{'FAIL' if problem else 'ok'} {name} rows={rows} {time.time() - start:.1f}s"
              f" {'' if name in oracles else '(no oracle)'} {problem or ''}", flush=True)
    print("bad or empty:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
