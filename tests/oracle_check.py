"""Compare a query with its reference SQL, type by type and value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
    "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(root: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{root}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, db, root: str, fn, sql: str) -> str:
    """Empty text when they agree, else what differs."""
    df = fn(spark, root)
    got = rows_of(df.columns, df.collect())
    rel = db.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    want = rows_of(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = [
        (c, t, types[c])
        for c, t in df.dtypes
        if SPARK_TYPES.get(t.split(" ")[0], t.upper()) != types[c].replace(" ", "")
    ]
    note = f"types {wrong} " if wrong else ""
    if got != want:
        only = list((got - want).items())[:2]
        other = list((want - got).items())[:2]
        note += f"rows {sum(got.values())} != {sum(want.values())} {sorted(names)} spark-only {only} sql-only {other}"
    return note


def main(root: str, prefixes: list[str]) -> None:
    import __spark_entry__ as entry
    from quipu.session import build_session

    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(root)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            if name in oracles:
                note = compare(spark, db, root, fn, oracles[name])
            else:
                note = "" if fn(spark, root).count() >= 0 else "?"
        except Exception as error:  # report every query, then go on
            note = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(note)
        print(f"{'BAD' if note else 'ok '} {name} {time.time() - start:.2f}s {note[:1500]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
