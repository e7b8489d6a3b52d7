"""Run a named query on Spark and its SQL on DuckDB and compare the row multisets."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from tesela.sources.files import TABLES

KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "array<double>": "DOUBLE[]", "array<string>": "VARCHAR[]", "array<int>": "INTEGER[]",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}") + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def check(spark, con, folder, name, queries, oracles) -> list[str]:
    t0 = time.time()
    df = queries[name](spark, folder)
    ours = [tuple(r) for r in df.collect()]
    t1 = time.time() - t0
    problems = []
    if name in oracles:
        cur = con.execute(oracles[name])
        names = [d[0] for d in cur.description]
        theirs = cur.fetchall()
        types = dict(zip(names, [str(d[1]) for d in cur.description]))
        if sorted(df.columns) != sorted(names):
            problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
        else:
            for f in df.schema.fields:
                want = KIND.get(f.dataType.simpleString(), "?")
                if want != types[f.name]:
                    problems.append(f"type of {f.name}: {f.dataType.simpleString()} vs {types[f.name]}")
            a, b = rows_of(df.columns, ours), rows_of(names, theirs)
            if a != b:
                problems.append(f"{sum((a - b).values())} of {len(ours)} rows differ from {len(theirs)}")
                problems += [f"  ours   {r}" for r in list((a - b).elements())[:3]]
                problems += [f"  theirs {r}" for r in list((b - a).elements())[:3]]
    elif not ours:
        problems.append("no rows")
    print(f"{'FAIL' if problems else 'ok  '} {name:26s} {len(ours):7d} rows {t1:6.2f}s", flush=True)
    for p in problems:
        print("     ", p[:1000], flush=True)
    return problems


if __name__ == "__main__":
    import __spark_entry__ as e
    from tesela.session import build_session

    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    con = duck(folder)
    names = sys.argv[2:] or list(e.queries())
    bad = []
    for n in names:
        try:
            if check(spark, con, folder, n, e.queries(), e.oracle_sql()):
                bad.append(n)
        except Exception as x:  # noqa: BLE001
            print("ERROR", n, type(x).__name__, str(x)[:1500], flush=True)
            bad.append(n)
    print("bad:", bad)
