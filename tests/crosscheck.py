"""Run registered queries against their SQL in DuckDB: python tests/crosscheck.py [sf] [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def compare(df, con, sql):
    """Empty string when equal, else what differs."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    left = normal(df.columns, [tuple(r) for r in df.collect()])
    right = normal(rel.columns, rel.fetchall())
    if left[0] != right[0]:
        return f"columns {set(left[0]) ^ set(right[0])}"
    if ours != theirs:
        return f"types {[(k, ours[k], theirs[k]) for k in ours if ours[k] != theirs[k]]}"
    if left[1] != right[1]:
        a, b = set(left[1]), set(right[1])
        return (f"rows {len(left[1])} vs {len(right[1])}, only ours {len(a - b)}, only theirs {len(b - a)}\n"
                f"    {left[0]}\n    ours   {sorted(a - b)[:2]}\n    theirs {sorted(b - a)[:2]}")
    return "" if left[1] else "both empty"


def main():
    from __spark_entry__ import oracle_sql, queries
    from forumlens.session import build_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                 "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(sf_dir)
    bad = []
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = oracle_sql().get(name)
            note = compare(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            note = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:36s} {time.time() - start:6.2f}s {note or 'ok'}", flush=True)
        if note and not note.startswith("rows only"):
            bad.append(name)
    print("different:", bad)


if __name__ == "__main__":
    main()
