"""Run registered queries against their SQL in DuckDB on the same parquet files."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def difference(spark, con, sf: str, run, sql: str) -> str:
    """An empty text if both sides hold the same rows."""
    frame = run(spark, sf)
    rows = con.execute(sql)
    names = [d[0] for d in rows.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    order = sorted(names)
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in rows.fetchall())
    ours = sorted(tuple(plain(v) for v in r) for r in frame.select(*order).collect())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else ""


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from asterline.session import build_session

    spark = build_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    wanted = sys.argv[2:]
    con, bad = connect(sf), 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                text = difference(spark, con, sf, run, oracles[name])
            else:
                text = f"(no SQL) rows {run(spark, sf).count()}"
        except Exception as error:
            text = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(text) and not text.startswith("(no SQL)")
        print(f"{'ok  ' if not text else '--  '}{name} {time.time() - start:.2f}s {text}", flush=True)
    print("bad:", bad)
