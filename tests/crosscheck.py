"""Run registered queries beside their SQL twins and compare whole results.

    python tests/crosscheck.py [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _text(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    names = sorted(df.columns)
    got = sorted(tuple(_text(row[n]) for n in names) for row in df.collect())
    res = con.sql(sql)
    if sorted(res.columns) != names:
        return f"columns {names} != {sorted(res.columns)}"
    kinds = dict(zip(res.columns, [str(t) for t in res.types]))
    for n, t in df.dtypes:
        if TYPES.get(kinds[n], kinds[n]) != t:
            return f"type of {n}: spark {t}, sql {kinds[n]}"
    order = [res.columns.index(n) for n in names]
    want = sorted(tuple(_text(row[k]) for k in order) for row in res.fetchall())
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {names}: {bad[0][0]} != {bad[0][1]}" if bad else None


def main() -> int:
    from isopleth.plans import catalog
    from isopleth.session import local_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = 0
    for name in args.names or list(catalog.QUERIES):
        t0 = time.time()
        try:
            df = catalog.QUERIES[name](spark, args.sf)
            if name in catalog.ORACLES:
                why = compare(df, con, catalog.ORACLES[name])
                note = "ok" if why is None else f"FAIL {why}"
            else:
                note = f"ok (rows only: {df.count()})"
        except Exception as exc:  # noqa: BLE001
            note = f"FAIL {type(exc).__name__}: {str(exc)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += note.startswith("FAIL")
        print(f"{name:28s} {time.time() - t0:6.2f}s  {note}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
