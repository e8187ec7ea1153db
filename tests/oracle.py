"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py SF [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = os.environ.get("STRATALAKE_DATA", "/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


SPARK_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def _type(name: str) -> str:
    return SPARK_NAMES.get(name, name.upper())


def compare(df, con, sql: str) -> str:
    """Empty text if both sides agree, else what differs."""
    got_cols, got = canonical(df.columns, df.collect())
    rel = con.sql(sql)
    types = {c: _type(t) for c, t in df.dtypes}
    wanted = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    if types != wanted:
        return f"types {sorted(types.items() ^ wanted.items())}"
    want_cols, want = canonical(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    if diff:
        return f"{len(diff)} of {len(got)} rows differ, first: {diff[0]}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from stratalake.session import get_spark

    sf_dir = f"{DATA}/sf{sys.argv[1]}"
    names = sys.argv[2:] or list(queries())
    spark = get_spark("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        t = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            if name in oracle_sql():
                msg = compare(df, con, oracle_sql()[name]) or "ok"
            else:
                msg = f"ok (rows only: {df.count()})"
        except Exception as e:  # report and go on with the next query
            msg = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        bad += not msg.startswith("ok")
        print(f"{name:34s} {time.time() - t:6.2f}s  {msg}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
