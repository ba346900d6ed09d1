"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
          "boolean": "BOOLEAN"}


def _type_differences(df, description) -> list[str]:
    duck_types = {d[0]: str(d[1]) for d in description}
    return [f"{c}: {t} / {duck_types.get(c)}" for c, t in df.dtypes if _TYPES.get(t) != duck_types.get(c)]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def differences(spark, con, name: str, run, sql: str, sf_dir: str) -> tuple[str | None, int, float]:
    """(what differs or None, rows, seconds)."""
    began = time.time()
    df = run(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    took = time.time() - began
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = _type_differences(df, cur.description)
    want = _rows(names, cur.fetchall())
    n = sum(got.values())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", n, took
    if got != want:
        return f"rows {n} vs {sum(want.values())}; only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}", n, took
    return (f"types {types}" if types else None), n, took


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidelog.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf), entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            if name in oracles:
                diff, n, took = differences(spark, con, name, run, oracles[name], sf)
            else:
                began = time.time()
                n, diff = run(spark, sf).count(), None
                took = time.time() - began
        except Exception as e:  # report every query
            diff, n, took = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0
        print(f"{'ok ' if diff is None else 'BAD'} {name} rows={n} {took:.2f}s {'' if name in oracles else '(no sql)'} {diff or ''}", flush=True)
        if diff:
            bad.append(name)
    print("bad:", bad)
