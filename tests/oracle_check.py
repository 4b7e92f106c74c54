"""Run registered queries against DuckDB on the same tables and compare values, order-insensitively.

    python tests/oracle_check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canon(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, sf_dir, run, sql):
    """None when equal, else a description of the first difference."""
    df = run(spark, sf_dir)
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if sr else "no rows"
    cur = con.execute(sql)
    dc, dr = rows_of([d[0] for d in cur.description], cur.fetchall())
    if sc != dc:
        return f"columns {sc} vs {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} vs {len(dr)}; first only here: {next((r for r in sr if r not in set(dr)), None)!r:.300} first only there: {next((r for r in dr if r not in set(sr)), None)!r:.300}"
    if not sr:
        return "no rows"
    for a, b in zip(sr, dr):
        for n, x, y in zip(sc, a, b):
            if x != y or (isinstance(x, bool) != isinstance(y, bool)) or (
                isinstance(x, float) != isinstance(y, float)
            ):
                return f"{n}: {x!r:.200} vs {y!r:.200} in {a!r:.300}"
    return None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from mailsieve.session import build_session

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    names = [n for n in queries() if not argv or any(n.startswith(a) for a in argv)]
    spark = build_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls, bad = oracle_sql(), 0
    for n in names:
        t = time.time()
        try:
            msg = compare(spark, con, sf, queries()[n], sqls.get(n))
        except Exception as e:  # noqa: BLE001 - report and go on
            msg = f"{type(e).__name__}: {str(e)[:700]}"
        bad += msg is not None
        print(f"{'ok  ' if msg is None else 'FAIL'} {time.time() - t:6.2f}s {'' if n in sqls else '(rows only) '}{n} {msg or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
