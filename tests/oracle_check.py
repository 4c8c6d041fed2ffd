"""Run registered queries against their DuckDB oracles (order-insensitive).

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (datetime.datetime, datetime.date, pd.Timestamp)):
        return pd.Timestamp(v).isoformat(sep=" ", timespec="microseconds")
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and not isinstance(v, str)):
        return tuple(_norm(x) for x in (v.tolist() if hasattr(v, "tolist") else v))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "isoformat") and not isinstance(v, str):
        return str(v)[:19]
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) if not isinstance(
        x, tuple) else (False, "t", str(x)) for x in r))


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return abs(a - b) <= 1e-6 * max(1.0, abs(a), abs(b))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    return str(a) == str(b) if not (isinstance(a, str) and isinstance(b, str)) else a == b


#: Kinds of types of which a column has the same on both sides.
KINDS = {"number": ("int", "long", "short", "byte", "bigint", "smallint", "tinyint", "hugeint", "double", "float", "decimal",
                    "real", "ubigint", "uinteger"),
         "text": ("string", "varchar"), "truth": ("bool",), "time": ("timestamp", "date"), "list": ("array",),
         "bytes": ("binary", "blob")}


def kind_of(type_name: str) -> str:
    name = str(type_name).lower()
    if name.endswith("[]"):
        return "list"
    return next((k for k, names in KINDS.items() if any(name.startswith(n) for n in names)), name)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    spark_kinds = {f.name: kind_of(f.dataType.simpleString()) for f in df.schema}
    sp = df.toPandas()
    t1 = time.time()
    got = con.execute(sql)
    duck_kinds = {d[0]: kind_of(d[1]) for d in got.description}
    dk = got.df()
    t2 = time.time()
    res = {"name": name, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
           "rows": (len(sp), len(dk))}
    if sorted(sp.columns) != sorted(dk.columns):
        res["ok"] = False
        res["why"] = f"columns {sorted(sp.columns)} vs {sorted(dk.columns)}"
        return res
    other = {c: (k, duck_kinds[c]) for c, k in spark_kinds.items() if k != duck_kinds[c]}
    if other:
        res["ok"] = False
        res["why"] = f"types {other}"
        return res
    if len(sp) != len(dk):
        res["ok"] = False
        res["why"] = "row count"
        return res
    _, a = _rows(sp)
    _, b = _rows(dk)
    bad = [(x, y) for x, y in zip(a, b) if not all(_close(p, q) for p, q in zip(x, y))]
    res["ok"] = not bad
    if bad:
        res["why"] = f"{len(bad)} rows differ, e.g. {bad[0]}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    prefixes = argv[2:]
    from tessera.session import get_spark
    from tessera.plans import catalog
    spark = get_spark("local[4]", 8)
    qs = catalog.queries()
    sqls = catalog.oracle_sql()
    con = duck(sf_dir)
    fails = 0
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name}: {n} rows ({time.time() - t0:.1f}s)", flush=True)
            continue
        try:
            r = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        fails += not r["ok"]
        print(("OK    " if r["ok"] else "FAIL  ") + str(r), flush=True)
    print(f"failures: {fails}")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
