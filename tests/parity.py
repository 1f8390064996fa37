"""Spark vs DuckDB parity check for registered queries.

Mirrors the driver's gate: same column names, same row count, same
order-insensitive multiset of values (columns compared in name order), and
compatible column types. Usable from pytest and as a script::

    python tests/parity.py /root/testdata/sf0.01 [name ...] [conf.key=value ...] [--strict]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in STAR_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", format(v.normalize(), "f"))  # scale is compared through the column types
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", str(v))
    if isinstance(v, float):
        return ("num", f"{v:.6f}")
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return ("str", v)


def _kind(type_name: str) -> str:
    t = type_name.lower()
    if t.startswith("decimal"):
        return t.replace(" ", "")
    if t in ("int", "integer", "int32"):
        return "int"
    if t in ("bigint", "long", "int64"):
        return "bigint"
    if t in ("string", "varchar"):
        return "string"
    if t in ("boolean", "bool"):
        return "boolean"
    return t


def spark_result(df):
    cols = df.columns
    kinds = [_kind(f.dataType.simpleString()) for f in df.schema.fields]
    rows = [tuple(r) for r in df.collect()]
    return cols, kinds, rows


def duck_result(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    kinds = [_kind(str(d[1])) for d in cur.description]
    rows = cur.fetchall()
    return cols, kinds, rows


def _canon(cols, kinds, rows, strict: bool = False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    types = [kinds[i] for i in order]
    norm = repr if strict else _norm   # strict: raw Python values, decimal scale included
    bag = Counter(tuple(norm(r[i]) for i in order) for r in rows)
    return names, types, bag


def compare(spark, con, name: str, sf_dir: str, queries, statements, strict: bool = False) -> dict:
    t0 = time.time()
    s_cols, s_kinds, s_rows = spark_result(queries[name](spark, sf_dir))
    t1 = time.time()
    d_cols, d_kinds, d_rows = duck_result(con, statements[name])
    t2 = time.time()
    sn, st, sb = _canon(s_cols, s_kinds, s_rows, strict)
    dn, dt_, db = _canon(d_cols, d_kinds, d_rows, strict)
    out = {
        "name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sn == dn, "types_match": st == dt_, "values_match": sb == db,
        "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2),
    }
    if sn != dn:
        out["columns"] = (sn, dn)
    elif st != dt_:
        out["types"] = [(n, a, b) for n, a, b in zip(sn, st, dt_) if a != b]
    if sb != db and sn == dn:
        out["only_spark"] = list((sb - db).items())[:3]
        out["only_oracle"] = list((db - sb).items())[:3]
    out["ok"] = out["columns_match"] and out["types_match"] and out["values_match"]
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from shelfcost.session import build_session

    strict = "--strict" in argv
    conf = dict(a.split("=", 1) for a in argv if "=" in a)   # e.g. spark.sql.autoBroadcastJoinThreshold=-1
    argv = [a for a in argv if "=" not in a and a != "--strict"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session(extra=conf)
    queries, statements = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(queries):
        try:
            res = compare(spark, con, name, sf_dir, queries, statements, strict)
        except Exception as exc:  # report and continue
            res = {"name": name, "ok": False, "error": repr(exc)[:400]}
        bad += not res["ok"]
        print(res, flush=True)
    print(f"{bad} failing", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
