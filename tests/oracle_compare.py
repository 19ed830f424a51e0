"""Run queries() against oracle_sql() on one scale factor and compare.

Rows are compared as multisets with columns sorted by name, like the
driver's check. Usable from tests and from the command line:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import sys
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    return v


def _rows(cols: list[str], rows) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        rec = {"spark_rows": len(s_rows)}
        if name in sqls:
            res = con.execute(sqls[name])
            o_cols = [d[0] for d in res.description]
            o_rows = res.fetchall()
            rec["oracle_rows"] = len(o_rows)
            rec["columns_match"] = sorted(s_cols) == sorted(o_cols)
            a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
            rec["values_match"] = rec["columns_match"] and a == b
            if not rec["values_match"]:
                rec["spark_only"] = list((a - b).items())[:3]
                rec["oracle_only"] = list((b - a).items())[:3]
                rec["spark_cols"], rec["oracle_cols"] = s_cols, o_cols
        out[name] = rec
    return out


if __name__ == "__main__":
    from accesslake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = 0
    for k, v in res.items():
        ok = v.get("values_match", True)
        bad += not ok
        print(("OK  " if ok else "BAD ") + k, {x: y for x, y in v.items() if x != "values_match"})
    print("mismatches:", bad)
