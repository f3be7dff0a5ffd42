"""Compare ``queries()`` against ``oracle_sql()`` on DuckDB, like the driver does.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

STRICT = os.environ.get("STRICT") == "1"

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402,F401
from revlens.sources.raw import TABLES  # noqa: E402


_DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) >= 10 else v.isoformat()
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 6)
    except Exception:
        pass
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, sf_dir, name):
    q = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, os.environ.get("SPARK_ROOT", sf_dir))
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    st = time.time() - t0
    if sql is None:
        return f"{name}: spark rows={len(srows)} (no oracle) {st:.1f}s"
    duck_types = {r[0]: _DUCK_TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    spark_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
    if spark_types != duck_types:
        problems.append(f"types spark={spark_types} duck={duck_types}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            problems.append(f"{len(bad)} rows differ, first: spark={bad[0][0]} duck={bad[0][1]}")
    status = "OK" if not problems else "FAIL " + "; ".join(problems)
    return f"{name}: {status} rows={len(srows)} {st:.1f}s"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)] or list(entry.queries())
    from revlens.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    fails = 0
    for n in names:
        try:
            line = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and continue
            line = f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        fails += "OK" not in line.split()[1:2]
        print(line, flush=True)
    print(f"failures: {fails}")


if __name__ == "__main__":
    main(sys.argv)
