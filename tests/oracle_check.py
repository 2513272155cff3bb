"""Run registered queries against their DuckDB oracle (row count + column names + order-insensitive value hash).

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return None
    try:
        if not isinstance(v, (list, tuple, bytes, bytearray)) and pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def frame_digest(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(json.dumps([_norm(x) for x in rec], default=str, sort_keys=True))
    rows.sort()
    return cols, len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest(), rows


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from eventspark.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    ok = True
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:800]}")
            ok = False
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(spdf)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            opdf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:800]}")
            ok = False
            continue
        c1, n1, h1, r1 = frame_digest(spdf)
        c2, n2, h2, r2 = frame_digest(opdf)
        def kind(pdf, c):
            t = str(pdf[c].dtype).replace("[ns]", "[us]")
            return "int64" if t in ("Int64", "float64") and pdf[c].isna().any() else t
        d1 = {c: kind(spdf, c) for c in c1}
        d2 = {c: kind(opdf, c) for c in c2}
        if (c1, n1, h1) == (c2, n2, h2):
            if d1 != d2:
                ok = False
                print(f"TYPE {name}: {n1} rows; dtypes {d1} vs {d2}")
            else:
                print(f"OK   {name}: {n1} rows ({ts:.1f}s)")
        else:
            ok = False
            print(f"FAIL {name}: cols {c1} vs {c2}; rows {n1} vs {n2}")
            s1, s2 = set(r1), set(r2)
            print("  spark-only:", sorted(s1 - s2)[:3])
            print("  oracle-only:", sorted(s2 - s1)[:3])
    spark.stop()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
