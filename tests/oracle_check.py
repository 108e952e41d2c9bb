"""Run catalog queries and their DuckDB oracle side by side and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    sys.path.insert(0, ".")
    import __spark_entry__ as e

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, oracle = e.queries(), e.oracle_sql()
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as ex:  # noqa: BLE001
            out[name] = f"SPARK ERROR {type(ex).__name__}: {str(ex)[:300]}"
            print(name, out[name], flush=True)
            continue
        t1 = time.time()
        if name not in oracle:
            out[name] = f"rows-only {len(spdf)}"
            print(name, out[name], f"{t1 - t0:.1f}s", flush=True)
            continue
        try:
            opdf = con.execute(oracle[name]).df()
        except Exception as ex:  # noqa: BLE001
            out[name] = f"SQL ERROR {str(ex)[:300]}"
            print(name, out[name], flush=True)
            continue
        if sorted(spdf.columns) != sorted(opdf.columns):
            out[name] = f"COLUMNS {sorted(spdf.columns)} vs {sorted(opdf.columns)}"
        elif len(spdf) != len(opdf):
            out[name] = f"ROWCOUNT {len(spdf)} vs {len(opdf)}"
        else:
            a, b = canon(spdf), canon(opdf)
            bad = [(x, y) for x, y in zip(a, b) if x != y]
            out[name] = "OK" if not bad else f"VALUES {len(bad)} differ, e.g. {bad[0]}"
        print(name, out[name], f"rows={len(spdf)} {t1 - t0:.1f}s", flush=True)
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from wickworks.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = compare(local_session(), sf, sys.argv[2:] or None)
    print({k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")})
