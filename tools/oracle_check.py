"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

usage: python tools/oracle_check.py [sf_dir] [name ...]

Compares row count, column names, coarse column types and the multiset
of rows (columns sorted by name; floats compared after rounding to 6
significant decimals).  Prints one line per query and a summary.
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from riskframe.plans import catalog  # noqa: E402
from riskframe.plans.inputs import TABLES  # noqa: E402
from riskframe.session import local_session  # noqa: E402


def kind(dtype) -> str:
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s:
        return "float"
    if "bool" in s:
        return "bool"
    if "datetime" in s or "timestamp" in s:
        return "ts"
    return "obj"


def norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = [tuple(norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(os.environ.get("ORACLE_CPUS", "8"))
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, oracles = catalog.queries(), catalog.oracle_sql()
    ok = bad = rows_only = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # report and continue
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracles:
            print(f"ROWS  {name}: {len(sdf)} rows ({ts:.1f}s)")
            rows_only += 1
            continue
        try:
            odf = con.execute(oracles[name]).df()
        except Exception as e:
            print(f"FAIL  {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        problems = []
        if sorted(sdf.columns) != sorted(odf.columns):
            problems.append(f"columns {sorted(sdf.columns)} vs {sorted(odf.columns)}")
        else:
            ks = {c: kind(sdf[c].dtype) for c in sdf.columns}
            ko = {c: kind(odf[c].dtype) for c in odf.columns}
            diff = {c: (ks[c], ko[c]) for c in ks if ks[c] != ko[c]}
            if diff:
                problems.append(f"types {diff}")
            if len(sdf) != len(odf):
                problems.append(f"rows {len(sdf)} vs {len(odf)}")
            else:
                a, b = rows(sdf), rows(odf)
                if a != b:
                    nd = sum(1 for x, y in zip(a, b) if x != y)
                    first = next((x, y) for x, y in zip(a, b) if x != y)
                    problems.append(f"{nd} differing rows, e.g. {first[0]} vs {first[1]}")
        if problems:
            print(f"FAIL  {name}: " + "; ".join(problems))
            bad += 1
        else:
            print(f"OK    {name}: {len(sdf)} rows ({ts:.1f}s)")
            ok += 1
    print(f"summary: ok={ok} fail={bad} rows_only={rows_only}")


if __name__ == "__main__":
    main()
