"""Run registered queries next to their SQL: ``python tests/compare.py sf0.01 [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def normalise(pdf):
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pdf[c].dtype == object or str(pdf[c].dtype) == "str":
            pdf[c] = pdf[c].map(lambda v: None if v is None or v is pd.NaT or v != v else str(v)[:10] if c in ("day", "price_date", "batch_start", "batch_end", "date_requested") else str(v))
        elif str(pdf[c].dtype).startswith("datetime") and c in ("day", "price_date", "batch_start", "batch_end", "date_requested"):
            pdf[c] = pdf[c].astype(str).str[:10]
        elif str(pdf[c].dtype).startswith("datetime"):
            pdf[c] = pdf[c].astype("datetime64[us]")
        elif pdf[c].dtype != bool:
            pdf[c] = pdf[c].astype(float)
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def compare(spark, con, folder, name):
    start = time.time()
    df = entry.queries()[name](spark, folder)
    got = df.toPandas()
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return took, len(got), "rows only"
    rel = con.sql(sql)
    types = {c: str(k) for c, k in zip(rel.columns, rel.types)}
    want = rel.df()
    notes = []
    if sorted(got.columns) != sorted(want.columns):
        return took, len(got), f"COLUMNS {sorted(set(got.columns) ^ set(want.columns))}"
    for c, k in df.dtypes:
        if KINDS.get(k, k) != types[c]:
            notes.append(f"type {c}: {k} / {types[c]}")
    if len(got) != len(want):
        return took, len(got), f"ROWS {len(got)} / {len(want)} {notes}"
    a, b = normalise(got), normalise(want)
    for c in a.columns:
        x, y = a[c], b[c]
        same = (x == y) | (x.isna() & y.isna())
        if not same.all():
            i = np.flatnonzero(~same)
            notes.append(f"VALUES {c}: {len(i)} differ, {x[i[0]]!r} / {y[i[0]]!r}")
    return took, len(got), "; ".join(notes) or "ok"


if __name__ == "__main__":
    from candela.session import local_session

    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session("8"), connect(folder)
    bad = 0
    for name in names:
        try:
            took, rows, note = compare(spark, con, folder, name)
        except Exception as e:  # report and go on
            took, rows, note = 0, 0, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += note not in ("ok", "rows only")
        print(f"{name:28s} {took:6.2f}s {rows:7d}  {note}", flush=True)
    print("bad:", bad)
