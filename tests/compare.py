"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd


def canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, canon(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[tuple(canon(x) for x in rec)] += 1
    return cols, out


def same(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    sc, sr = rows(spark_pdf)
    dc, dr = rows(duck_pdf)
    if sc != dc:
        return False, f"columns {sc} vs {dc}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows {len(spark_pdf)} vs {len(duck_pdf)}"
    if sr != dr:
        return False, f"values differ: {list((sr - dr).elements())[:2]} vs {list((dr - sr).elements())[:2]}"
    return True, ""
