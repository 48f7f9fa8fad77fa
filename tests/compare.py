"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.date, pd.Timestamp)):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _cell(v.item())
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_cell(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return sorted(out, key=repr)


def same(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return False, f"columns {sorted(spark_pdf.columns)} != {sorted(oracle_pdf.columns)}"
    a, b = rows(spark_pdf), rows(oracle_pdf)
    if a == b:
        return True, ""
    sa, sb = set(a), set(b)
    return False, (
        f"rows {len(a)} vs {len(b)}; only spark {sorted(sa - sb, key=repr)[:3]}; "
        f"only oracle {sorted(sb - sa, key=repr)[:3]}"
    )
