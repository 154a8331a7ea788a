"""Order-insensitive comparison of query results (the same rule as the correctness gate:
row count, column names and types, value hash over sorted rows)."""

from __future__ import annotations

import hashlib
import math

import pandas as pd


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def kind(dtype) -> str:
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s or "decimal" in s:
        return "float"
    if "bool" in s:
        return "bool"
    if "datetime" in s or "timestamp" in s:
        return "ts"
    return "str"


def digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False))
    return len(pdf), cols, hashlib.md5("\n".join(rows).encode()).hexdigest()


def kinds(pdf: pd.DataFrame) -> dict[str, str]:
    return {c: kind(pdf[c].dtype) for c in pdf.columns}
