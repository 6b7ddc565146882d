"""Compare a Spark query with its DuckDB oracle (rows, columns, values).

Used by the tests and ``scripts/check_oracle.py``. Values are compared
order-insensitively after normalising types (timestamps, arrays, structs,
floats to 12 significant digits).
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd

from skillgrid.sources.tables import DRIVER_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.execute(
            f"create view {name} as select * from read_parquet('{sf_dir.rstrip('/')}/{name}.parquet')"
        )
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float | np.floating):
        f = float(v)
        if math.isnan(f):
            return None
        f = float(f"{f:.12g}")
        return int(f) if f.is_integer() and abs(f) < 1e15 else f  # a nullable integer column may arrive as floats
    if isinstance(v, np.integer | int) and not isinstance(v, bool):
        return int(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(_norm(x) for x in v)
    if v is pd.NaT:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def rows_of(pdf: pd.DataFrame) -> Counter:
    cols = sorted(pdf.columns)
    out: Counter = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[repr(tuple(_norm(v) for v in rec))] += 1
    return out


@dataclass
class Comparison:
    name: str
    spark_rows: int
    oracle_rows: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.columns_match and self.values_match and self.spark_rows == self.oracle_rows


def compare(name: str, spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> Comparison:
    cols_ok = sorted(spark_pdf.columns) == sorted(oracle_pdf.columns)
    detail = ""
    if not cols_ok:
        detail = f"columns spark={sorted(spark_pdf.columns)} oracle={sorted(oracle_pdf.columns)}"
        return Comparison(name, len(spark_pdf), len(oracle_pdf), False, False, detail)
    a, b = rows_of(spark_pdf), rows_of(oracle_pdf)
    same = a == b
    if not same:
        only_a = list((a - b).elements())[:3]
        only_b = list((b - a).elements())[:3]
        detail = f"spark-only={only_a} oracle-only={only_b}"
    return Comparison(name, len(spark_pdf), len(oracle_pdf), True, same, detail)
