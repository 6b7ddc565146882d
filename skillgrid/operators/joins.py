"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate (exactly one row) to every row.

    A global ``agg`` always yields one row, so broadcasting it is bounded by
    construction; the join is an equi-join on a constant key.
    """
    key = "__one_row_key"
    return df.withColumn(key, F.lit(1)).join(
        F.broadcast(one_row.withColumn(key, F.lit(1))), key
    ).drop(key)
