"""Turning computed arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def array_rows(df: DataFrame, keep: list, array: Column | str, pos: str, value: str) -> DataFrame:
    """One row per element with its position; an empty or NULL array gives no row.

    A plain explode lets the optimizer add a filter on the array's size below it, which
    evaluates the array a second time. For arrays that are expensive to compute the outer
    form with a filter on the position behind it evaluates them once.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, value))
    return rows.filter(F.col(pos).isNotNull())
