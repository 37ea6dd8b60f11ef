"""One-row aggregates as scalar subqueries: evaluated once, no join."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def one_row(df: DataFrame) -> Column:
    """The single row of an ungrouped aggregate, as a struct column usable in another DataFrame."""
    return df.select(F.struct("*").alias("row")).scalar()
