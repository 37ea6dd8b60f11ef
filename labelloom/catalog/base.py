"""Registry of queries and their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if twin is not None:
            ORACLE[name] = twin
        return fn
    return add


def joined(c: str | Column, name: str | None = None) -> Column:
    """Array -> text, so that results compare as plain values."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(col, "|").alias(name or c)


def r6(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6).alias(name or c)


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """Round every double column to 6 digits (outputs only)."""
    return df.select(*[F.round(f"`{f.name}`", 6).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
