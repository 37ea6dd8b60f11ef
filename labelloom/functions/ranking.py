"""Running sums and ranks that survive one huge group."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def running_before(df: DataFrame, group: list[str], bucket: Column, order: list[Column], values: dict[str, Column],
                   once: bool = True) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the rows of the group that come before this row.

    ``bucket`` must grow with the order. Rows are only sorted inside (group, bucket); the bucket totals are
    one small row each and carry the sum over. Group and order columns must not be null. So a group with a third of all rows is spread over its buckets.
    Totals and ranks read the same shuffle of ``df``, so with ``once`` it is computed once: the totals also take a digest of all columns, as
    Spark uses a shuffle twice only if both readers want the same columns.
    """
    keys = [*group, "_bucket"]
    x = df.withColumn("_bucket", bucket)
    digest = []
    if once:
        x = x.repartition(*keys)
        digest = [F.bit_xor(F.xxhash64(*[c.name for c in x.schema.fields if c.dataType.typeName() not in ("map", "variant")])).alias("_digest")]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = x.groupBy(*keys).agg(*[F.sum(v).alias(f"_t_{n}") for n, v in values.items()], *digest)
    carried = (totals.where("_digest is not null") if once else totals).select(*keys, *[F.coalesce(F.sum(f"_t_{n}").over(across), F.lit(0)).alias(f"_b_{n}") for n in values])
    x = x.withColumns({f"_i_{n}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    out = x.join(carried, keys).withColumns({n: F.col(f"_i_{n}") + F.col(f"_b_{n}") for n in values})
    return out.drop("_bucket", *[f"_{p}_{n}" for p in ("i", "b") for n in values])


def global_rank(df: DataFrame, score: str, tie: str, digits: int = 3, name: str = "rank") -> DataFrame:
    """1-based rank by (score descending, tie ascending) without bringing the rows into one task."""
    bucket = -F.floor(F.col(score) * 10 ** digits)
    out = running_before(df, [], bucket, [F.desc(score), F.col(tie)], {name: F.lit(1).cast("long")})
    return out.withColumn(name, F.col(name) + 1)
