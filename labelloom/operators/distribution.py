"""Distribution of the similarities of all pairs inside groups, without a row for any pair.

Mean and deviation follow from sums: with s the sum of a group's vectors and M the sum of their outer products, the pairs' similarities add up to (|s|^2 - sum |u|^2) / 2 and their
squares to (|M|^2 - sum |u|^4) / 2. Quantiles are exact for similarities rounded to 9 digits and found by radix selection: a histogram of the leading
digits of all pairs tells in which bins the wanted ranks lie, a second one counts single values in these bins only. Pairs are worked on in tiles of at
most ``tile_rows`` x ``tile_rows``, so a group of any size is many tasks. Only histograms leave a tile.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tiles import DIGITS, matrix

QUANTILES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
#: Values of one bin of the first histogram; a rounded similarity is a whole number of 10^-9.
BIN = 1 << 16


def order_statistics(histogram: Callable[[list[int] | None], DataFrame], quantiles=QUANTILES) -> tuple[int, list[float]]:
    """(n, quantiles with linear interpolation). ``histogram(None)`` has (key, n) by bin, ``histogram(bins)`` by value in these bins; values are whole numbers of 10^-9."""
    first = sorted((r.key, r.n) for r in histogram(None).collect())
    n = sum(c for _, c in first)
    if not n:
        return 0, [None] * len(quantiles)
    ranks = sorted({r for q in quantiles for r in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))})
    ends = np.cumsum([c for _, c in first])
    at = np.searchsorted(ends, ranks, side="right")
    second = sorted((r.key, r.n) for r in histogram(sorted({first[i][0] for i in at})).collect())
    below = {}
    for r, i in zip(ranks, at):
        left = r - (int(ends[i - 1]) if i else 0)
        for value, c in second:
            if value // BIN == first[i][0]:
                if left < c:
                    below[r] = value
                    break
                left -= c
    out = []
    for q in quantiles:
        place = q * (n - 1)
        low, high = below[math.floor(place)], below[math.ceil(place)]
        out.append((low + (high - low) * (place - math.floor(place))) / 10 ** DIGITS)
    return n, out


def column_quantiles(df: DataFrame, column: str, quantiles=QUANTILES) -> tuple[int, list[float]]:
    """(n, exact quantiles) of a column of numbers, rounded to 9 digits; nulls are left out. Two aggregations, however many different values there are."""
    x = df.where(F.col(column).isNotNull()).select(F.round(F.col(column) * 10 ** DIGITS).cast("long").alias("value"))
    bin_of = F.floor(F.col("value") / BIN).cast("long")

    def histogram(bins: list[int] | None) -> DataFrame:
        rows = x.select(bin_of.alias("key")) if bins is None else x.where(bin_of.isin(bins)).select(F.col("value").alias("key"))
        return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))

    return order_statistics(histogram, quantiles)


def _members(vectors: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(g, label, vector); without ``groups`` all are one group."""
    v = vectors.select("label", "vector")
    if groups is None:
        return v.withColumn("g", F.lit(""))
    return v.join(groups.select("label", F.col("occupation").cast("string").alias("g")).distinct(), "label")


def moments(members: DataFrame) -> tuple[int, float, float]:
    """(pairs, sum, sum of squares) of the similarities of pairs inside groups, from sums that tasks hand on for each group they have seen."""
    schema = "g string, part int, n long, s array<double>, m array<double>, q double, r double"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            rows = [(g, 0, n, s.tolist(), m.ravel().tolist(), q, r) for g, (n, s, m, q, r) in held.items()]
            held.clear()
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["g", "part", "n", "s", "m", "q", "r"])

        for batch in batches:
            if not len(batch):
                continue
            u = matrix(pa.table(batch), "vector")
            names, code = np.unique(np.array(batch.column("g").to_pylist(), object), return_inverse=True)
            for i, g in enumerate(names):
                some = u[code == i]
                square = (some ** 2).sum(1)
                now = [len(some), some.sum(0), some.T @ some, float(square.sum()), float((square ** 2).sum())]
                held[g] = [a + b for a, b in zip(held[g], now)] if g in held else now
            if len(held) > 256:
                yield out()
        yield out()

    def add(t: pa.Table) -> pa.Table:
        rows = t.slice(0, 1)
        if len(t) > 1:
            sums = [pa.array([sum(t["n"].to_pylist())]), *[pa.array([np.sum([np.asarray(x.values) for x in t[c]], axis=0)], pa.list_(pa.float64())) for c in ("s", "m")], *[pa.array([sum(t[c].to_pylist())]) for c in ("q", "r")]]
            rows = pa.table([t["g"].slice(0, 1), t["part"].slice(0, 1), *sums], names=t.column_names)
        return rows

    parts = members.select("g", "vector").mapInArrow(partial, schema).withColumn("part", (F.rand(7) * 64).cast("int"))
    sums = parts.groupBy("g", "part").applyInArrow(add, schema).groupBy("g").applyInArrow(add, schema)
    square = (lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    a = sums.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("n"), F.sum((square("s") - F.col("q")) / 2).alias("s1"), F.sum((square("m") - F.col("r")) / 2).alias("s2")).first()
    return int(a.n or 0), float(a.s1 or 0.0), float(a.s2 or 0.0)


def pair_histogram(members: DataFrame, tile_rows: int) -> Callable[[list[int] | None], DataFrame]:
    """Histogram of all pairs inside groups, computed in tiles."""
    pieces = members.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("pieces")).where("pieces > 0")
    own = F.pmod(F.xxhash64("label"), F.col("pieces")).cast("int")
    x = members.join(pieces, "g").withColumn("own", own)
    both = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda p: F.struct(F.least(p, F.col("own")).alias("i"), F.greatest(p, F.col("own")).alias("j")))
    x = x.select("g", "own", "vector", F.explode(both).alias("t")).select("g", "t.i", "t.j", "own", "vector")

    def histogram(bins: list[int] | None) -> DataFrame:
        wanted = None if bins is None else np.array(bins, np.int64)

        def count(t: pa.Table) -> pa.Table:
            u, own, i, j = matrix(t, "vector"), np.asarray(t["own"]), t["i"][0].as_py(), t["j"][0].as_py()
            left, right = (u[own == i], u[own == j])
            keys: dict[int, int] = {}
            step = max(1, (1 << 21) // max(1, len(right)))
            for low in range(0, len(left), step):
                s = np.rint(left[low:low + step] @ right.T * 10 ** DIGITS).astype(np.int64)
                if i == j:
                    s = s[np.arange(low, low + len(s))[:, None] < np.arange(len(right))]
                s = s.ravel()
                if wanted is None:
                    s = s // BIN
                else:
                    s = s[np.isin(s // BIN, wanted)]
                for k, c in zip(*np.unique(s, return_counts=True)):
                    keys[int(k)] = keys.get(int(k), 0) + int(c)
            return pa.table({"key": pa.array(list(keys), pa.int64()), "n": pa.array(list(keys.values()), pa.int64())})

        return x.groupBy("g", "i", "j").applyInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))

    return histogram


def group_similarities(vectors: DataFrame, groups: DataFrame | None = None, tile_rows: int = 2048) -> DataFrame:
    """One row (n, min, max, mean, median, std, p10, p25, p50, p75, p90) over all pairs of labels of a group, a pair for each group that it shares.

    ``vectors``: label, vector (cosine is taken); ``groups``: label, occupation, or none for all pairs of vectors. Without any pair n is 0 and the rest null.
    """
    members = _members(vectors, groups)
    n, s1, s2 = moments(members)
    _, found = order_statistics(pair_histogram(members, tile_rows))
    mean = s1 / n if n else None
    std = math.sqrt(max(0.0, s2 / n - mean * mean)) if n else None
    low, p10, p25, p50, p75, p90, high = found
    schema = "n long, " + ", ".join(f"{c} double" for c in ("min", "max", "mean", "median", "std", "p10", "p25", "p50", "p75", "p90"))
    return vectors.sparkSession.createDataFrame([(n, low, high, mean, p50, std, p10, p25, p50, p75, p90)], schema)
