"""Connected components of a graph given as rows (a, b), by alternating stars; every row moves by joins and partial aggregates."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labelloom.session import cut_lineage

#: Nodes that the union-find of one task holds before it hands on what it has and begins anew.
HELD = 1_000_000


def forest(links: DataFrame) -> DataFrame:
    """Narrow: rows (a, b) of the same components, at most one for each node that a task has seen: (node, smallest of its tree)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent.get(x, top)
            return top

        def out() -> pa.RecordBatch:
            rows = [(x, root(x)) for x in list(parent)]
            rows = [r for r in rows if r[0] != r[1]]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > HELD:
                yield out()
                parent.clear()
        yield out()

    return links.mapInArrow(run, "a long, b long")


def _stars(edges: DataFrame) -> DataFrame:
    """One large star and one small star. Edges are (a, b) with b < a."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low.withColumnRenamed("a", "k"), F.col("a") == F.col("k"))
    return small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node that has a link, and the smallest node it reaches (itself for the root). Runs a job for each round.

    The number of rounds grows with the logarithm of the longest path; each round is kept in the folder of ``spark.checkpoint.dir``.
    """
    def kept(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = cut_lineage(df)
        return df, tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges, state = kept(forest(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")))
    while True:
        edges, now = kept(_stars(edges))
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
