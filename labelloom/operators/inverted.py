"""Inverted file over vectors: k-means cells, members by cell, and a search that stops where a bound says so.

For a member x of the cell of centroid c, q.x <= q.c + |q| * max|x - c| (the triangle inequality, as a bound on the product). So once a query has k
results, a cell whose bound is below the k-th score cannot change them. The exact search probes the most promising cells of each query first and
then exactly those others that the bound does not exclude: two rounds, each an equi-join by bundle of cells. The approximate search stops after the first, with a number of
cells that is measured to reach a wanted recall.

Centroids are fitted on a bounded sample; every row is indexed. They and one radius a cell are all that is broadcast (``cells`` x dimension numbers). Neighbouring
cells travel as one bundle of at most ``tile_rows`` members, and a query is sent once to a bundle, with a bit for each of its cells, and brings back k rows at most: what is
shuffled falls with the number of bundles, not of cells. A crowded cell is cut into pieces of ``tile_rows`` members, so no cell is a task of its own size.

Null vectors are not indexed and not searched; zero vectors have score 0 with everything. Equal ids are rows of their own. An empty corpus or no queries give no rows.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import hash_order
from ..session import cut_lineage
from .similarity import _type, first_k, topk_similar
from .tiles import CHUNK_CELLS, MOST_PARTITIONS, TILE_BYTES, TILE_ROWS, best_rounded, matrix

#: Most cells, and rows for each cell that centroids are fitted on.
MOST_CELLS, FIT_ROWS = 4096, 64
#: Queries whose cells are chosen at once.
ASK_ROWS = 1024
#: Scores are rounded to 9 digits, so a bound may be off by as much.
SLACK = 2e-9
#: Standard errors by which a recall measured on drawn queries must exceed the wanted one.
MARGIN = 3


def _nearest(m: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(m @ centroids.T - (centroids ** 2).sum(1) / 2, axis=1)


def _vectors(rows, normalise: bool) -> np.ndarray:
    return matrix(pa.table({"vector": rows}), "vector", normalise)


def fit(sample: DataFrame, centroids: np.ndarray, steps: int, normalise: bool) -> np.ndarray:
    """Lloyd steps: each task adds up its vectors by cell, the sums of tasks are added by cell. A cell that has lost its vectors keeps its centroid."""
    for _ in range(steps):
        def partial(batches: Iterator[pa.RecordBatch], centroids=centroids) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
            for batch in batches:
                if len(batch):
                    m = _vectors(batch.column("vector"), normalise)
                    cell = _nearest(m, centroids)
                    np.add.at(total, cell, m)
                    count += np.bincount(cell, minlength=len(centroids))
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(some), "n": pa.array(count[some]), "total": pa.array(list(total[some]), pa.list_(pa.float64()))})

        def add(t: pa.Table) -> pa.Table:
            return pa.table({"cell": t["cell"][:1], "n": pa.array([sum(t["n"].to_pylist())]), "total": pa.array([np.sum(t["total"].to_pylist(), axis=0)], pa.list_(pa.float64()))})

        schema = "cell long, n long, total array<double>"
        rows = sample.mapInArrow(partial, schema).groupBy("cell").applyInArrow(add, schema).collect()  # at most one row a cell
        centroids = centroids.copy()
        for r in rows:
            centroids[r["cell"]] = np.array(r["total"]) / r["n"]
    return centroids


def bundles(sizes: np.ndarray, tile_rows: int) -> list[tuple[int, int, int]]:
    """(first cell, cell after the last, pieces) of bundles of at most ``tile_rows`` members; a larger cell is a bundle in pieces."""
    out, low, held = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held + n > tile_rows and i > low:
            out.append((low, i, 1))
            low, held = i, 0
        if n > tile_rows:
            out.append((i, i + 1, -(-n // tile_rows)))
            low = i + 1
        else:
            held += n
    return out + [(low, len(sizes), 1)] if low < len(sizes) else out


def bundle_kernel(k: int, normalise: bool, exclude_same: bool):
    """Kernel of (query_id, vector, asked: bits of the bundle's cells) and (corpus_id, vector, at: place of the cell): k rows at most for each query, from the cells it asks for."""
    def kernel(l: pa.Table, r: pa.Table) -> pa.Table:
        out_q, out_c, out_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if len(l) and len(r):
            r = r.sort_by("corpus_id")
            at = r["at"].to_numpy()
            by_cell = np.argsort(at, kind="stable")
            cells, first = np.unique(at[by_cell], return_index=True)
            ends = np.append(first[1:], len(r))
            q, c = matrix(l, "vector", normalise), matrix(r, "vector", normalise)[by_cell]
            asked = np.unpackbits(np.array([np.frombuffer(x, np.uint8) for x in l["asked"].to_pylist()]), axis=1)[:, cells].astype(bool)
            rows_by = np.argsort(asked.argmax(axis=1), kind="stable")  # queries that ask for like cells stand together
            own: dict = {}
            for i, x in enumerate(r["corpus_id"].take(pa.array(by_cell)).to_pylist() if exclude_same else []):
                own.setdefault(x, []).append(i)
            ids = l["query_id"].to_pylist() if exclude_same else []
            step = max(1, CHUNK_CELLS // len(r))
            for low in range(0, len(l), step):
                rows = rows_by[low:low + step]
                wanted = asked[rows]
                some = np.flatnonzero(wanted.any(axis=0))
                if not len(some):
                    continue
                held = np.concatenate([np.arange(first[j], ends[j]) for j in some])
                if wanted.all():
                    s = q[rows] @ c.T
                else:
                    s, begin = np.full((len(rows), len(held)), -np.inf), 0
                    for j in some:
                        mine, end = np.flatnonzero(wanted[:, j]), begin + ends[j] - first[j]
                        s[mine, begin:end] = q[rows[mine]] @ c[first[j]:ends[j]].T
                        begin = end
                if exclude_same:
                    place = np.full(len(r), -1)
                    place[held] = np.arange(len(held))
                    for i, row in enumerate(rows.tolist()):
                        if ids[row] in own:
                            mine = place[own[ids[row]]]
                            s[i, mine[mine >= 0]] = -np.inf
                a, b, score = best_rounded(s, k, by_cell[held])
                out_q.append(rows[a]), out_c.append(by_cell[held[b]]), out_s.append(score)
        return pa.table({"query_id": l["query_id"].take(pa.array(np.concatenate(out_q))), "corpus_id": r["corpus_id"].take(pa.array(np.concatenate(out_c))),
                         "score": pa.array(np.concatenate(out_s))})

    return kernel


class Cells:
    """Centroids, sizes and radii, and which of them a query visits. This is all that tasks need of an index."""

    def __init__(self, centroids: np.ndarray, sizes: np.ndarray, reach: np.ndarray):
        self.centroids, self.sizes, self.reach = centroids, sizes, reach

    def __len__(self) -> int:
        return len(self.sizes)

    def order(self, q: np.ndarray) -> np.ndarray:
        """Cells of each query, the most promising first; empty ones last."""
        return np.argsort(np.where(self.sizes > 0, -(q @ self.centroids.T), np.inf), axis=1, kind="stable")

    def visits(self, q: np.ndarray, limit: np.ndarray | None, probes: int) -> np.ndarray:
        """Whether a query (row) visits a cell (column). Without ``limit`` the first ``probes`` cells; with it those others whose bound reaches the limit."""
        taken = np.zeros((len(q), len(self)), bool)
        if not self.sizes.any():
            return taken
        np.put_along_axis(taken, self.order(q)[:, :probes], True, axis=1)
        if limit is not None:
            bound = q @ self.centroids.T + np.linalg.norm(q, axis=1, keepdims=True) * self.reach
            taken = ~taken & (bound + SLACK >= limit[:, None])
        return taken & (self.sizes > 0)


class InvertedFile:
    """Index of ``corpus`` (id column and ``vector``). Members are kept, with their cell, in the folder of ``spark.checkpoint.dir``."""

    def __init__(self, corpus: DataFrame, corpus_id: str = "corpus_id", cells: int | None = None, steps: int = 5, normalise: bool = True, seed: int = 42, tile_rows: int = TILE_ROWS):
        rows = corpus.select(F.col(corpus_id).alias("corpus_id"), "vector").where("vector is not null")
        self.normalise = normalise
        n = rows.count()
        wanted = min(MOST_CELLS, cells or max(1, math.isqrt(n)))
        sample = cut_lineage(rows.orderBy(hash_order(seed, F.col("corpus_id")), "corpus_id").limit(wanted * FIT_ROWS).select("vector"))
        first = sample.limit(wanted).toArrow()
        start = np.unique(matrix(first, "vector", normalise), axis=0) if len(first) else np.zeros((1, 1))
        centroids = fit(sample, start, steps, normalise)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    m = _vectors(batch.column("vector"), normalise)
                    cell = _nearest(m, centroids)
                    far = np.linalg.norm(m - centroids[cell], axis=1)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["corpus_id", "vector", "cell", "far"])

        kind = f"corpus_id {_type(rows, 'corpus_id')}, vector {_type(rows, 'vector')}, cell long, far double"
        self.members = cut_lineage(rows.mapInArrow(assign, kind))
        held = {r["cell"]: (r["n"], r["far"]) for r in self.members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
        sizes, reach = (np.array([held.get(i, (0, 0.0))[j] for i in range(len(centroids))]) for j in (0, 1))
        self.cells = Cells(centroids, sizes, reach)
        self.tile_rows = max(1, min(tile_rows, TILE_BYTES // (8 * centroids.shape[1])))
        self.bundles = bundles(sizes, self.tile_rows)

    def _probes(self, probes: int | None) -> int:
        return min(len(self.cells), probes or max(1, math.isqrt(len(self.cells))))

    def _search(self, queries: DataFrame, k: int, exclude_same: bool, probes: int) -> DataFrame:
        """Local results of one round. ``queries``: query_id, vector and, in the second round, limit."""
        normalise, tile_rows = self.normalise, self.tile_rows
        second = "limit" in queries.columns
        cells = self.cells

        groups = self.bundles

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
            for batch in batches:
                for low in range(0, len(batch), ASK_ROWS):
                    part = batch.slice(low, ASK_ROWS)
                    yield part, cells.visits(_vectors(part.column("vector"), normalise), part.column("limit").to_numpy() if second else None, probes)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(len(groups), np.int64)
            for _, wanted in asked(batches):
                n += [int(wanted[:, low:high].any(axis=1).sum()) for low, high, _ in groups]
            yield pa.RecordBatch.from_pydict({"bundle": pa.array(range(len(n)), pa.int32()), "n": pa.array(n)})

        visits = {r[0]: r[1] for r in queries.mapInArrow(count, "bundle int, n long").groupBy("bundle").agg(F.sum("n")).collect()}  # a row a bundle
        n_rows = [max(1, -(-visits.get(i, 0) // tile_rows)) for i in range(len(groups))]
        pairs = sum(n * pieces for n, (_, _, pieces) in zip(n_rows, groups))
        spread = -(-queries.sparkSession.sparkContext.defaultParallelism // pairs)  # enough pairs for the cores
        n_rows = [n * max(1, min(spread, -(-visits.get(i, 0) // 256))) for i, n in enumerate(n_rows)]
        pairs = sum(n * pieces for n, (_, _, pieces) in zip(n_rows, groups))

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, wanted in asked(batches):
                for i, (low, high, _) in enumerate(groups):
                    if len(rows := np.flatnonzero(wanted[:, low:high].any(axis=1))):
                        bits = [x.tobytes() for x in np.packbits(wanted[rows, low:high], axis=1)]
                        yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(rows)) for c in ("query_id", "vector")] + [pa.array([i] * len(rows), pa.int32()), pa.array(bits, pa.binary())],
                                                         names=["query_id", "vector", "bundle", "asked"])

        # at most a row a cell
        table = F.broadcast(queries.sparkSession.createDataFrame([(low + j, i, j, n, pieces) for i, ((low, high, pieces), n) in enumerate(zip(groups, n_rows)) for j in range(high - low)],
                                                                 "cell long, bundle int, at int, _own int, _other int"))
        keys = ["bundle", "_r", "_c"]
        sent = queries.mapInArrow(send, f"query_id {_type(queries, 'query_id')}, vector {_type(queries, 'vector')}, bundle int, asked binary")
        left = (sent.join(table.where("at = 0").drop("cell", "at"), "bundle").withColumn("_r", F.pmod(F.xxhash64("query_id"), "_own").cast("int"))
                .withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_other") - 1))).select(*keys, "query_id", "vector", "asked"))
        right = (self.members.select("corpus_id", "vector", "cell").join(table, "cell").withColumn("_c", F.pmod(F.xxhash64("corpus_id"), "_other").cast("int"))
                 .withColumn("_r", F.explode(F.sequence(F.lit(0), F.col("_own") - 1))).select(*keys, "corpus_id", "vector", "at"))
        left, right = (x.repartition(min(pairs, MOST_PARTITIONS), *keys) for x in (left, right))
        kernel = bundle_kernel(k, normalise, exclude_same)

        def one(l: pa.Table, r: pa.Table) -> pa.Table:
            return kernel(l.drop_columns(keys), r.drop_columns(keys))

        schema = f"query_id {_type(queries, 'query_id')}, corpus_id {_type(self.members, 'corpus_id')}, score double"
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(one, schema)

    def topk(self, queries: DataFrame, k: int = 30, exclude_same: bool = False, query_id: str = "query_id", probes: int | None = None, exact: bool = True) -> DataFrame:
        """(query_id, corpus_id, score, rank) as ``similarity.topk_similar`` gives it; if not ``exact``, from the first ``probes`` cells only (see ``probes_for``)."""
        q = queries.select(F.col(query_id).alias("query_id"), "vector").where("vector is not null")
        probes = self._probes(probes)
        early = first_k(self._search(q, k, exclude_same, probes), k)
        if not exact:
            return early
        early = cut_lineage(early)
        late = self._search(self.limits(q, early, k), k, exclude_same, probes)
        return first_k(early.drop("rank").unionByName(late), k)

    def limits(self, queries: DataFrame, early: DataFrame, k: int) -> DataFrame:
        """Queries with their k-th score so far; without k results there is no limit."""
        full = early.where(F.col("rank") == k).select("query_id", F.col("score").alias("limit"))
        return queries.join(full, "query_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("-inf"))))

    def visited(self, queries: DataFrame, k: int, exclude_same: bool = False, query_id: str = "query_id", probes: int | None = None) -> DataFrame:
        """(query_id, cells, rows, share): cells and members that the exact search compares with each query, and their share of the corpus."""
        q = queries.select(F.col(query_id).alias("query_id"), "vector").where("vector is not null")
        probes = self._probes(probes)
        limited = self.limits(q, first_k(self._search(q, k, exclude_same, probes), k), k)
        table, normalise = self.cells, self.normalise

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    m = _vectors(batch.column("vector"), normalise)
                    cells, rows = np.zeros(len(m), np.int64), np.zeros(len(m), np.int64)
                    for limit in (None, batch.column("limit").to_numpy()):
                        r, c = np.nonzero(table.visits(m, limit, probes))
                        cells += np.bincount(r, minlength=len(m))
                        rows += np.bincount(r, weights=table.sizes[c], minlength=len(m)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(cells), pa.array(rows)], names=["query_id", "cells", "rows"])

        out = limited.mapInArrow(count, f"query_id {_type(q, 'query_id')}, cells long, rows long")
        return out.withColumn("share", F.col("rows") / F.lit(max(1, int(self.cells.sizes.sum()))))

    def probes_for(self, queries: DataFrame, k: int = 30, recall: float = 0.9, check: int = 200, exclude_same: bool = False, query_id: str = "query_id", seed: int = 42) -> tuple[int, float]:
        """(probes, measured recall): the fewest cells that hold ``recall`` of the true k nearest of ``check`` drawn queries, found by brute force over the whole corpus.

        Where not all queries are drawn, the measured recall must exceed ``recall`` by MARGIN standard errors, so that it holds for all of them too."""
        q = queries.select(F.col(query_id).alias("query_id"), "vector").where("vector is not null")
        drawn = cut_lineage(q.orderBy(hash_order(seed, F.col("query_id")), "query_id").limit(check))
        true = topk_similar(drawn, self.members, k, self.normalise, exclude_same, tile_rows=self.tile_rows)
        cells = true.join(self.members.select("corpus_id", "cell"), "corpus_id").groupBy("query_id").agg(F.collect_list("cell").alias("cells"))
        table, normalise = self.cells, self.normalise

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    place = np.argsort(table.order(_vectors(batch.column("vector"), normalise)), axis=1)
                    found = [sorted(place[i, c].tolist()) for i, c in enumerate(batch.column("cells").to_pylist())]
                    yield pa.RecordBatch.from_pydict({"places": pa.array(found, pa.list_(pa.int64()))})

        found = [r[0] for r in drawn.join(cells, "query_id").mapInArrow(places, "places array<long>").collect()]  # at most ``check`` rows of k places
        if not found:
            return 1, 1.0
        # hits of each drawn query within so many cells
        hits = np.array([np.cumsum(np.bincount(x, minlength=len(self.cells))) for x in found], dtype=float)
        got, sizes = hits.sum(axis=0) / hits[:, -1].sum(), hits[:, -1]
        error = np.zeros(len(got))
        if q.count() > len(found) > 1:
            # recall is a ratio of sums over drawn queries: its deviation from that over all queries
            error = np.sqrt(((hits - got * sizes[:, None]) ** 2).sum(axis=0) / (len(found) - 1) / len(found)) / sizes.mean()
        probes = int(np.argmax(got - MARGIN * error >= recall - 1e-9)) + 1 if (got - MARGIN * error >= recall - 1e-9).any() else len(self.cells)
        return probes, float(got[probes - 1])
