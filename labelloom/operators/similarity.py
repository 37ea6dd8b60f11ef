"""Vector similarity, retrieval, embedding cache and negative mining.

Ids keep their type. Scores are rounded to 9 digits before they are compared, so that the order of additions
in different engines cannot change a ranking; ties are broken by id.
"""
from __future__ import annotations

import bisect
import math
import os
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.arrays import or_empty
from ..functions.hashing import hash_order, model_key, text_key
from ..functions.scalars import one_row
from ..functions.text import skill_text, strip, words
from ..functions.vectors import as_double, cosine, dot, norm
from ..session import cut_lineage
from .groups import cooccurring_by_group, group_hard_negatives  # noqa: F401
from .tiles import CHUNK_CELLS, DIGITS, SLACK, TILE_BYTES, TILE_ROWS, best_rounded, chunks, matrix, near, nested, tiled

# --- fixed values -----------------------------------------------------------------------------
DEFAULT_MAX_POSITIVE, DEFAULT_MIN_QUERY = 0.7, 0.4
EMBED_ROWS = 512
#: Cells whose exact scores are worked out at a time.
EXACT_CELLS = 50_000
# ----------------------------------------------------------------------------------------------


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


# --- encoding -----------------------------------------------------------------------------------

def embed(df: DataFrame, text_col: str, encoder: Callable[[], Callable[[list[str]], np.ndarray]],
          batch: int = 32, normalise: bool = True, out: str = "vector") -> DataFrame:
    """Text -> vector. ``encoder()`` loads the model once per Python worker and returns texts -> matrix."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"`{out}` array<float>"])

    step = max(1, EMBED_ROWS // batch) * batch  # rows whose texts are Python strings at a time

    def run(batches):
        model = None
        for whole in batches:
            for low in range(0, len(whole), step):
                rows = whole.slice(low, step)
                if model is None:
                    model = encoder()
                texts = rows.column(rows.schema.get_field_index(text_col)).to_pylist()
                m = np.vstack([np.asarray(model(texts[i:i + batch]), dtype=np.float64) for i in range(0, len(texts), batch)])
                if normalise:
                    n = np.linalg.norm(m, axis=1, keepdims=True)
                    m = np.divide(m, n, out=m.copy(), where=n > 0)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(list(m.astype(np.float32)), pa.list_(pa.float32()))], names=[*rows.schema.names, out])

    return df.mapInArrow(run, schema)


def hashing_embed(df: DataFrame, text_col: str, dim: int = 64, out: str = "vector") -> DataFrame:
    """Default without a model: hashed word counts, unit length. Runs in the JVM."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array
    x = df.withColumn("_w", words(F.lower(F.col(text_col))))
    x = HashingTF(inputCol="_w", outputCol="_tf", numFeatures=dim).transform(x)
    x = Normalizer(inputCol="_tf", outputCol="_nv", p=2.0).transform(x)
    return x.withColumn(out, vector_to_array("_nv", "float32")).drop("_w", "_tf", "_nv")


class EmbeddingCache:
    """Vectors of one model, keyed by md5 of ``label: description``, in Parquet folders that a manifest lists.

    A fill writes a folder of its own, in ranges of keys (the first two digits), and is part of the store once version n + 1 of the manifest is in its place, by a rename that
    does not overwrite. Who comes second drops the keys that others have committed since it looked, and tries again; so equal keys never stand twice, however
    many jobs fill at once, and a job that dies leaves nothing that counts. The file system must rename atomically (HDFS does).
    Whether a text is there is asked in the ranges of the requested keys only.
    """
    SCHEMA = "text_id string, text string, vector array<float>"

    def __init__(self, spark: SparkSession, root: str, model: str):
        self.spark, self.model_id = spark, model_key(model)
        self.path = os.path.join(root, f"model_id={self.model_id}")

    def _hadoop(self, *names: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, *names))
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _manifest(self) -> tuple[int, list[str]]:
        """(version, committed folders) of the newest manifest; version 0 has none."""
        fs, p = self._hadoop("manifest")
        versions = sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []
        if not versions:
            return 0, []
        fs, p = self._hadoop("manifest", versions[-1])
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return int(versions[-1]), text.split()

    def _commit(self, version: int, folders: list[str]) -> bool:
        """Put manifest ``version`` in its place by one rename that does not overwrite; false if somebody else was first."""
        from py4j.protocol import Py4JJavaError
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        fs, target = self._hadoop("manifest", f"{version:012d}")
        draft = self._hadoop(f"draft-{uuid.uuid4().hex}")[1]
        stream = fs.create(draft, False)
        stream.write(bytearray("\n".join(folders).encode()))
        stream.close()
        fs.mkdirs(target.getParent())
        kind = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(draft), fs.makeQualified(target), options)
            return True
        except Py4JJavaError:
            if not fs.exists(target):
                raise
            fs.delete(draft, False)
            return False

    def _read(self, folders: list[str], ranges: list[str] | None = None) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA + ", fill string, range string").option("basePath", self.path).parquet(*[os.path.join(self.path, f) for f in folders])
        return (rows if ranges is None else rows.where(F.col("range").isin(ranges))).select("text_id", "text", "vector")

    def table(self) -> DataFrame:
        return self._read(self._manifest()[1])

    def keyed(self, items: DataFrame) -> DataFrame:
        """Adds text and text_id to (label, description) rows."""
        text = skill_text(F.col("label"), F.col("description"))
        return items.withColumn("text", text).withColumn("text_id", text_key(text))

    def _requested(self, items: DataFrame) -> list[str]:
        """Key ranges of the items: 256 at most."""
        return sorted(r[0] for r in self.keyed(items).select(F.substring("text_id", 1, 2)).distinct().collect() if r[0] is not None)

    def misses(self, items: DataFrame, folders: list[str] | None = None) -> DataFrame:
        """Distinct texts that have no vector yet."""
        folders = self._manifest()[1] if folders is None else folders
        return (self.keyed(items).select("text_id", "text").dropDuplicates(["text_id"])
                .join(self._read(folders, self._requested(items)).select("text_id"), "text_id", "left_anti"))

    def lookup_stats(self, items: DataFrame) -> DataFrame:
        """total, hits, misses, hit rate of the requested rows."""
        known = self._read(self._manifest()[1], self._requested(items)).select("text_id", F.lit(True).alias("hit"))
        return cache_stats(self.keyed(items).join(known, "text_id", "left").select(F.col("hit").isNotNull().alias("hit")))

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        """(new folder, rows in it); not part of the store yet."""
        folder = f"fill={uuid.uuid4().hex}"
        rows.select("text_id", "text", "vector", F.substring("text_id", 1, 2).alias("range")).write.partitionBy("range").parquet(os.path.join(self.path, folder))
        fs, p = self._hadoop(folder)
        some = any(f.isDirectory() for f in fs.listStatus(p))  # an empty write has no ranges
        return folder, self._read([folder]).count() if some else 0

    def fill(self, items: DataFrame, encode: Callable[[DataFrame, str], DataFrame]) -> int:
        """Encode what is missing and commit it; returns how many were added. The encoder runs once."""
        version, known = self._manifest()
        folder, n = self._write(encode(self.misses(items, known), "text"))
        while n:
            now, folders = self._manifest()
            if since := [f for f in folders if f not in known]:
                others = self._read(since).select("text_id")
                folder, n = self._write(self._read([folder]).join(others, "text_id", "left_anti"))
                known = folders
                continue
            if self._commit(now + 1, [*folders, folder]):
                break
        return n

    def embed(self, items: DataFrame, encode: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """Rows with their vectors, aligned by key."""
        self.fill(items, encode)
        return self.keyed(items).join(self._read(self._manifest()[1], self._requested(items)).select("text_id", "vector"), "text_id")

    def prepopulate(self, items: DataFrame, encode, clear: bool = False) -> int:
        if clear:
            self.clear()
        return self.fill(items, encode)

    def clear(self) -> None:
        """Drop the vectors of this model only."""
        fs, p = self._hadoop()
        fs.delete(p, True)


def cache_stats(log: DataFrame) -> DataFrame:
    """total, hits, misses, hit rate of a log with a boolean ``hit``."""
    a = log.agg(F.count(F.lit(1)).alias("total"), F.count_if("hit").alias("hits"))
    return a.select("total", "hits", (F.col("total") - F.col("hits")).alias("misses"),
                    F.when(F.col("total") > 0, F.col("hits") / F.col("total")).otherwise(0.0).alias("hit_rate"))


# --- retrieval ----------------------------------------------------------------------------------

def topk_kernel(k: int, normalise: bool = True, exclude_same: bool = False) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel of a pair of tiles (query_id, vector) and (corpus_id, vector): at most k rows (query_id, corpus_id, score) for each query."""
    def kernel(l: pa.Table, r: pa.Table) -> pa.Table:
        out_q, out_c, out_s = [], [], []
        if len(l) and len(r):
            r = r.sort_by("corpus_id")
            q, c = matrix(l, "vector", normalise), matrix(r, "vector", normalise)
            column = {x: i for i, x in enumerate(r["corpus_id"].to_pylist())} if exclude_same else {}
            ids = l["query_id"].to_pylist() if exclude_same else []
            for part in chunks(len(l), len(r)):
                s = q[part] @ c.T
                for i, x in enumerate(ids[part]) if exclude_same else ():
                    if x in column:
                        s[i, column[x]] = -np.inf
                rows, cols, scores = best_rounded(s, k)
                out_q.append(rows + part.start), out_c.append(cols), out_s.append(scores)
        cat = (lambda p: np.concatenate(p) if p else np.empty(0, np.int64))
        return pa.table({"query_id": l["query_id"].take(pa.array(cat(out_q), pa.int64())),
                         "corpus_id": r["corpus_id"].take(pa.array(cat(out_c), pa.int64())),
                         "score": pa.array(cat(out_s), pa.float64())})

    return kernel


def first_k(local: DataFrame, k: int) -> DataFrame:
    """Merges the local results of tiles: rank by score, ties by corpus id."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return local.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def topk_similar(queries: DataFrame, corpus: DataFrame, k: int = 30, normalise: bool = True,
                 exclude_same: bool = False, query_id: str = "query_id", corpus_id: str = "corpus_id",
                 tile_rows: int = TILE_ROWS) -> DataFrame:
    """Exact k nearest corpus items of each query by cosine: (query_id, corpus_id, score, rank).

    Each tile returns at most k rows per query, a window with a group limit merges them. All pairs of tiles are multiplied; a corpus that is
    searched more than once, or that falls into clusters, is cheaper through ``inverted.InvertedFile``.
    """
    left = queries.select(F.col(query_id).alias("query_id"), "vector")
    right = corpus.select(F.col(corpus_id).alias("corpus_id"), "vector")
    schema = f"query_id {_type(left, 'query_id')}, corpus_id {_type(right, 'corpus_id')}, score double"
    return first_k(tiled(left, "query_id", right, "corpus_id", topk_kernel(k, normalise, exclude_same), schema, tile_rows), k)


def find_similar(queries: DataFrame, cache: DataFrame, k: int, exclude: DataFrame, **kw) -> DataFrame:
    """Top k first, excluded ids removed afterwards: fewer than k may remain."""
    return topk_similar(queries, cache, k, **kw).join(exclude.select("corpus_id").distinct(), "corpus_id", "left_anti")


def rerank(preds: DataFrame, scorer: Callable[[], Callable[[list[str], list[str]], list[float]]],
           query_text: str = "query", title: str = "title") -> DataFrame:
    """Pair scores in place of the first scores, best first; the candidate set stays."""
    schema = preds.schema.simpleString()[len("struct<"):-1] if "score" in preds.columns else None
    base = preds if schema else preds.withColumn("score", F.lit(0.0))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)

    def run(batches):
        model = None
        for pdf in batches:
            if model is None:
                model = scorer()
            yield pdf.assign(score=np.asarray(model(list(pdf[query_text]), list(pdf[title])), dtype=float))

    scored = base.repartition(F.xxhash64("query_id", "corpus_id")).mapInPandas(run, fields)  # few rows would else be scored by a single task
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return scored.withColumn("rank", F.row_number().over(w))


def rank_positives(samples: DataFrame, pool: DataFrame, normalise: bool = True, tile_rows: int = TILE_ROWS // 2) -> DataFrame:
    """(sample_id, label, similarity, rank): 1 + number of pool items with a higher score.

    ``samples``: sample_id, vector, pos (labels of the pool). No order of the pool is ever built: a tile
    counts how many of its items beat each positive, and the counts are added. Scores are compared in single precision, and exactly where that cannot tell.
    """
    sim = cosine if normalise else dot
    p = pool.select(F.col("label"), F.col("vector").alias("_v"))
    scored = (samples.select("sample_id", "vector", F.explode(F.array_distinct("pos")).alias("label"))
              .join(p, "label").select("sample_id", "label", F.round(sim(F.col("vector"), F.col("_v")), DIGITS).alias("s")))
    lists = scored.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("label", "s"))).alias("t"))
    left = samples.select("sample_id", "vector").join(lists, "sample_id").select(
        "sample_id", "vector", F.col("t.label").alias("labels"), F.col("t.s").alias("scores"))
    right = pool.select("label", "vector")

    def kernel(l: pa.Table, r: pa.Table) -> pa.Table:
        sizes = np.array([len(x) for x in nested(l, "labels")], dtype=np.int64)
        owner = np.repeat(np.arange(len(l)), sizes)
        flat = l["scores"].combine_chunks().flatten() if len(l) else pa.array([], pa.float64())
        names = l["labels"].combine_chunks().flatten() if len(l) else pa.array([], pa.string())
        higher = np.zeros(len(owner), dtype=np.int64)
        if len(l) and len(r):
            q, c, t = matrix(l, "vector", normalise), matrix(r, "vector", normalise), np.asarray(flat)
            first = np.cumsum(sizes) - sizes
            rough = Rough(q, c, normalise)
            for part in chunks(len(l), len(r)):
                x = rough(part)
                for nth in range(sizes[part].max(initial=0)):
                    mine = np.flatnonzero(sizes[part] > nth)
                    at = first[part][mine] + nth
                    above, open_x, open_y = rough.above(x, mine, t[at], part)
                    exact = np.round(rough.exact(open_x + part.start, open_y), DIGITS)
                    above += np.bincount(open_x[~(exact <= t[first[part][open_x] + nth])], minlength=len(x))
                    higher[at] = np.where(np.isnan(t[at]), 0, above[mine])
        return pa.table({"sample_id": l["sample_id"].take(pa.array(owner)), "label": names,
                         "similarity": flat, "higher": pa.array(higher)})

    schema = f"sample_id {_type(left, 'sample_id')}, label string, similarity double, higher bigint"
    (n_left, mine), (n_right, theirs) = (df.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first() for df in (samples, pool))
    tile_rows = max(1, min(tile_rows, TILE_BYTES // (8 * max(1, mine or 1, theirs or 1))))
    return tiled(left, "sample_id", right, "label", kernel, schema, tile_rows, (n_left, n_right)).groupBy("sample_id", "label").agg(
        F.first("similarity").alias("similarity"), (F.sum("higher") + 1).alias("rank"))


def best_ranks(ranked: DataFrame) -> DataFrame:
    """Best-ranked positive of each sample."""
    best = F.struct("rank", "label", "similarity")
    return ranked.groupBy("sample_id").agg(F.min(best).alias("b")).select(
        "sample_id", F.col("b.rank").alias("best_rank"), F.col("b.label").alias("best_label"),
        F.col("b.similarity").alias("similarity"))


class Rough:
    """Scores of tiles in single precision, and how far they may lie from the exact ones that decide: half the bytes and twice the speed where nearly all cells can be told apart without more.

    Vectors of unit length; others are kept in double precision.
    """

    def __init__(self, q: np.ndarray, c: np.ndarray, unit: bool = True):
        kind = np.float32 if unit else np.float64
        self.q, self.c, self.left, self.right = q, c, q.astype(kind), np.ascontiguousarray(c.astype(kind).T)
        lengths = np.ones(len(q)) if unit else np.linalg.norm(q, axis=1) * (norms := np.linalg.norm(c, axis=1))[np.isfinite(norms)].max(initial=0)
        self.error = (q.shape[1] + 8) * np.finfo(kind).eps * np.maximum(lengths, 1) + SLACK

    def __call__(self, part, columns: slice = slice(None)) -> np.ndarray:
        return self.left[part] @ self.right[:, columns]

    def exact(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Scores of some cells."""
        out = np.empty(len(rows))
        for low in range(0, len(rows), EXACT_CELLS):
            some = slice(low, low + EXACT_CELLS)
            out[some] = np.einsum("ij,ij->i", self.q[rows[some]], self.c[columns[some]])
        return out

    def above(self, x: np.ndarray, mine: np.ndarray, t: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells surely above for each row of ``x``, rows and columns of cells that may be): the rows ``mine`` of rough scores against ``t``. No number is above all."""
        some, error = x if len(mine) == len(x) else x[mine], self.error[part][mine]
        high, low = ((t + error)[:, None]).astype(x.dtype), ((t - error)[:, None]).astype(x.dtype)
        sure = ~(some <= high)
        bits = np.packbits(sure, axis=1)
        n = np.zeros(len(x), np.int64)
        n[mine] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        row, column = np.divmod(np.flatnonzero(sure ^ ~(some < low)), x.shape[1])
        return n, mine[row], column


# --- score distributions ------------------------------------------------------------------------

def separation(scores: DataFrame) -> DataFrame:
    """Positive vs negative similarities: means, difference and class, share of pairs with pos > neg and class.

    Input: score, is_positive. The pair share comes from running counts of the sorted scores, folded to one
    row per distinct score; a tie counts as not greater.
    """
    from ..functions.ranking import running_before
    per = scores.groupBy("score").agg(F.count_if("is_positive").alias("p"), F.count_if(~F.col("is_positive")).alias("m"))
    below = running_before(per, [], F.floor(F.col("score") * 1000), [F.col("score")], {"m_below": F.col("m")})
    wins = one_row(below.agg(F.sum(F.col("p") * F.col("m_below")).alias("w")))
    pos = F.when(F.col("is_positive"), F.col("score"))
    neg = F.when(~F.col("is_positive"), F.col("score"))
    a = scores.agg(F.avg(pos).alias("pos_mean"), F.stddev_pop(pos).alias("pos_std"), F.avg(neg).alias("neg_mean"),
                   F.stddev_pop(neg).alias("neg_std"), F.count(pos).alias("n_pos"), F.count(neg).alias("n_neg"))
    a = (a.withColumn("separation", F.col("pos_mean") - F.col("neg_mean"))
         .withColumn("pair_share", wins.w / (F.col("n_pos") * F.col("n_neg"))))

    def grade(c, *cuts):
        return (F.when(F.col(c) > cuts[0], "excellent").when(F.col(c) > cuts[1], "good")
                .when(F.col(c) > cuts[2], "fair").otherwise("poor"))
    return a.select("*", grade("separation", 0.2, 0.1, 0.05).alias("separation_class"),
                    grade("pair_share", 0.8, 0.7, 0.6).alias("pair_class"))


def pair_similarities(vectors: DataFrame, groups: DataFrame, n: int = 1000, seed: int = 42, normalise: bool = True) -> DataFrame:
    """Similarities of drawn pairs: (class, a, b, similarity); ``vectors``: label, vector; ``groups``: label, occupation.

    Same group: up to 5 draws per group with 2+ members, n/2 in all; different: up to 2 draws per label, n/2
    in all, dropped when the two share a group. Draws are md5-ordered, so the sample is reproducible.
    """
    sim = cosine if normalise else dot
    half = n // 2
    usable = groups.groupBy("occupation").agg(F.count(F.lit(1)).alias("m")).where("m >= 2")
    draws = (usable.select("occupation", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("draw"))
             .orderBy(hash_order(seed, F.col("occupation"), F.col("draw"))).limit(half))
    members = groups.select("label", "occupation").join(draws, "occupation")
    w = Window.partitionBy("occupation", "draw").orderBy(hash_order(seed, F.col("occupation"), F.col("draw"), F.col("label")), "label")
    two = members.withColumn("i", F.row_number().over(w)).where("i <= 2")
    same = two.groupBy("occupation", "draw").agg(F.min("label").alias("a"), F.max("label").alias("b")).select(
        F.lit("same_group").alias("class"), "a", "b")

    def drawn(salt):
        slots = vectors.select("label", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("draw"))
        key = hash_order(f"{seed}{salt}", F.col("label"), F.col("draw"))
        # at most n/2 rows from here on
        return slots.withColumn("_k", key).orderBy("_k").limit(half).withColumn(
            "i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_k")))

    x = drawn("a").select("i", F.col("label").alias("a")).join(drawn("b").select("i", F.col("label").alias("b")), "i").where("a <> b")
    ga = groups.join(x.select(F.col("a").alias("label")).distinct(), "label", "left_semi")
    sharing = (x.join(ga.select(F.col("label").alias("a"), "occupation"), "a")
               .join(groups.select(F.col("label").alias("b"), "occupation"), ["b", "occupation"], "left_semi").select("i").distinct())
    different = x.join(sharing, "i", "left_anti").select(F.lit("different_group").alias("class"), "a", "b")
    pairs = same.unionByName(different)
    va = vectors.select(F.col("label").alias("a"), F.col("vector").alias("va"))
    vb = vectors.select(F.col("label").alias("b"), F.col("vector").alias("vb"))
    return pairs.join(va, "a").join(vb, "b").select("class", "a", "b", sim(F.col("va"), F.col("vb")).alias("similarity"))


def similarity_distribution(pairs: DataFrame) -> DataFrame:
    """Per class and over all pairs: n, min, max, mean, median, population std, p10, p25, p50, p75, p90."""
    x = pairs.select(F.explode(F.array("class", F.lit("all_pairs"))).alias("class"), "similarity")
    p = F.percentile("similarity", F.array(*[F.lit(q) for q in (0.1, 0.25, 0.5, 0.75, 0.9)]))
    out = x.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("min"), F.max("similarity").alias("max"),
                                 F.avg("similarity").alias("mean"), F.stddev_pop("similarity").alias("std"), p.alias("p"))
    return out.select("class", "n", "min", "max", "mean", F.col("p")[2].alias("median"), "std",
                      *[F.col("p")[i].alias(f"p{q}") for i, q in enumerate((10, 25, 50, 75, 90))])


def threshold_recommendation(pairs: DataFrame) -> DataFrame:
    """distance = 1 - p75 of the same-group pairs (cuts the top 25 %), conservative = 1 - p50."""
    a = pairs.where(F.col("class") == "same_group").agg(F.percentile("similarity", F.array(F.lit(0.75), F.lit(0.5))).alias("p"))
    return a.select((1 - F.col("p")[0]).alias("distance_threshold"), (1 - F.col("p")[1]).alias("conservative_threshold"))


def calibrate_from(pairs: DataFrame) -> DataFrame:
    """Mining thresholds from the pair table; without same-group pairs the defaults."""
    a = pairs.where(F.col("class") == "same_group").agg(F.percentile("similarity", F.array(F.lit(0.75), F.lit(0.5))).alias("p"))
    return a.select(F.coalesce(F.col("p")[1], F.lit(DEFAULT_MAX_POSITIVE)).alias("max_positive_similarity"),
                    F.coalesce(F.col("p")[0], F.lit(DEFAULT_MIN_QUERY)).alias("min_query_similarity"))


def calibrate(samples: DataFrame, pool: DataFrame, n: int | None = 50, max_negs: int | None = 10, seed: int = 42,
              normalise: bool = True) -> DataFrame:
    """Similarity statistics of n drawn samples and the mining threshold = median(query, positive).

    ``samples``: sample_id, vector, pos, neg. Only the drawn samples are joined to the pool. ``n=None`` takes all samples and ``max_negs=None`` all
    negatives; quantiles over all are exact for 9 digits and come from histograms (``distribution.column_quantiles``), since a percentile aggregate would
    keep a counter for each value.
    """
    sim = cosine if normalise else dot
    full = samples.where((F.size(or_empty(F.col("pos"))) > 0) & (F.size(or_empty(F.col("neg"))) > 0))
    drawn = full if n is None else full.orderBy(hash_order(seed, F.col("sample_id")), "sample_id").limit(n)
    negs = F.col("neg") if max_negs is None else F.transform(F.slice(F.array_sort(F.transform(F.col("neg"), lambda x, i: F.struct(
        hash_order(seed, F.col("sample_id"), x).alias("k"), i.alias("i"), x.alias("l")))), 1, max_negs), lambda t: t.l)
    sides = F.array(F.struct(F.lit("pos").alias("side"), F.col("pos").alias("l")), F.struct(F.lit("neg").alias("side"), negs.alias("l")))
    rows = drawn.select("sample_id", "vector", F.explode(sides).alias("s")).select(
        "sample_id", "vector", "s.side", F.posexplode("s.l").alias("i", "label"))
    v = pool.select("label", F.col("vector").alias("v"))
    scored = rows.join(v, "label").withColumn("sim", sim(F.col("vector"), F.col("v")))
    p = scored.where("side = 'pos'").select("sample_id", "i", "v")
    pp = (p.alias("x").join(p.alias("y"), "sample_id").where("x.i < y.i")
          .select(F.lit("pos_pos").alias("side"), sim(F.col("x.v"), F.col("y.v")).alias("sim")))
    allp = scored.select("side", "sim").unionByName(pp)
    if n is None:
        from .distribution import column_quantiles
        allp = cut_lineage(allp)
        known = {(side, q): v for side, qs in (("pos", (0.25, 0.5)), ("neg", (0.75, 0.9)), ("pos_pos", (0.5,)))
                 for q, v in zip(qs, column_quantiles(allp.where(F.col("side") == side), "sim", qs)[1])}

    def stat(side, q):
        if n is None:
            return F.first(F.lit(known[side, q]).cast("double"))
        return F.percentile(F.when(F.col("side") == side, F.col("sim")), F.lit(q))

    def of(side):
        return F.when(F.col("side") == side, F.col("sim"))
    return allp.agg(
        F.avg(of("pos")).alias("query_pos_mean"), F.stddev_pop(of("pos")).alias("query_pos_std"),
        stat("pos", 0.25).alias("query_pos_p25"), stat("pos", 0.5).alias("query_pos_p50"),
        F.avg(of("neg")).alias("query_neg_mean"), F.stddev_pop(of("neg")).alias("query_neg_std"),
        stat("neg", 0.75).alias("query_neg_p75"), stat("neg", 0.9).alias("query_neg_p90"),
        F.avg(of("pos_pos")).alias("pos_pos_mean"), stat("pos_pos", 0.5).alias("pos_pos_p50"),
    ).select("*", F.col("query_pos_p50").alias("max_positive_similarity"), F.lit(0.0).alias("min_query_similarity"))


# --- grouping -----------------------------------------------------------------------------------

def chunk_by_similarity(samples: DataFrame, pool: DataFrame, n: int = 3, threshold: float = 0.88,
                        labels: str = "pos") -> DataFrame:
    """(sample_id, chunks): open a chunk with the next free label, add later free ones close to that seed.

    Labels without a vector vanish; a sample without any vector gets consecutive slices.
    """
    from ..functions.arrays import chunk_sequential
    rows = samples.select("sample_id", F.posexplode(F.filter(or_empty(F.col(labels)), lambda x: x != "")).alias("i", "label"))
    withv = rows.join(pool.select("label", "vector"), "label")

    items = withv.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("i", "label", "vector"))).alias("t"))

    def greedy(names: list[str], flat: np.ndarray) -> list[list[str]]:
        m = flat.reshape(len(names), -1)
        length = np.linalg.norm(m, axis=1, keepdims=True)
        m = np.divide(m, length, out=m.copy(), where=length > 0)
        close = np.round(m @ m.T, DIGITS) >= threshold
        at = {l: i for i, l in reversed(list(enumerate(names)))}
        free, out = list(dict.fromkeys(names)), []
        while free:
            chunk, rest = [free[0]], []
            for other in free[1:]:
                (chunk if len(chunk) < n and close[at[free[0]], at[other]] else rest).append(other)
            out.append(chunk)
            free = rest
        return out

    @F.pandas_udf("array<array<string>>")
    def chunked(names: pd.Series, vectors: pd.Series) -> pd.Series:
        return pd.Series([greedy(list(l), np.asarray(v, dtype=float)) for l, v in zip(names, vectors)])

    found = items.select("sample_id", chunked(F.col("t.label"), F.flatten("t.vector")).alias("_chunks"))
    plain = chunk_sequential(F.filter(or_empty(F.col(labels)), lambda x: x != ""), n)
    return samples.join(found, "sample_id", "left").select("sample_id", F.coalesce("_chunks", plain).alias("chunks"))


def in_group_redundancy(df: DataFrame, dim: int, key: str = "id", group: str = "label") -> DataFrame:
    """Mean cosine of each member to all others of its group; linear: (v . sum(u) - 1) / (n - 1).

    The vector sum is ``dim`` ordinary sums, combined on the map side, so a huge group costs one row.
    """
    from ..functions.vectors import normalised
    x = df.select(F.col(key).alias("id"), F.col(group).alias("group"), normalised(F.col("vector")).alias("v"))
    s = x.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v")[i]) for i in range(dim)]).alias("s"))
    self_sim = F.when(norm(F.col("v")) > 0, 1.0).otherwise(0.0)
    mean = F.when(F.col("n") > 1, (dot(F.col("v"), F.col("s")) - self_sim) / (F.col("n") - 1)).otherwise(0.0)
    return x.join(s, "group").select("id", "group", "n", mean.alias("redundancy"))


def novelty(skills: DataFrame, covered: DataFrame, sample: int | None = 30, seed: int = 42) -> DataFrame:
    """label, novelty = 1 - max similarity to at most ``sample`` md5-drawn covered labels, within [0, 1]; ``sample=None`` compares with all of them, in tiles.

    No reference set -> 0.5.
    """
    if sample is None:
        near = topk_similar(skills, covered, 1, normalise=False, query_id="label", corpus_id="label").select(F.col("query_id").alias("label"), "score")
        value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.least(F.col("score"), F.lit(1.0))))
        return skills.select("label").join(near, "label", "left").select("label", F.coalesce(value, F.lit(0.5)).alias("novelty"))
    drawn = covered.orderBy(hash_order(seed, F.col("label")), "label").limit(sample).select("vector")
    refs = one_row(drawn.agg(F.collect_list("vector").alias("v"))).v
    x = skills.withColumn("_refs", refs)
    best = F.array_max(F.transform("_refs", lambda r: dot(F.col("vector"), r)))
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.least(best, F.lit(1.0))))
    return x.select("label", F.when(F.size("_refs") > 0, value).otherwise(0.5).alias("novelty"))


# --- negatives ----------------------------------------------------------------------------------

#: Skipped labels of a sample that a tile hands on one by one; samples with more are counted in a second pass.
SKIPPED = 8
#: Labels that a sample is compared with at first, without a bound from those before, and at most at a time.
FIRST_COLUMNS, MOST_COLUMNS = 256, 16_384


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _places(row: np.ndarray) -> np.ndarray:
    """Place of each cell among those of its row; rows stand together."""
    return np.arange(len(row)) - np.searchsorted(row, row)


def _first(row: np.ndarray, order: np.ndarray, k: int, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows and values of the first k cells of each row, in an order by rows."""
    order = order[_places(row[order]) < k]
    return row[order], *(v[order] for v in values)


class _Walk:
    """A pair of tiles: rough scores of samples and labels (columns in order), and for single cells the exact score, whether the sample has the label, and whether the label is too similar to a positive.

    Nearly all cells lie surely below what matters for their sample and are only compared with that bound. Samples with equal lists of positives share what is found for a list.
    """

    def __init__(self, l: pa.Table, r: pa.Table, max_pos_sim: float):
        self.q, self.c, self.limit = matrix(l, "vector"), matrix(r, "vector"), max_pos_sim
        self.rough = Rough(self.q, self.c)
        lists = l["pv"].combine_chunks()
        bounds, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        numbers: dict[bytes, int] = {}
        self.of = np.array([numbers.setdefault(flat[a:b].tobytes(), len(numbers)) for a, b in zip(bounds[:-1], bounds[1:])], np.int64)
        some = np.unique(self.of, return_index=True)[1]  # a row of each list
        pos = [flat[bounds[i]:bounds[i + 1]].reshape(-1, self.c.shape[1]) for i in some]
        self.n_pos = np.array([len(m) for m in pos], np.int64)
        self.first = np.cumsum(self.n_pos) - self.n_pos
        m = np.concatenate(pos).astype(np.float64)
        length = np.linalg.norm(m, axis=1, keepdims=True)
        self.pos = np.divide(m, length, out=m.copy(), where=length > 0)
        self.table = self._close(np.arange(len(some))) if len(some) <= max(len(l) // 16, 1) and len(some) * len(r) <= TILE_BYTES else None
        names = r["label"].combine_chunks().dictionary_encode()
        code = names.indices.to_numpy(zero_copy_only=False)
        have = l["used"].combine_chunks()
        at = pc.index_in(have.values, value_set=names.dictionary)
        owner = np.repeat(np.arange(len(l)), np.diff(np.asarray(have.offsets)))
        known = at.is_valid().to_numpy(zero_copy_only=False)[have.offsets[0].as_py():have.offsets[-1].as_py()]
        at = at.fill_null(0).to_numpy(zero_copy_only=False)[have.offsets[0].as_py():have.offsets[-1].as_py()][known]
        low = np.searchsorted(code, at)
        copies = np.searchsorted(code, at, "right") - low
        self.used = np.sort(np.repeat(owner[known], copies) * len(r) + _runs(low, copies))

    def _close(self, sets: np.ndarray) -> np.ndarray:
        """Which labels are too similar to one of the positives, for some lists."""
        rows, step = _runs(self.first[sets], self.n_pos[sets]), max(1, CHUNK_CELLS // max(1, len(self.c)))
        mine, out = np.repeat(np.arange(len(sets)), self.n_pos[sets]), np.zeros((len(sets), len(self.c)), dtype=bool)
        for start in range(0, len(rows), step):
            for i, hit in zip(mine[start:start + step], np.round(self.pos[rows[start:start + step]] @ self.c.T, DIGITS) >= self.limit):
                out[i] |= hit
        return out

    def close(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        of = self.of[rows]
        if self.table is not None:
            return self.table[of, columns]
        sets, which = np.unique(of, return_inverse=True)
        if len(rows) * 16 > len(sets) * len(self.c):
            return self._close(sets)[which, columns]
        out = np.zeros(len(rows), dtype=bool)
        for nth in range(self.n_pos[sets].max(initial=0)):
            left = np.flatnonzero(~out & (self.n_pos[of] > nth))
            for low in range(0, len(left), EXACT_CELLS):
                some = left[low:low + EXACT_CELLS]
                out[some] = np.round(np.einsum("ij,ij->i", self.pos[self.first[of[some]] + nth], self.c[columns[some]]), DIGITS) >= self.limit
        return out

    def has(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        cell = rows * len(self.c) + columns
        return self.used[np.minimum(np.searchsorted(self.used, cell), len(self.used) - 1)] == cell if len(self.used) else np.zeros(len(cell), dtype=bool)

    def cells(self, part: slice, columns: slice, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, rough score) of the cells that may reach the limit of their row (NaN never does)."""
        x = self.rough(part, columns)
        at = np.flatnonzero(x >= (near(limit) - self.rough.error[part]).astype(x.dtype)[:, None])
        row, column = np.divmod(at, x.shape[1])
        return row, column + columns.start, x.ravel()[at]

    def exact(self, part: slice, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Scores of some cells, rounded."""
        if len(rows) * 16 > (part.stop - part.start) * len(self.c):
            return np.round((self.q[part] @ self.c.T)[rows, columns], DIGITS)
        return np.round(self.rough.exact(rows + part.start, columns), DIGITS)


def _walk(l: pa.Table, r: pa.Table, max_pos_sim: float):
    """All cells of ``_Walk``: (rows, scores, close, which, used) for blocks of the left tile, rows with equal positives side by side; ``which`` is the row of ``close`` of each. Scores are not rounded."""
    walk = _Walk(l, r, max_pos_sim)
    order, place = np.argsort(walk.of, kind="stable"), np.empty(len(l), np.int64)
    owner, column = np.divmod(walk.used, len(r))
    for part in chunks(len(l), len(r)):
        rows = order[part]
        sets, which = np.unique(walk.of[rows], return_inverse=True)
        place[:] = -1
        place[rows] = np.arange(len(rows))
        mine = place[owner] >= 0
        yield rows, walk.q[rows] @ walk.c.T, walk._close(sets), which, (place[owner[mine]], column[mine])


def mine_hard_negatives(samples: DataFrame, pool: DataFrame, k: int = 8, max_pos_sim: float = 0.7,
                        tile_rows: int = TILE_ROWS, skipped_rows: int = SKIPPED) -> DataFrame:
    """Up to k nearest pool labels per sample that are unused and not too similar to any positive.

    ``samples``: sample_id, vector, pos, neg; ``pool``: label, vector. One pass over the tiles: of each sample a tile returns its k best valid labels and those labels
    before the last of them that the walk skips, which is all that can matter: the k-th pick of all tiles is not behind that of one. Samples that skip
    more than ``skipped_rows`` labels in a tile (many labels as close as a positive) are counted in a second pass over just these samples. Both are
    exact for any threshold. Samples without positives pass through. Tiles are bounded by the bytes of their vectors and positives.
    """
    trim = (lambda c: F.array_distinct(F.transform(or_empty(c), strip)))
    base = samples.select("sample_id", "vector", "pos", "neg", trim(F.col("pos")).alias("_p"), trim(F.col("neg")).alias("_n"))
    # in order, so that equal positives are equal lists
    pv = (base.select("sample_id", F.explode("_p").alias("label")).join(pool.select("label", F.col("vector").alias("v")), "label")
          .groupBy("sample_id").agg(F.flatten(F.array_sort(F.collect_list("v"))).alias("pv")))
    mineable = base.where(F.size("_p") > 0)
    left = mineable.join(pv, "sample_id", "left").select(
        "sample_id", "vector", F.array_union("_p", "_n").alias("used"), F.coalesce("pv", F.expr("cast(array() as array<float>)")).alias("pv"))
    right = pool.select("label", "vector")
    id_type = _type(samples, "sample_id")
    n_left, n_pos, wide = base.agg(F.count(F.lit(1)), F.sum(F.size("_p")), F.max(F.size("vector"))).first()
    n_right, width = pool.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    rows, width = (n_left, n_right), 8 * max(1, wide or 1, width or 1)
    held = math.ceil(width * (1 + (n_pos or 0) / max(1, n_left)))
    tile_rows = tuple(max(1, min(tile_rows, TILE_BYTES // x)) for x in (held, width))

    def pick(l: pa.Table, r: pa.Table) -> pa.Table:
        """Rows of kind 0 (picked), 1 (skipped as used), 2 (skipped as too similar), 3 (too many to hand on)."""
        rows, cols, sims, kinds = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]
        if len(l) and len(r):
            r = r.sort_by("label")
            walk = _Walk(l, r, max_pos_sim)
            for part in chunks(len(l), len(r)):
                n_rows, stop, found = part.stop - part.start, 0, []
                limit, tops = np.full(n_rows, -np.inf if k else np.inf), np.full((n_rows, k), -np.inf)  # of the rough scores of the best valid labels so far
                while stop < len(r):
                    columns = slice(stop, min(len(r), stop + min(max(stop, FIRST_COLUMNS), MOST_COLUMNS)))
                    stop = columns.stop
                    x, y, score = walk.cells(part, columns, limit)
                    mine = walk.has(x + part.start, y)
                    valid = ~mine
                    valid[valid] = ~walk.close(x[valid] + part.start, y[valid])
                    found.append((x, y, score, mine, valid))
                    if k and valid.any():
                        a, best = _first(x[valid], np.lexsort((-score[valid], x[valid])), k, score[valid])
                        new = np.full((n_rows, k), -np.inf)
                        new[a, _places(a)] = best
                        tops = -np.partition(-np.concatenate([tops, new], axis=1), k - 1, axis=1)[:, :k]
                        limit = tops.min(axis=1) - walk.rough.error[part]  # so many valid labels are not below this
                x, y, score, mine, valid = (np.concatenate(v) for v in zip(*found))
                late = score >= (near(limit) - walk.rough.error[part])[x]
                x, y, score, mine, valid = x[late], y[late], score[late], mine[late], valid[late]
                sure = ~valid & ~mine & (score > (limit + 3 * walk.rough.error[part])[x])  # before the last pick, whatever the exact scores are
                surely_many = np.bincount(x[sure], minlength=n_rows) > skipped_rows
                x, y, mine, valid = (v[valid | ~surely_many[x]] for v in (x, y, mine, valid))
                score = walk.exact(part, x, y)
                a, b, best = x[valid], y[valid], score[valid]
                a, b, best = _first(a, np.lexsort((b, -best, a)), k, b, best)
                n = np.bincount(a, minlength=n_rows)
                edge, at = np.full(n_rows, -np.inf), np.full(n_rows, len(r))  # the tile's k-th pick, if it has so many
                last = np.cumsum(n)[n >= k] - 1
                edge[n >= k], at[n >= k] = best[last], b[last]
                before = ~valid & ((score > edge[x]) | ((score == edge[x]) & (y < at[x])))
                x, y, score, mine = x[before], y[before], score[before], mine[before]
                many = surely_many | (np.bincount(x[~mine], minlength=n_rows) > skipped_rows)
                x, y, score, mine = (v[~many[x]] for v in (x, y, score, mine))
                rest = np.flatnonzero(many) + part.start
                rows += [a + part.start, x + part.start, rest]
                cols += [b, y, np.zeros(len(rest), np.int64)]
                sims += [best, score, np.zeros(len(rest))]
                kinds += [np.zeros(len(a), np.int64), np.where(mine, 1, 2), np.full(len(rest), 3)]
        return pa.table({"sample_id": l["sample_id"].take(pa.array(np.concatenate(rows))),
                         "label": r["label"].take(pa.array(np.concatenate(cols))),
                         "score": pa.array(np.concatenate(sims)), "kind": pa.array(np.concatenate(kinds))})

    found = cut_lineage(tiled(left, "sample_id", right, "label", pick, f"sample_id {id_type}, label string, score double, kind long", tile_rows, rows))
    w = Window.partitionBy("sample_id").orderBy(F.desc("score"), "label")
    picks = found.where("kind = 0").select("sample_id", "label", "score").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    item = F.struct("rank", "label", "score")
    chosen = cut_lineage(picks.groupBy("sample_id").agg(F.array_sort(F.collect_list(item)).alias("t")))
    full = F.size("t") >= k
    edges = chosen.select("sample_id", F.size("t").alias("_picked"), F.when(full, F.element_at("t", -1).score).alias("cut_score"),
                          F.when(full, F.element_at("t", -1).label).alias("cut_label"))
    many = found.where("kind = 3").select("sample_id").distinct()
    passed = (F.col("score") > F.col("cut_score")) | ((F.col("score") == F.col("cut_score")) & (F.col("label") < F.col("cut_label")))
    skips = found.where("kind in (1, 2)").join(edges, "sample_id", "left").where(F.col("cut_score").isNull() | passed)
    skips = skips.groupBy("sample_id").agg(F.count_if(F.col("kind") == 1).alias("_u"), F.count_if(F.col("kind") == 2).alias("_c"))
    zero = F.lit(0).cast("long")
    counts = (mineable.select("sample_id").join(many, "sample_id", "left_anti").join(skips, "sample_id", "left").join(edges.select("sample_id", "_picked"), "sample_id", "left")
              .select("sample_id", (F.coalesce("_picked", F.lit(0)) + F.coalesce("_u", zero) + F.coalesce("_c", zero)).alias("candidates"),
                      F.coalesce("_u", zero).alias("excluded_used"), F.coalesce("_c", zero).alias("excluded_by_positive_similarity")))

    def skipped(l: pa.Table, r: pa.Table) -> pa.Table:
        seen, used_n, close_n = (np.zeros(len(l), dtype=np.int64) for _ in range(3))
        if len(l) and len(r):
            r = r.sort_by("label")
            names = r["label"].to_pylist()
            limit = np.array([-np.inf if x is None else x for x in l["cut_score"].to_pylist()])
            place = np.array([len(names) if x is None else bisect.bisect_right(names, x) for x in l["cut_label"].to_pylist()])
            walk = _Walk(l, r, max_pos_sim)
            for part in chunks(len(l), len(r)):
                for low in range(0, len(r), MOST_COLUMNS):
                    x, y, score = walk.cells(part, slice(low, min(len(r), low + MOST_COLUMNS)), limit[part])
                    before = score > (limit[part] + walk.rough.error[part])[x]
                    open_ = np.flatnonzero(~before)
                    score, edge = walk.exact(part, x[open_], y[open_]), limit[part][x[open_]]
                    before[open_] = (score > edge) | ((score == edge) & (y[open_] < place[part][x[open_]]))
                    x, y = x[before] + part.start, y[before]
                    mine = walk.has(x, y)
                    near_one = ~mine
                    near_one[near_one] = walk.close(x[near_one], y[near_one])
                    for total, some in ((seen, x), (used_n, x[mine]), (close_n, x[near_one])):
                        total[part] += np.bincount(some - part.start, minlength=part.stop - part.start)
        return pa.table({"sample_id": l["sample_id"], "seen": seen, "used": used_n, "close": close_n})

    if n_many := many.count():
        again = left.join(many, "sample_id", "left_semi").join(edges.drop("_picked"), "sample_id", "left")
        late = (tiled(again, "sample_id", right, "label", skipped, f"sample_id {id_type}, seen bigint, used bigint, close bigint", tile_rows, (n_many, rows[1]))
                .groupBy("sample_id").agg(F.sum("seen").alias("candidates"), F.sum("used").alias("excluded_used"),
                                          F.sum("close").alias("excluded_by_positive_similarity")))
        counts = counts.unionByName(late)
    new = F.coalesce(F.transform("t", lambda x: x.label), F.expr("cast(array() as array<string>)"))
    mined = base.join(chosen, "sample_id", "left").join(counts, "sample_id", "left")
    unchanged = F.size("_p") == 0
    neg = F.when(unchanged, F.col("neg")).otherwise(F.concat(F.array_distinct(F.col("_n")), new))
    return mined.select(
        "sample_id", "pos", neg.alias("neg"), F.size(or_empty(F.col("neg"))).cast("long").alias("n_before"),
        F.when(~unchanged, F.size(new).cast("long")).alias("hard_negatives_added"),
        F.when(~unchanged, F.size(neg).cast("long")).alias("total_negatives"),
        "candidates", "excluded_used", "excluded_by_positive_similarity")
