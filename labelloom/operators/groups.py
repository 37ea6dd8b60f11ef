"""Labels that share groups (occupations) with others: counts, and negatives drawn from them.

A group is light while it has at most ``light`` members on either side; the pairs of light groups are formed by an equi-join and counted on the map side: at most ``light``
rows for each membership. Pairs of heavy groups are never formed. For pairs that a light group has brought up, the heavy share is the overlap of two short
lists. That gives each target a k-th best value so far, and only targets whose heavy groups could still beat it go on: to tiles in which sets of heavy groups are
compared as bitmaps, where targets and labels with equal heavy groups are one row. Heavy groups are numbered, and a set goes to its tiles
as packed pieces, at most two bytes for each group: no tile holds the names of groups, and tiles are bounded by the bytes of their sets.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import words
from ..session import cut_lineage
from .tiles import DIGITS, PIECE, TILE_BYTES, best_k, chunks, matrix, nested, pack_pieces, packed_counts, tiled

#: Members up to which a group's pairs are formed.
LIGHT = 32
#: A tile of labels is so many times larger than one of targets: the work of a target hardly grows with it, what it is sent and brings back falls.
LABEL_ROWS = 8

# --- fixed values -----------------------------------------------------------------------------
MIN_DISTANCE = 0.63
SHARED_WEIGHT, DISTANCE_WEIGHT, MOST_DISTANCE, FEW_WORDS, COVERED, MOST_WORDS = 2, 5, 3, 1.0, 0.5, 2
# ----------------------------------------------------------------------------------------------


class Split:
    """Memberships of two tables (id, groups) in light and heavy groups."""

    def __init__(self, left: DataFrame, right: DataFrame, light: int):
        self.left, self.right = left, right
        sizes = (lambda df: df.select(F.explode("groups").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n")))
        degree = sizes(left) if left is right else sizes(left).unionByName(sizes(right)).groupBy("g").agg(F.max("n").alias("n"))
        self.heavy = cut_lineage(degree.select("g", (F.col("n") > light).alias("h")))
        self.n_heavy, self.n_light = self.heavy.agg(F.count_if("h"), F.count_if(~F.col("h"))).first()
        self.numbers = cut_lineage(self.heavy.where("h").select("g", F.monotonically_increasing_id().alias("no"))) if self.n_heavy else None

    def members(self, df: DataFrame) -> DataFrame:
        """(id, g) of light groups."""
        return df.select("id", F.explode("groups").alias("g")).join(self.heavy.where("not h").select("g"), "g")

    def with_heavy(self, df: DataFrame) -> DataFrame:
        """``df`` with its heavy groups, sorted, in place of all groups; rows without any stay, with an empty list."""
        if not self.n_light:
            return df.withColumn("groups", F.array_sort("groups"))
        if not self.n_heavy:
            return df.withColumn("groups", F.slice("groups", F.lit(1), F.lit(0)))
        own = (df.select("id", F.explode("groups").alias("g")).join(self.heavy.where("h").select("g"), "g")
               .groupBy("id").agg(F.array_sort(F.collect_list("g")).alias("_heavy")))
        return df.join(own, "id", "left").withColumn("groups", F.coalesce("_heavy", F.slice("groups", F.lit(1), F.lit(0)))).drop("_heavy")

    def packed(self, df: DataFrame) -> DataFrame:
        """``df`` with its heavy groups as packed pieces in place of all groups, and their number ``size``; rows without any are left out."""
        kind = df.schema["id"].dataType.simpleString()
        pieces = (df.select("id", F.explode("groups").alias("g")).join(self.numbers, "g")
                  .groupBy("id", F.floor(F.col("no") / PIECE).alias("block")).agg(F.collect_list(F.pmod("no", F.lit(PIECE)).cast("int")).alias("items")))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items = batch.column("items")
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("block"), pack_pieces(items), items.value_lengths().cast(pa.int64())],
                                                 names=["id", "block", "items", "n"])

        sets = (pieces.mapInArrow(pack, f"id {kind}, block bigint, items binary, n bigint").groupBy("id")
                .agg(F.array_sort(F.collect_list(F.struct("block", "items"))).alias("groups"), F.sum("n").alias("size")))
        return df.drop("groups").join(sets, "id")

    def pairs(self) -> DataFrame:
        """(id, label, n): pairs that share n light groups, one at least."""
        l, r = self.members(self.left), self.members(self.right)
        return l.join(r.select("g", F.col("id").alias("label")), "g").groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))


def _tile_rows(df: DataFrame, tile_rows: int, vector: str | None = None) -> int:
    """Rows of a tile, bounded by the bytes of their sets (and vectors, as they are computed with) on average: ids are hashed."""
    each = F.aggregate("groups", F.lit(0).cast("long"), lambda n, x: n + F.length(x["items"]) + 16)
    each = df.agg(F.avg(each + 8 * F.size(vector) if vector else each)).first()[0] or 1
    return max(1, min(tile_rows, int(TILE_BYTES // each)))


def _distinct(keys: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the key of each row, and a row of each key."""
    codes = keys.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, np.unique(codes, return_index=True)[1]


def _sets(df: DataFrame, key: str, groups: str, *keep: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.array_distinct(groups).alias("groups"), *keep).where(F.size("groups") > 0)


def _limit(found: DataFrame, value: str, k: int) -> DataFrame:
    """(id, limit): the k-th best value of each id that has so many rows."""
    w = Window.partitionBy("id").orderBy(F.desc(value), "label")
    return found.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == k).select("id", F.col(value).cast("double").alias("limit"))


def cooccurring_by_group(targets: DataFrame, skills: DataFrame, min_shared: int = 1, k: int = 10, tile_rows: int = 8192, light: int = LIGHT) -> DataFrame:
    """(target, label, shared, rank): other labels by number of shared occupations; ties by label.

    Inputs: label, occupations. Of labels with equal heavy groups only the first k + 1 by name can be among the k best of a
    target that shares no light group with them, so equal ones are compared once.
    """
    least = max(1, min_shared)
    left = cut_lineage(_sets(targets, "label", "occupations"))
    right = left if targets is skills else cut_lineage(_sets(skills, "label", "occupations"))
    split = Split(left, right, light)
    parts, limits = [], None
    if split.n_light:
        heavy = (lambda df, name: split.with_heavy(df).select(F.col("id").alias(name), F.col("groups").alias(f"_{name}")))
        found = (split.pairs().where("id <> label").join(heavy(left, "id"), "id").join(heavy(right, "label"), "label")
                 .select("id", "label", (F.col("n") + F.size(F.array_intersect("_id", "_label"))).alias("shared")).where(F.col("shared") >= least))
        found = cut_lineage(found)
        parts.append(found)
        limits = _limit(found, "shared", k)
    if split.n_heavy:
        key = F.md5(F.to_json("groups"))
        sets = cut_lineage(split.packed(left).withColumn("key", key))
        rest = sets.withColumn("limit", F.lit(float(least))) if limits is None else sets.join(limits, "id", "left").withColumn(
            "limit", F.greatest(F.coalesce("limit", F.lit(0.0)), F.lit(float(least))))
        reach = rest.where(F.col("size") >= F.col("limit"))
        ours = reach.groupBy("key").agg(F.first("groups").alias("groups"), F.min("limit").alias("limit"))
        theirs = sets if right is left else split.packed(right).withColumn("key", key)
        w = Window.partitionBy("key").orderBy("id")
        theirs = (theirs.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k + 1)
                  .groupBy("key").agg(F.first("groups").alias("groups"), F.collect_list("id").alias("labels")))

        def kernel(l: pa.Table, r: pa.Table) -> pa.Table:
            rows, cols, n = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            names = nested(r, "labels")
            flat = np.array([x for some in names for x in some], dtype=object)
            order = np.argsort(flat, kind="stable")
            owner = np.repeat(np.arange(len(r)), [len(x) for x in names])[order]
            if len(l) and len(flat):
                count, limit = packed_counts(l["groups"], r["groups"]), np.asarray(l["limit"])
                for part in chunks(len(l), len(flat)):
                    s = count(part)
                    s[s < limit[part][:, None]] = -np.inf
                    s = s[:, owner]
                    a, b = best_k(s, k + 1)
                    rows.append(a + part.start), cols.append(order[b]), n.append(s[a, b].astype(np.int64))
            return pa.table({"key": l["key"].take(pa.array(np.concatenate(rows))), "label": pa.array(flat[np.concatenate(cols)], pa.string()), "shared": pa.array(np.concatenate(n))})

        ours, theirs = cut_lineage(ours), cut_lineage(theirs)
        best = tiled(ours, "key", theirs, "key", kernel, "key string, label string, shared bigint", min(_tile_rows(ours, tile_rows), _tile_rows(theirs, tile_rows)))
        w = Window.partitionBy("key").orderBy(F.desc("shared"), "label")
        best = best.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k + 1)
        parts.append(reach.select("id", "key").join(best, "key").where("id <> label").select("id", "label", "shared"))
    if not parts:
        parts = [left.select("id", F.col("id").alias("label"), F.lit(0).cast("long").alias("shared")).limit(0)]
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).groupBy("id", "label").agg(F.max("shared").alias("shared"))
    w = Window.partitionBy("target").orderBy(F.desc("shared"), "label")
    return out.withColumnRenamed("id", "target").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _distance(vectors: np.ndarray, positives: list | None, shared: np.ndarray, n_words: int, their_words: np.ndarray) -> np.ndarray:
    if positives is not None:
        m = np.asarray(positives, dtype=float).reshape(-1, vectors.shape[1])
        length = np.linalg.norm(m, axis=1, keepdims=True)
        m = np.divide(m, length, out=m.copy(), where=length > 0)
        return 1 - np.round(m @ vectors.T, DIGITS).max(axis=0)
    return 1 - shared / np.maximum(1, np.maximum(n_words, their_words))


def _score(groups: np.ndarray, distance: np.ndarray, shared_words: np.ndarray, covered: np.ndarray) -> np.ndarray:
    s = (SHARED_WEIGHT * groups + np.where(distance >= MIN_DISTANCE, np.minimum(DISTANCE_WEIGHT * distance, MOST_DISTANCE), 0)
         + np.where(shared_words <= 1, FEW_WORDS, 0.0) + np.where(covered, COVERED, 0.0))
    s = np.round(s, DIGITS)
    s[shared_words > MOST_WORDS] = -np.inf
    return s


#: Most that a pair can get beside its shared groups.
BESIDE = MOST_DISTANCE + FEW_WORDS + COVERED


def group_hard_negatives(targets: DataFrame, skills: DataFrame, covered: DataFrame, n: int = 2,
                         use_vectors: bool = False, tile_rows: int = 8192, light: int = LIGHT) -> DataFrame:
    """(target_id, label, score, rank): labels that share an occupation with the positives but mean something else.

    ``targets``: target_id, positives; ``skills``: label, occupations[, vector]; ``covered``: label. Score =
    2 x shared occupations + min(5 x distance, 3) from distance 0.63 + 1 for at most one shared word + 0.5 when
    covered; more than 2 shared words rule a label out. Distance = 1 - max similarity, or 1 - shared / larger word set.
    Words and distances are worked out only for pairs whose shared occupations can still bring them among the n best; shared occupations are counted once for all
    targets and labels with equal (heavy) ones, and labels are tried from the highest score that they can have down.
    """
    split = (lambda c: F.array_distinct(words(F.lower(c))))
    vector = ["vector"] if use_vectors else []
    docs = skills.join(covered.select("label", F.lit(True).alias("_c")).distinct(), "label", "left").select(
        F.col("label").alias("id"), F.array_distinct("occupations").alias("groups"), split(F.col("label")).alias("words"), F.col("_c").isNotNull().alias("covered"), *vector).where(F.size("groups") > 0)
    lex = targets.select("target_id", "positives", split(F.array_join("positives", " ")).alias("words"))
    per = targets.select("target_id", F.explode("positives").alias("label")).join(
        skills.select("label", "occupations", *vector), "label")
    union = per.groupBy("target_id").agg(
        F.array_distinct(F.flatten(F.collect_list("occupations"))).alias("groups"),
        *([F.flatten(F.collect_list("vector")).alias("pv")] if use_vectors else []))
    left = cut_lineage(lex.join(union, "target_id").where(F.size("groups") > 0).withColumnRenamed("target_id", "id"))
    right = cut_lineage(docs)
    id_type = left.schema["id"].dataType.simpleString()
    parts = Split(left.select("id", "groups"), right.select("id", "groups"), light)
    found = limits = None
    if parts.n_light:
        theirs = parts.with_heavy(right).select(F.col("id").alias("label"), F.col("groups").alias("_g"), F.col("words").alias("_w"), "covered", *vector)
        pairs = parts.pairs().join(parts.with_heavy(left), "id").join(theirs, "label").where(~F.array_contains("positives", F.col("label")))
        pairs = pairs.select("id", "label", (F.col("n") + F.size(F.array_intersect("groups", "_g"))).alias("o"), F.size(F.array_intersect("words", "_w")).alias("w"),
                             F.size("words").alias("nw"), F.size("_w").alias("mw"), "covered", *(["pv", "vector"] if use_vectors else []))

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                t = pa.table(batch)
                o, w, nw, mw = (np.asarray(t[c], dtype=float) for c in ("o", "w", "nw", "mw"))
                if use_vectors:
                    m = matrix(t, "vector")
                    dist = np.concatenate([_distance(m[i:i + 1], p, None, 0, None) for i, p in enumerate(t["pv"].to_pylist())])
                else:
                    dist = 1 - w / np.maximum(1, np.maximum(nw, mw))
                s = _score(o, dist, w, np.asarray(t["covered"]))
                kept = pa.array(np.isfinite(s))
                yield pa.RecordBatch.from_arrays([batch.column("id").filter(kept), batch.column("label").filter(kept), pa.array(s).filter(kept)], names=["id", "label", "score"])

        found = cut_lineage(pairs.mapInArrow(judge, f"id {id_type}, label string, score double"))
        limits = _limit(found, "score", n)
    out = found
    if parts.n_heavy:
        lowest, rest, key = F.lit(float("-inf")), parts.packed(left), F.md5(F.to_json("groups"))
        rest = rest.withColumn("limit", lowest) if limits is None else rest.join(limits, "id", "left").withColumn("limit", F.coalesce("limit", lowest))
        reach = cut_lineage(rest.where(SHARED_WEIGHT * F.col("size") + BESIDE >= F.col("limit"))
                            .select("id", "positives", "words", "groups", key.alias("key"), "limit", *(["pv"] if use_vectors else [])))
        docs = cut_lineage(parts.packed(right).drop("size").withColumnRenamed("id", "label").withColumn("key", key))

        def kernel(l: pa.Table, r: pa.Table) -> pa.Table:
            rows, cols, sc = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
            if len(l) and len(r):
                r = r.sort_by("label")
                at = {x: i for i, x in enumerate(r["label"].to_pylist())}
                ours, theirs = nested(l, "words"), [set(x) for x in nested(r, "words")]
                n_theirs, is_covered = np.array([len(x) for x in theirs]), np.asarray(r["covered"])
                limit, own = np.asarray(l["limit"]), nested(l, "positives")
                vectors, flat = (matrix(r, "vector"), l["pv"]) if use_vectors else (None, None)
                mine, first = _distinct(l["key"])
                their, rest = _distinct(r["key"])
                occ = packed_counts(l["groups"].take(pa.array(first)), r["groups"].take(pa.array(rest)))
                most = MOST_DISTANCE + FEW_WORDS + COVERED * is_covered  # what each label can get beside its shared groups
                order = np.argsort(mine, kind="stable")
                begin = np.searchsorted(mine[order], np.arange(len(first) + 1))

                def scores(i: int, some: np.ndarray, o: np.ndarray) -> np.ndarray:
                    have = set(ours[i])
                    w = np.array([len(have & theirs[j]) for j in some.tolist()], dtype=float)
                    dist = _distance(vectors[some] if use_vectors else None, flat[i].as_py() if use_vectors else None, w, len(have), n_theirs[some])
                    return _score(o, dist, w, is_covered[some])

                def best(i: int, o: np.ndarray, levels: Callable[[], Iterator[tuple[float, np.ndarray]]]) -> tuple[np.ndarray, np.ndarray]:
                    """(score, column) of the n best, from levels of columns that can get as much, highest first; a level ends where nothing behind can be among the best."""
                    s, c, left_out = np.empty(0), np.empty(0, np.int64), [at[x] for x in own[i] if x in at]
                    for bound, some in levels():
                        if bound < limit[i] or len(s) == n and bound < s[-1]:
                            break
                        low, step = 0, 16 * n
                        while low < (len(some) if len(s) < n or bound > s[-1] else np.searchsorted(some, c[-1]) if bound == s[-1] else 0):
                            part = some[low:low + step]
                            low, step = low + step, min(2 * step, 8192)
                            for x in left_out:
                                part = part[part != x]
                            if len(part):
                                s, c = np.concatenate([s, scores(i, part, o[part])]), np.concatenate([c, part])
                                top = np.lexsort((c, -s))[:n]
                                top = top[np.isfinite(s[top])]
                                s, c = s[top], c[top]
                    return s, c

                for part in chunks(len(first), len(rest)):
                    for k, counts in enumerate(occ(part)):
                        o = counts.astype(float)[their]  # the same for all rows with these groups
                        reach = np.where(o >= 1, SHARED_WEIGHT * o + most, -np.inf)
                        values = np.unique(reach, return_counts=True)[0][::-1]
                        known: dict[float, np.ndarray] = {}

                        def levels() -> Iterator[tuple[float, np.ndarray]]:
                            for value in values[np.isfinite(values)].tolist():
                                if value not in known:
                                    known[value] = np.flatnonzero(reach == value)
                                yield value, known[value]

                        for i in order[begin[part.start + k]:begin[part.start + k + 1]].tolist():
                            s, c = best(i, o, levels)
                            rows.append(np.full(len(c), i)), cols.append(c), sc.append(s)
            return pa.table({"id": l["id"].take(pa.array(np.concatenate(rows))),
                             "label": r["label"].take(pa.array(np.concatenate(cols))), "score": pa.array(np.concatenate(sc))})

        heavy = tiled(reach, "id", docs, "label", kernel, f"id {id_type}, label string, score double",
                      (_tile_rows(reach, tile_rows), _tile_rows(docs, LABEL_ROWS * tile_rows, "vector" if use_vectors else None)))
        out = heavy if found is None else found.unionByName(heavy).groupBy("id", "label").agg(F.max("score").alias("score"))
    if out is None:
        out = left.select("id", F.lit("").alias("label"), F.lit(0.0).alias("score")).limit(0)
    w = Window.partitionBy("target_id").orderBy(F.desc("score"), "label")
    return out.withColumnRenamed("id", "target_id").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
