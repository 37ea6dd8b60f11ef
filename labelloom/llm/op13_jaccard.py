"""N-gram Jaccard join: T-occurrence search with DivideSkip over inverted lists, in blocks that candidates share.

Two sets link at 100 * |x & y| >= 80 * |x | y|, so y must stand in at least T = 4/5 |x| of the inverted lists of x. Spark finds out first which sets may meet at all, then
each block searches its own inverted lists:

1. One narrow pass gives size and digest of each set, and the shingles that are frequent in a batch. Copies become one node. At most 65,536 shingles, those in more than
   that share of all sets, are heavy; their table is the only thing about shingles that is broadcast.
2. Sets that link share a shingle among their first |x| - T + 1 in any fixed order. The order is: a sampled 5/16 of the key space, the rest, heavy ones; inside each by number of
   sets. So most sets hand on only their sampled shingles, which are dealt by shingle (heavy ones salted); those that stand alone end there. What is left of the first
   ones joins sets to their shingle's least set: a chain of candidates, one row for each posting and never a pair.
3. The sets of a chain, found by a Bloom filter and an equi-join, go whole to one block; a chain above ``block`` shingles is dealt into several, by bands of size
   (linked sets are in the same or the next band) and by digest, and each set visits the blocks that its partners can be in.
4. In a block, the lists of x are split as DivideSkip does: the long ones are put aside, the short ones merged, who occurs T - L times is probed in the long ones by binary search, and the
   exact bound decides. For classes, a block hands on a forest of its links, and sets that already hang together are not probed again.

Shingles are 64-bit hashes; sets are told apart by 128 bits. Null and empty texts and texts without words: empty set, no links. Fewer than five words: one shingle of
all. Null doc_id: takes part, and names no component unless nothing else does, then it is null. Repeated rows get equal results. Empty tables give no rows. Only
id and text are read, so other names cannot clash. Lists are never cut; a block in which all sets resemble each other costs the square of its sets.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from labelloom.llm import bloom
from labelloom.llm.common import arrow, chunks, column
from labelloom.llm.graph import components
from labelloom.llm.words import Words, mix, powers, _B
from labelloom.session import cut_lineage

SIZE, HEAVY = 5, 1 << 16
#: Shingles that the index of one block holds, unless a single set has more.
BLOCK = 1 << 21
#: Weight of a probe against a merge step in the number of long lists.
MU = 0.01

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False


def required(n: int) -> int:
    """Shingles that any partner shares with a set of n: partners have 4/5 n at least, and all of these are shared."""
    return -(-4 * n // 5)


def sets(array: pa.Array, k: int = SIZE) -> Iterator[np.ndarray]:
    """Sorted shingle hashes of each text."""
    for _, data, offsets in chunks(array):
        words = Words(data, offsets, _WORD, _FOLD)
        hashes, _ = words.shingles(k)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if b - a >= k:
                yield np.unique(hashes[a:b - k + 1])
            elif b > a:  # all words as one; its length goes in, so that it differs from shingles of k words
                yield mix(np.array([(words.h[a:b] * powers(_B, k + 1)[1:b - a + 1]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
            else:
                yield hashes[:0]


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def mark(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def parsed(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest, mark, null, null) of every row, and (null, null, null, null, token, seen) of shingles that are frequent in a batch."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("mark", T.LongType()), T.StructField("token", T.LongType()), T.StructField("seen", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = list(sets(column(batch, "text")))
            size = len(some)
            keys = [digest(s) for s in some]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array([len(s) for s in some], pa.int64()), pa.array(keys, pa.binary()), pa.array([mark(k) for k in keys], pa.int64()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64())], names=schema.names)
            if size:
                tokens, seen = np.unique(np.concatenate(some), return_counts=True)
                kept = seen > max(1, int(seen.sum()) // (2 * HEAVY))
                n = int(kept.sum())
                yield pa.RecordBatch.from_arrays([pa.nulls(n, batch.schema.field("doc_id").type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.array(tokens[kept].view(np.int64)), pa.array(seen[kept])], names=schema.names)

    return arrow(docs.select("doc_id", "text"), run, schema)


def heavy(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted heavy shingles and how many sets have them; fewer than HEAVY by the bound."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    got = rows.filter("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).filter(F.col("seen") > max(2, total // HEAVY)).toArrow()
    tokens, seen = got.column("token").to_numpy().view(np.uint64), got.column("seen").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], seen[order]


def postings(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, salt, mark, spare, df): shingles among which the first ones of a set are. ``spare`` tells how many of the last class needed are not (-1: token of an earlier class); ``df`` is known for heavy tokens only, else 0."""
    hot = docs.sparkSession.sparkContext.broadcast(hot)
    deal = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen = hot.value
        done: set[bytes] = set()  # copies in a task say the same again
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            if len(done) > 1_000_000:
                done.clear()
            for s in sets(column(batch, "text")):
                key = digest(s)
                if not len(s) or key in done:
                    continue
                done.add(key)
                first = len(s) - required(len(s)) + 1
                at = np.minimum(np.searchsorted(tokens, s), max(0, len(tokens) - 1))
                known = tokens[at] == s if len(tokens) else np.zeros(len(s), bool)
                kind = np.where(known, 2, s >> np.uint64(60) >= 5)
                last = int(np.searchsorted(np.cumsum(np.bincount(kind, minlength=3)), first))
                kept = np.flatnonzero(kind <= last)
                df = np.where(kind[kept] == 2, seen[at[kept]] if len(seen) else 0, 0)
                name = mark(key)
                # as many salts as would be tasks for these many rows
                salt = np.where(df > 0, name % np.maximum(1, df * deal // max(1, int(seen.sum()))), 0)
                out.append((s[kept].view(np.int64), salt, np.full(len(kept), name), np.where(kind[kept] == last, len(kept) - first, -1), df))
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1].astype(np.int32)), *[pa.array(c) for c in cols[2:]]], names=["token", "salt", "mark", "spare", "df"])

    return arrow(docs.select("text"), run, "token long, salt int, mark long, spare long, df long")


def shared(rows: DataFrame) -> DataFrame:
    """(token, mark, spare, df) of the postings whose token stands in more than one set. Lists are seen in order, one at a time; heavy ones pass as they come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        names = ["token", "mark", "spare", "df"]

        def lists(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            again = np.r_[False, (cols[0][1:] == cols[0][:-1]) & (cols[1][1:] == cols[1][:-1]) & (cols[2][1:] == cols[2][:-1])]  # copies of other tasks
            token, marks, spare, df = (c[~again] for c in cols)
            first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            size = np.diff(np.r_[first, len(token)])
            several = np.minimum.reduceat(marks, first) != np.maximum.reduceat(marks, first)
            kept = np.repeat(several, size) | (df > 0)
            df = np.where(df > 0, df, np.repeat(size, size))
            if kept.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (token, marks, spare, df)], names=names)

        for batch in batches:
            cols = [column(batch, c).to_numpy() for c in names]
            if not len(cols[0]):
                continue
            other = np.flatnonzero(cols[0] != cols[0][-1])
            cut = int(other[-1]) + 1 if len(other) else 0  # the list that is open at the end waits for the next batch
            if held and held[-1][0][-1] != cols[0][0]:
                yield from lists([np.concatenate(c) for c in zip(*held)])
                held.clear()
            if cut:
                yield from lists([np.concatenate(c) for c in zip(*held, [c[:cut] for c in cols])])
                held.clear()
            rest = [c[cut:] for c in cols]
            if rest[3][0] > 0:  # heavy: nothing to wait for
                yield from lists(rest)
            else:
                held.append(rest)
        if held:
            yield from lists([np.concatenate(c) for c in zip(*held)])

    return arrow(rows.repartition("token", "salt").sortWithinPartitions("token", "mark", "spare"), run, "token long, mark long, spare long, df long")


def chains(rows: DataFrame) -> DataFrame:
    """(mark, root): sets that may link, directly or over others. ``rows`` are shared postings; each token's least set stands for its list, so no pairs arise."""
    place = F.dense_rank().over(Window.partitionBy("mark", "spare").orderBy(F.col("df").desc(), F.col("token").desc()))  # a copy may still bring an equal row
    firsts = cut_lineage(rows.withColumn("place", place).filter("spare < 0 or place > spare").select("token", "mark"))
    least = firsts.groupBy("token").agg(F.min("mark").alias("b"))
    edges = firsts.join(least, "token").filter("mark <> b").select(F.col("mark").alias("a"), "b").distinct()
    return components(edges).select(F.col("node").alias("mark"), "root")


def candidates(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(mark, digest, n, tokens): the sets of texts whose mark is (or seems to be) among ``members``; of copies in a task one."""
    def hashed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        yield 0, column(batch, "mark").to_numpy().view(np.uint64)

    sieve = docs.sparkSession.sparkContext.broadcast(bloom.build(members.select("mark"), hashed, {0: members.count()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for batch in batches:
            some = [(digest(s), s) for s in sets(column(batch, "text")) if len(s)]
            marks = np.array([mark(d) for d, _ in some], np.int64)
            kept = []
            for i in np.flatnonzero(sieve.value.has(0, marks.view(np.uint64))).tolist():
                if some[i][0] not in done:
                    done.add(some[i][0])
                    kept.append(i)
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(marks[kept]), pa.array([some[i][0] for i in kept], pa.binary()), pa.array([len(some[i][1]) for i in kept], pa.int64()), pa.array([some[i][1].tobytes() for i in kept], pa.binary())], names=["mark", "digest", "n", "tokens"])
            if len(done) > 1_000_000:
                done.clear()

    return arrow(docs.select("text"), run, "mark long, digest binary, n long, tokens binary").join(members, "mark")


def band(n: Column) -> Column:
    """Bands of size grow by 1.26, more than the 1.25 that linked sets may differ by."""
    return F.floor(F.log(n.cast("double")) / math.log(1.26)).cast("int")


def dealt(rows: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """(root, band, piece, guest, digest, tokens): each set in its own block, and as guest in the blocks where partners can be that it does not meet otherwise. ``sizes``: root and n of the sets."""
    pieces = sizes.groupBy("root", band(F.col("n")).alias("band")).agg(F.ceil(F.sum("n") / block).cast("int").alias("pieces"))
    after = pieces.select("root", (F.col("band") - 1).alias("band"), F.col("pieces").alias("after"))
    grid = cut_lineage(pieces.join(after, ["root", "band"], "left"))  # so that the join below deals its sides itself and may split a crowded chain
    rows = rows.withColumn("band", band(F.col("n"))).join(grid, ["root", "band"])
    own = F.pmod(F.hash("digest"), F.col("pieces"))
    here = F.transform(F.sequence(own, F.col("pieces") - 1), lambda p: F.struct(F.col("band").alias("band"), p.alias("piece"), (p > own).alias("guest")))
    there = F.when(F.col("after").isNotNull(), F.transform(F.sequence(F.lit(0), F.col("after") - 1), lambda p: F.struct((F.col("band") + 1).alias("band"), p.alias("piece"), F.lit(True).alias("guest"))))
    visits = F.concat(here, F.coalesce(there, F.array().cast("array<struct<band:int,piece:int,guest:boolean>>")))
    return rows.select("root", "digest", "tokens", F.explode(visits).alias("v")).select("root", "v.band", "v.piece", "v.guest", "digest", "tokens")


class Lists:
    """Inverted lists of the sets of a block, each in the order of sets."""

    def __init__(self, members: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in members], np.int64)
        tokens = np.concatenate(members)
        owner = np.repeat(np.arange(len(members), dtype=np.uint64), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order].astype(np.int64)
        self.first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        self.tokens = tokens[self.first]
        self.length = np.diff(np.r_[self.first, len(tokens)])
        #: (list, set) as one sorted number, for binary search in any list
        self.key = np.repeat(np.arange(len(self.first), dtype=np.int64), self.length) << 32 | self.owner

    def search(self, s: np.ndarray, wanted: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
        """Sets that link with ``s``. ``wanted`` may exclude some before they are probed."""
        n, least = len(s), required(len(s))
        at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
        at = at[self.tokens[at] == s]
        if len(at) < least:
            return at[:0]
        at = at[np.argsort(self.length[at], kind="stable")]
        aside = min(least - 1, int(least / (MU * math.log2(self.length[at[-1]] + 1) + 1)))
        short, long = at[:len(at) - aside], at[len(at) - aside:]
        length = self.length[short]
        ends = np.cumsum(length)
        found, count = np.unique(self.owner[np.repeat(self.first[short] - ends + length, length) + np.arange(ends[-1])], return_counts=True)
        need = -(-4 * (n + self.sizes[found]) // 9)
        kept = (count >= least - aside) & (count + aside >= need)
        if wanted is not None:
            kept &= wanted(found)
        found, count, need = found[kept], count[kept], need[kept]
        for low in range(0, len(long), step := max(1, (1 << 20) // max(1, len(found)))):
            asked = (long[low:low + step, None] << 32) | found
            count += (self.key[np.minimum(np.searchsorted(self.key, asked), len(self.key) - 1)] == asked).sum(0)
        return found[count >= need]


def linked(rows: DataFrame, every: bool = False) -> DataFrame:
    """(a, b) by digest: links that hang the sets of each block together, or ``every`` link. The index of one block is held at a time, guests pass by."""
    keys = ["root", "band", "piece"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, members, lists, label, last = None, [], [], None, None, None
        out: list[tuple[bytes, bytes]] = []

        def link(name: bytes, s: np.ndarray, me: int | None) -> None:
            if every:
                out.extend((name, names[j]) for j in lists.search(s, None if me is None else lambda some: some > me).tolist())
                return
            found = lists.search(s, None if me is None else lambda some: label[some] != label[me])
            groups, first = np.unique(label[found], return_index=True)
            out.extend((name, names[j]) for j in found[first].tolist())
            if len(groups):
                label[np.isin(label, groups)] = groups[0] if me is None else label[me]

        def index() -> None:
            nonlocal lists, label
            if lists is None and members:
                lists, label = Lists(members), np.arange(len(members))
                for i, (name, s) in enumerate(zip(names, members)):
                    link(name, s, i)

        def batch_of() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], names=["a", "b"])
                out.clear()

        for batch in batches:
            cols = [column(batch, c).to_pylist() for c in (*keys, "guest", "digest")]
            tokens = column(batch, "tokens")
            for i, (*key, guest, name) in enumerate(zip(*cols)):
                if key != now:
                    index()
                    now, names, members, lists, label, last = key, [], [], None, None, None
                if (guest, name) == last:  # a copy
                    continue
                last = (guest, name)
                s = np.frombuffer(tokens[i].as_py(), np.uint64)
                if not guest:
                    names.append(name)
                    members.append(s)
                else:
                    index()
                    if lists is not None:
                        link(name, s, None)
                if len(out) > 10_000:
                    yield from batch_of()
        index()
        yield from batch_of()

    return arrow(rows.repartition(*keys).sortWithinPartitions(*keys, "guest", "digest"), run, "a binary, b binary")


def links(docs: DataFrame, rows: DataFrame, block: int = BLOCK, every: bool = False) -> DataFrame:
    """(a, b): links between different sets, by digest. ``rows`` is the kept result of ``parsed``."""
    members = cut_lineage(chains(shared(postings(docs, heavy(rows)))))
    sizes = rows.filter("n > 0").select("mark", "digest", "n").distinct().join(members, "mark").select("root", "n")
    return linked(dealt(candidates(docs, members), sizes, block), every)


def classes(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row (doc_id, n_shingles, component_id) for each row of ``docs``. Digests, chains and nodes are kept in the folder of ``spark.checkpoint.dir``."""
    rows = cut_lineage(parsed(docs))
    own = rows.filter("digest is not null").select("doc_id", F.col("n").alias("n_shingles"), "digest")
    nodes = cut_lineage(own.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("least")).withColumn("node", F.monotonically_increasing_id()))
    pairs = links(docs, rows, block)
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("digest").alias(side), F.col("node").alias(f"node_{side}")), side)
    trees = components(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    named = nodes.join(trees.withColumnRenamed("root", "tree"), "node", "left").select("digest", "least", F.coalesce("tree", "node").alias("root"))
    whole = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(whole, "root").select("digest", "component_id")
    empty = own.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return own.filter("n_shingles > 0").join(of, "digest").select("doc_id", "n_shingles", "component_id").union(empty)
