"""Phrase collocation mining: exact n-gram counts in counting quotient filters, scored by their weakest cut.

A word's id is a 64-bit hash of language and word. Each task packs its n-grams into quotient filters (module ``quotient``) and hands on one sorted, counted block for
each shard of the key space, so a common phrase is one counter for each task whatever its count. Shards are merged as sorted filters, one at a time.
Lengths follow each other: an n-gram is counted only if both its parts of one word less are frequent, since it cannot occur more often than these. Tasks
ask a Bloom filter of at most 16 MB for that; what it lets through in error is counted exactly and then fails the limit, so the bound costs work, not results.

Ids are checked: all words behind a frequent id are looked up, and should two share it, they get ids of another hash and counting begins anew.
Scoring is a handful of joins on frequent phrases only.

Null and empty texts have no words; null languages read as ``und``. Repeated rows count again; ties are broken by the phrase in byte order. Empty tables give no
rows. Other columns are not read, so their names cannot clash. Long texts are worked on whole.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from labelloom.llm import bloom, quotient
from labelloom.llm.common import arrow, chunks, column
from labelloom.llm.words import Words, mix
from labelloom.session import cut_lineage

LEAST, LONGEST, SHARE, TOP = 30, 4, 80, 2000
#: n-grams that a task gathers before it counts them, and different ones that it holds before it hands them on.
PENDING, HELD = 1 << 21, 1 << 22
#: Parts that a language's phrases are ranked in before they are ranked together.
PARTS = 64

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PIECE = np.zeros(256, bool)
_PIECE[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_WORD = ~_PIECE
_WORD[[9, 32]] = False


def word_ids(batch: pa.RecordBatch, shared: np.ndarray) -> Iterator[tuple[Words, np.ndarray, np.ndarray, list[str]]]:
    """(words, ids, whether the next word follows in the same piece, language of each text) of runs of texts. Ids in ``shared`` are replaced by those of another hash."""
    langs = [x if x is not None else "und" for x in column(batch, "lang").to_pylist()]
    seeds = {x: xxhash.xxh64_intdigest(x.encode()) for x in set(langs)}
    seed = np.array([seeds[x] for x in langs], np.uint64)
    for i, data, offsets in chunks(column(batch, "text")):
        words = Words(data, offsets, _WORD, _FOLD)
        ids = mix(words.h ^ seed[i + words.doc])
        for j in np.flatnonzero(np.isin(ids, shared)).tolist() if len(shared) else ():
            ids[j] = xxhash.xxh3_64_intdigest(langs[i + int(words.doc[j])].encode() + b"\0" + words.text(j))
        piece = np.cumsum(_PIECE[data])[words.start]
        yield words, ids, (words.doc[1:] == words.doc[:-1]) & (piece[1:] == piece[:-1]), langs[i:i + words.n_docs]


def grams(ids: np.ndarray, follows: np.ndarray, n: int, sieve: bloom.Filter | None) -> list[np.ndarray]:
    """Permuted lanes of the n-grams within pieces both of whose parts of one word less are in ``sieve``."""
    size = len(ids) - n + 1
    if n == 1 or size <= 0:
        return quotient.permute([ids[:max(0, size)]] * n)
    within = np.ones(size + 1, bool)  # parts of n - 1 words
    for k in range(n - 2):
        within &= follows[k:k + size + 1]
    at = np.flatnonzero(within)
    within[at] = sieve.has(0, quotient.permute([ids[at + k] for k in range(n - 1)])[0])
    at = np.flatnonzero(within[:-1] & within[1:] & follows[:size])
    return quotient.permute([ids[at + k] for k in range(n)])


def second_hash(words: Words) -> np.ndarray:
    """Another hash of every word, of a different kind than its id."""
    if not len(words):
        return np.zeros(0, np.uint64)
    sizes = words.end - words.start
    first = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    data = words.data[within + np.repeat(words.start, sizes)]
    return np.add.reduceat(mix(within.astype(np.uint64) + np.uint64(77)) * (mix(data.astype(np.uint64) + np.uint64(5)) | np.uint64(1)), first)


def shard_bits(df: DataFrame) -> int:
    """As many shards as the session has shuffle partitions, up to a power of two."""
    return max(0, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def blocks(docs: DataFrame, n: int, known: bloom.Filter | None, shared: np.ndarray, bits: int) -> DataFrame:
    """(shard, block) of packed filters. For n = 1 also rows (lang, words) without a shard: how many words each task has seen."""
    known = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[list[np.ndarray]] = []
        runs: list[tuple[list[np.ndarray], np.ndarray]] = []
        seen: dict[str, int] = {}

        def settle() -> None:
            if pending:
                runs.append(quotient.combine([np.concatenate(lane) for lane in zip(*pending)]))
                pending.clear()

        def out() -> Iterator[pa.RecordBatch]:
            lanes, counts = quotient.merge(runs)
            bounds = quotient.shard_bounds(lanes[0], bits)
            for s in np.flatnonzero(np.diff(bounds)).tolist():
                a, b = int(bounds[s]), int(bounds[s + 1])
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([quotient.pack([lane[a:b] for lane in lanes], counts[a:b], bits)], pa.binary()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], names=names)
            runs.clear()

        names = ["shard", "block", "lang", "words"]
        waiting = 0
        for batch in batches:
            for words, ids, follows, langs in word_ids(batch, shared):
                if n == 1:
                    for lang, size in zip(langs, np.diff(words.first).tolist()):
                        seen[lang] = seen.get(lang, 0) + size
                lanes = grams(ids, follows, n, known.value)
                pending.append(lanes)
                waiting += len(lanes[0])
                if waiting > PENDING:
                    settle()
                    waiting = 0
                    if len(runs) > 1 and sum(len(r[1]) for r in runs) > HELD:
                        runs[:] = [quotient.merge(runs)]
                        if len(runs[0][1]) > HELD // 2:
                            yield from out()
        settle()
        if runs:
            yield from out()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(seen), pa.int32()), pa.nulls(len(seen), pa.binary()), pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=names)

    return arrow(docs.select("lang", "text"), run, "shard int, block binary, lang string, words long")


def merged(rows: DataFrame, n: int, bits: int, least: int) -> DataFrame:
    """(w, f, lang): the ids of every n-gram that occurs ``least`` times or more, and its count. One shard is held at a time. Rows without a shard pass as (null, words, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[list[np.ndarray], np.ndarray]] = []
        now, fresh = None, 0
        names = ["w", "f", "lang"]

        def out() -> Iterator[pa.RecordBatch]:
            if parts:
                lanes, counts = quotient.merge(parts)
                parts.clear()
                kept = counts >= least
                lanes = quotient.restore([lane[kept] for lane in lanes])
                w = pa.ListArray.from_arrays(pa.array(np.arange(len(lanes[0]) + 1, dtype=np.int32) * n), pa.array(np.stack(lanes, 1).ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([w, pa.array(counts[kept]), pa.nulls(len(w), pa.string())], names=names)

        for batch in batches:
            totals = batch.filter(batch.column("shard").is_null())
            if len(totals):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(totals), pa.list_(pa.int64())), totals.column("words"), totals.column("lang")], names=names)
            packed = batch.filter(batch.column("shard").is_valid())
            for shard, data in zip(packed.column("shard").to_pylist(), packed.column("block")):
                if shard != now:
                    yield from out()
                    now, fresh = shard, 0
                parts.append(quotient.unpack(data.as_py(), shard, bits, n))
                fresh += len(parts[-1][1])
                if fresh > HELD:
                    parts[:] = [quotient.merge(parts)]
                    fresh = 0
        yield from out()

    return arrow(rows.repartition("shard").sortWithinPartitions("shard"), run, "w array<long>, f long, lang string")


def sieve(frequent: DataFrame, n: int) -> bloom.Filter:
    def hashed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        flat = batch.column(0).flatten().to_numpy().view(np.uint64).reshape(-1, n)
        yield 0, quotient.permute([flat[:, k] for k in range(n)])[0]

    return bloom.build(frequent.select("w"), hashed, {0: frequent.count()})


def named(docs: DataFrame, known: bloom.Filter, shared: np.ndarray) -> DataFrame:
    """(id, lang, word, last): language and word behind each id that may be frequent; ``last`` differs from (lang, word) where two share an id."""
    known = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = np.zeros(0, np.uint64)
        for batch in batches:
            for words, ids, _, langs in word_ids(batch, shared):
                check = mix(second_hash(words)) + ids  # words that share an id differ in this
                first = np.unique(check, return_index=True)[1]
                first = first[known.value.has(0, quotient.permute([ids[first]])[0])]
                first = first[~np.isin(check[first], done)]
                done = np.concatenate([done, check[first]])
                if len(first):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[first].view(np.int64)), pa.array([langs[int(d)] for d in words.doc[first]], pa.string()), pa.array([words.text(j).decode() for j in first.tolist()], pa.string())], names=["id", "lang", "word"])
                if len(done) > HELD:
                    done = done[:0]

    pair = F.struct("lang", "word")
    return arrow(docs.select("lang", "text"), run, "id long, lang string, word string").groupBy("id").agg(F.min(pair).alias("one"), F.max(pair).alias("last")).select("id", "one.lang", "one.word", "last")


def frequent(docs: DataFrame, least: int, longest: int, shared: np.ndarray) -> tuple[DataFrame, DataFrame, bloom.Filter]:
    """(m, w, f) of all frequent phrases of 1 to ``longest`` words, (lang, n) of all words, and the filter of frequent words. Each length is kept in the folder of ``spark.checkpoint.dir``."""
    bits = shard_bits(docs)
    found, totals, words, known = None, None, None, None
    for m in range(1, longest + 1):
        kept = cut_lineage(merged(blocks(docs, m, known, shared, bits), m, bits, least))
        if m == 1:
            totals = kept.filter("w is null").groupBy("lang").agg(F.sum("f").alias("n"))
        kept = kept.filter("w is not null").select(F.lit(m).alias("m"), "w", "f")
        known = sieve(kept, m)
        words = words or known
        found = kept if found is None else found.union(kept)
    return found, totals, words


def scored(found: DataFrame) -> DataFrame:
    """(w, a, l, r, score) of each phrase of two words or more, by its lowest-scoring cut; the least cut of equal ones."""
    cuts = found.filter("m >= 2").select("w", F.col("f").alias("a"), "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("w", "a", "k", F.slice("w", F.lit(1), F.col("k")).alias("first"), F.slice("w", F.col("k") + 1, F.col("m") - F.col("k")).alias("rest"))
    cuts = cuts.join(found.select(F.col("w").alias("first"), F.col("f").alias("l")), "first").join(found.select(F.col("w").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = cuts.select("w", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("w").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    return lowest.select("w", "a", "cut.l", "cut.r", "cut.score")


def covered(found: DataFrame, longest: int) -> DataFrame:
    """(w, top): phrases of two words or more inside longer ones, and the most that one of these occurs."""
    pieces = [F.slice("w", i + 1, size) for size in range(2, longest) for i in range(longest - size + 1)]
    sizes = [(i, size) for size in range(2, longest) for i in range(longest - size + 1)]
    inside = F.array(*[F.when(F.col("m") >= i + size, p) for (i, size), p in zip(sizes, pieces)])
    longer = found.filter("m >= 3").select("m", "f", F.explode(inside).alias("w")).filter(F.col("w").isNotNull() & (F.size("w") < F.col("m")))
    return longer.groupBy("w").agg(F.max("f").alias("top"))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the best ``top`` phrases of 2 to ``longest`` words."""
    shared = np.zeros(0, np.uint64)
    while True:
        found, totals, words = frequent(docs, least, longest, shared)
        names = cut_lineage(named(docs, words, shared))
        # ids of two words, expected none: at 10^8 frequent words and 10^10 others about one in twenty runs has a pair
        clash = names.filter(F.struct("lang", "word") != F.col("last")).join(found.filter("m = 1").select(F.col("w")[0].alias("id")), "id", "left_semi").select("id").toArrow().column("id").to_numpy().view(np.uint64)
        if not len(clash):
            break
        shared = np.union1d(shared, clash)
    names = names.select("id", "lang", "word")
    kept = scored(found)
    if longest > 2:
        kept = kept.join(covered(found, longest), "w", "left").filter(F.col("top").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("top").cast("decimal(19,0)") < F.lit(share).cast("decimal(3,0)") * F.col("a").cast("decimal(19,0)")))
    kept = kept.join(names.select(F.col("id").alias("first"), "lang"), F.col("w")[0] == F.col("first")).drop("first", "top")
    order = [F.col("score").desc(), F.col("a").desc()]
    # first inside parts of a language, so that the last task of a language gets ``top`` rows a part and not a task
    for parts in ([F.pmod(F.hash("w"), F.lit(PARTS))], []):
        kept = kept.withColumn("place", F.rank().over(Window.partitionBy("lang", *parts).orderBy(*order))).filter(F.col("place") <= top)
    spelled = kept.select("w", F.posexplode("w").alias("i", "id")).join(names.select("id", "word"), "id").groupBy("w").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    kept = kept.join(spelled, "w").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).filter(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
