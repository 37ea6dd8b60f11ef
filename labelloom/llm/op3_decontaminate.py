"""Benchmark decontamination as a prefix-filtered set join of word shingles.

Every benchmark item is cut into windows of 13 words (a shorter item is one window), and every window into shingles of up to four
words. Shingles are ordered by rarity: how often they occur in all documents. A document can hold a whole window only if it holds each
of its shingles, so joining on the rarest alone (the prefix of that order; of length 1, as containment is exact) loses nothing. Where it occurs in a document,
its offset in the window gives the only possible place; windows that would reach over either end of the text go (length and positional
bounds), the others are compared word by word.

The benchmark is the stated query set. Up to ``block_bytes`` of it are one broadcast, and documents are not shuffled. A larger one is worked on in
blocks of that size, one after the other: each block's hits are kept by digest of the text (checkpoint), its broadcast is given up before the next one,
and the hits of all blocks are joined to the documents at the end. So no process holds more than one block, however large the benchmark. Each text is read whole. Null or empty texts: no words, nothing hit. Items without id or words match nothing. Several rows with one
item_id: their windows belong to that one item. Repeated documents get equal results; other columns pass through.
"""
from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from labelloom.llm.common import annotate, arrow, chunks, column
from labelloom.llm.words import Words
from labelloom.session import cut_lineage

WINDOW, SHINGLE = 13, 4
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True
BITS = 20


def tokens(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, IS_WORD, FOLD)


class Block:
    """Windows of some items. ``keys[k]`` are the sorted hashes of shingles of k words, ``sieve[k]`` marks their upper bits."""

    def __init__(self, items: list[tuple[str, str]], window: int, shingle: int):
        held: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        one: dict[bytes, bytes] = {}  # a word that comes again is held once
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            w = tokens(raw, np.array([0, len(raw)]))
            words = [one.setdefault(x, x) for x in (w.text(i) for i in range(len(w)))]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                held[tuple(words[i:i + window])].add(item)
        self.windows = sorted(held)
        self.items = [sorted(held[x]) for x in self.windows]
        #: (number of words, hashes) of the shingles of each window, in order
        self.shingles: list[tuple[int, np.ndarray]] = []
        for x in self.windows:
            raw = np.frombuffer(b" ".join(x), np.uint8)
            k = min(shingle, len(x))
            self.shingles.append((k, tokens(raw, np.array([0, len(raw)])).shingles(k)[0]))
        self._index({k: np.concatenate([h for kk, h in self.shingles if kk == k]) for k in {kk for kk, _ in self.shingles}})

    def _index(self, keys: dict[int, np.ndarray]) -> None:
        self.keys = {k: np.unique(x) for k, x in keys.items()}
        self.sieve = {}
        for k, x in self.keys.items():
            self.sieve[k] = np.zeros(1 << BITS, bool)
            self.sieve[k][(x >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def occurring(self, w: Words) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(k, places of words in ``w``, number of the key that begins there)."""
        out = []
        for k, keys in self.keys.items():
            h, whole = w.shingles(k)
            at = np.flatnonzero(self.sieve[k][(h >> np.uint64(64 - BITS)).astype(np.int64)] & whole)
            place = np.searchsorted(keys, h[at])
            place[place == len(keys)] = 0
            same = keys[place] == h[at]
            out.append((k, at[same], place[same]))
        return out

    def choose(self, frequency: dict[tuple[int, int], int]) -> None:
        """Keeps of each window the rarest shingle; ties: the smaller hash, then the earlier place."""
        self.postings: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for n, (k, hashes) in enumerate(self.shingles):
            best = min(range(len(hashes)), key=lambda i: (frequency.get((k, int(hashes[i])), 0), int(hashes[i]), i))
            self.postings[k, int(hashes[best])].append((n, best))
        chosen: dict[int, list[int]] = defaultdict(list)
        for k, h in self.postings:
            chosen[k].append(h)
        self._index({k: np.array(x, np.uint64) for k, x in chosen.items()})
        self.lists = {k: [self.postings[k, int(h)] for h in x] for k, x in self.keys.items()}
        del self.shingles, self.postings

    def matches(self, w: Words):
        """(text, first word, words, window) of every occurrence of a window."""
        for k, at, place in self.occurring(w):
            lists = self.lists[k]
            for i, key in zip(at.tolist(), place.tolist()):
                d = int(w.doc[i])
                low, high = int(w.first[d]), int(w.first[d + 1])
                for n, offset in lists[key]:
                    window = self.windows[n]
                    begin = i - offset
                    if begin >= low and begin + len(window) <= high and all(w.text(begin + j) == window[j] for j in range(len(window))):
                        yield d, begin, len(window), n


def ready(docs: DataFrame, rows: DataFrame, window: int, shingle: int, text: str):
    """Broadcast of the windows of ``rows`` (item, text), each with its rarest shingle by the frequencies in all documents."""
    context = docs.sparkSession.sparkContext
    block = Block([(r["item"], r["text"]) for r in rows.toLocalIterator()], window, shingle)
    if not block.windows:
        return None
    shared = context.broadcast(block)

    def count(batches):
        found: dict[int, np.ndarray] = {k: np.zeros(len(x), np.int64) for k, x in shared.value.keys.items()}
        for batch in batches:
            for _, data, offsets in chunks(batch.column(0)):
                for k, _, place in shared.value.occurring(tokens(data, offsets)):
                    found[k] += np.bincount(place, minlength=len(found[k]))
        for k, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.int32()), pa.array(shared.value.keys[k][at].view(np.int64)), pa.array(n[at])], names=["k", "h", "n"])

    counted = arrow(docs.select(text), count, "k int, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n"))
    block.choose({(r["k"], r["h"] & 0xFFFFFFFFFFFFFFFF): r["n"] for r in counted.toLocalIterator()})
    shared.unpersist()
    return context.broadcast(block)


def marked(w: Words, block: Block) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words are hit, and the items of each text that holds one of their windows."""
    edge, names = np.zeros(len(w) + 1, np.int64), defaultdict(set)
    for d, begin, length, n in block.matches(w):
        edge[begin] += 1
        edge[begin + length] -= 1
        names[d].update(block.items[n])
    return np.cumsum(edge)[:len(w)] > 0, names


def spans_of(docs: DataFrame, shared, text: str) -> DataFrame:
    """(key, spans, items) of each different text with a match: digest, first and end word of its hit runs in turn, items. Kept by a checkpoint."""
    def run(batches):
        for batch in batches:
            rows = []
            for first, data, offsets in chunks(batch.column(1)):
                w = tokens(data, offsets)
                hit, names = marked(w, shared.value)
                for d, some in names.items():
                    flags = hit[w.first[d]:w.first[d + 1]]
                    rows.append((batch.column(0)[first + d].as_py(), np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]]))), sorted(some)))
            kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["key", "spans", "items"])

    rows = docs.filter(F.col(text).isNotNull()).select(F.sha2(text, 256).alias("key"), text)
    return cut_lineage(arrow(rows, run, "key string, spans array<long>, items array<string>").dropDuplicates(["key"]))


FIELDS = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType())]


def overlaps(docs: DataFrame, items: DataFrame, text: str = "text", prefix: str = "", window: int = WINDOW, shingle: int = SHINGLE, least: int = 20, block_bytes: int = 4 << 20) -> DataFrame:
    """Appends n_words, n_hit, n_items, items_sha256 and contaminated (``least`` * n_hit >= n_words), with ``prefix`` before the names."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text")).filter("item is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n, shared = max(1, -(-size // block_bytes)), None
    if n == 1:
        shared = ready(docs, rows, window, shingle, text)
        joined = docs
    else:
        kept = None
        for b in range(n):  # one block at a time: what it has found is kept, then its broadcast goes
            block = ready(docs, rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b), window, shingle, text)
            if block is not None:
                found = spans_of(docs, block, text)
                kept = found if kept is None else kept.union(found)
                block.destroy()
        joined = docs.withColumn("__key", F.sha2(text, 256))
        if kept is not None:
            # at most one row of each block for a text
            every = kept.groupBy(F.col("key").alias("__of")).agg(F.flatten(F.collect_list("spans")).alias("__spans"), F.flatten(F.collect_list("items")).alias("__items"))
            joined = joined.join(every, F.col("__key") == F.col("__of"), "left").drop("__of")

    def gathered(w: Words, spans: list, names: list) -> tuple[np.ndarray, dict[int, set[str]]]:
        edge = np.zeros(len(w) + 1, np.int64)
        for d, some in enumerate(spans):
            if some:
                at = int(w.first[d]) + np.array(some)
                np.add.at(edge, at[::2], 1)
                np.add.at(edge, at[1::2], -1)
        return np.cumsum(edge)[:len(w)] > 0, {d: set(x) for d, x in enumerate(names) if x}

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        total = batch.num_rows
        n_words, n_hit = np.zeros(total, np.int64), np.zeros(total, np.int64)
        lists: list[list[str]] = [[] for _ in range(total)]
        kept = "__spans" in batch.schema.names
        for first, data, offsets in chunks(column(batch, text)):
            w = tokens(data, offsets)
            flags, names = np.zeros(len(w), bool), {}
            if shared is not None:
                flags, names = marked(w, shared.value)
            elif kept:
                flags, names = gathered(w, column(batch, "__spans").slice(first, w.n_docs).to_pylist(), column(batch, "__items").slice(first, w.n_docs).to_pylist())
            for d, some in names.items():
                lists[first + d] = sorted(some)
            hit = np.concatenate([[0], np.cumsum(flags)])
            n_words[first:first + w.n_docs] = np.diff(w.first)
            n_hit[first:first + w.n_docs] = hit[w.first[1:]] - hit[w.first[:-1]]
        return [pa.array(n_words), pa.array(n_hit), pa.array([len(x) for x in lists], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists], pa.string()), pa.array((n_hit > 0) & (least * n_hit >= n_words))]

    return annotate(joined, run, [T.StructField(prefix + name, kind) for name, kind in FIELDS]).drop("__key", "__spans", "__items")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated; columns stay."""
    return overlaps(docs, items, prefix="__").filter(~F.col("__contaminated")).drop(*[f"__{name}" for name, _ in FIELDS])
