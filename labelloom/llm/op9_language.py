"""Language by prediction by partial matching: one byte context tree per language, frozen after training.

Each tree holds how often each byte followed each context of up to three bytes. A text costs the bits that the tree needs to code it:
from the longest context known to the tree, the byte's share, or an escape (as many as different bytes followed, over all that
followed) to the next shorter context without the bytes already ruled out, at last one of 256 equal bytes. The language with the
shortest code wins; its score is its share if all languages were as likely beforehand.

Trees are learnt from texts with a language, outside the held-out third. Parameter ``per_lang``: about so many documents of each
language are learnt from, chosen by a hash of their id, whatever the size of the table. Every context that they hold is kept, as sorted
keys for each language and order, so the trees are as large as these documents need and no larger. Each text is scored whole.

Null text or text without letters: ``und``, score 0; so is everything if there is nothing to learn from. Equal lengths: the language
that comes first in the alphabet. Texts with null id are never learnt from. Repeated rows get equal results; other columns pass through.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from labelloom.llm.common import annotate, arrow, chunks, column, texts

LETTER = regex.compile(r"\p{L}")
ORDER = 3


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the three before it and itself as one number of 32 bits; before a text stand zeros."""
    out = data.astype(np.uint32)
    for back in range(1, ORDER + 1):
        out |= preceding(data, offsets, back).astype(np.uint32) << np.uint32(8 * back)
    return out


def preceding(data: np.ndarray, offsets: np.ndarray, back: int) -> np.ndarray:
    """The byte ``back`` places before each byte, 0 before its text begins."""
    out = np.zeros_like(data)
    out[back:] = data[:-back] if len(data) > back else data[:0]
    for j in range(back):
        at = offsets[:-1] + j
        out[at[at < len(data)]] = 0
    return out


class Order:
    """The contexts of ``k`` bytes of one tree, and the bytes that followed them. Keys are as in ``grams``: the last byte lowest."""

    def __init__(self, k: int, codes: np.ndarray, n: np.ndarray, shorter: Order | None):
        self.k = k
        self.grams, where = np.unique(codes & low(k + 1), return_inverse=True)
        self.n = np.bincount(where, n)
        self.contexts, starts = np.unique(self.grams >> np.uint32(8), return_index=True)
        self.total, self.kinds = np.add.reduceat(self.n, starts), np.diff(np.append(starts, len(self.grams)))
        self.head, self.escape = lengths(self.total, self.kinds)
        self.log = np.log2(self.n).astype(np.float32)
        if shorter is not None:  # the next shorter context, without the bytes that this one rules out
            at = np.searchsorted(shorter.contexts, self.contexts & low(k - 1))
            ruled = np.add.reduceat(shorter.n[np.searchsorted(shorter.grams, self.grams & low(k))], starts)
            self.next_head, self.next_escape = lengths(shorter.total[at] - ruled, shorter.kinds[at] - self.kinds)


def low(n: int) -> np.uint32:
    """Mask of the ``n`` lowest bytes."""
    return np.uint32((1 << 8 * n) - 1)


def lengths(total: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of a byte before its own count is taken off, and of an escape; 0 where nothing is left."""
    head = np.log2(np.maximum(total + kinds, 1))
    return head.astype(np.float32), (head - np.log2(np.maximum(kinds, 1))).astype(np.float32)


def lookup(keys: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys, and which of them are there."""
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return at, keys[at] == want


class Model:
    """The frozen trees: for each language its orders from the longest to none."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.trees: list[list[Order]] = []
        for lang in self.langs:
            orders: list[Order] = []
            for k in range(ORDER + 1):
                orders.append(Order(k, *counts[lang], orders[-1] if orders else None))
            for o in orders:
                del o.n, o.total  # only needed to build the next
            self.trees.append(orders[::-1])

    @staticmethod
    def _bits(tree: list[Order], codes: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each code after the three before it."""
        out = np.zeros(len(codes))
        left, spent = np.arange(len(codes)), np.zeros(len(codes))
        head, escape, begun = np.zeros(len(codes)), np.zeros(len(codes)), np.zeros(len(codes), bool)
        for o in tree:
            at, known = lookup(o.contexts, codes[left] >> np.uint32(8) & low(o.k))
            head, escape = np.where(begun, head, o.head[at]), np.where(begun, escape, o.escape[at])
            place, hit = lookup(o.grams, codes[left] & low(o.k + 1))
            out[left[hit]] = spent[hit] + head[hit] - o.log[place[hit]]
            spent = np.where(known, spent + escape, spent)
            begun = begun | known
            if o.k:
                head, escape = o.next_head[at], o.next_escape[at]
            left, spent, head, escape, begun = left[~hit], spent[~hit], head[~hit], escape[~hit], begun[~hit]
        out[left] = spent + np.log2(max(256 - len(tree[-1].grams), 1))
        return out

    def cost(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            codes, where = np.unique(grams(data, offsets), return_inverse=True)
            for i, tree in enumerate(self.trees):
                out[full, i] = np.add.reduceat(self._bits(tree, codes)[where], offsets[:-1][full])
        return out


def train(docs: DataFrame, per_lang: int = 2000, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Counts of contexts over about ``per_lang`` documents of each language. To the driver comes only what these documents hold."""
    rows = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    rows = rows.filter("k is not null and t is not null and l is not null").filter(~held_out("k"))
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}  # one row for each language
    if not sizes:
        return Model({})
    share = F.create_map(*[x for name, n in sorted(sizes.items()) for x in (F.lit(name), F.lit(min(1.0, per_lang / n)))])
    draw = F.pmod(F.xxhash64(F.col("k").cast("string"), F.lit("ppm")), F.lit(1 << 30)) < share[F.col("l")] * (1 << 30)

    def count(batches):
        for batch in batches:
            langs = np.array(column(batch, "l").to_pylist(), object)
            for name in sorted(set(langs)):
                some = column(batch, "t").filter(pa.array(langs == name))
                parts = [np.unique(grams(data, offsets), return_counts=True) for _, data, offsets in chunks(some) if len(data)]
                if parts:
                    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)], names=["l", "g", "n"])

    got = arrow(rows.filter(draw).select("t", "l"), count, "l string, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(got.column("l").to_pylist(), object)
    g, n = got.column("g").to_numpy().astype(np.uint32), got.column("n").to_numpy()
    return Model({x: (g[names == x], n[names == x]) for x in sorted(set(names))})


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Narrow: appends the language and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        m = shared.value
        some = texts(batch, text)
        lettered = np.array([LETTER.search(x) is not None for x in some], bool)
        pred, score = np.full(len(some), "und", object), np.zeros(len(some))
        if m.langs:
            for first, data, offsets in chunks(column(batch, text)):
                bits = m.cost(data, offsets)
                best = bits.argmin(1)
                share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                at = np.arange(first, first + len(best))
                pred[at] = np.array(m.langs, object)[best]
                score[at] = share
            pred[~lettered], score[~lettered] = "und", 0
        return [pa.array(pred.tolist(), pa.string()), pa.array(score)]

    return annotate(docs, run, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])


def languages(docs: DataFrame, per_lang: int = 2000) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), train(docs, per_lang)).select("doc_id", "held_out", "lang_pred", "score")


def identified(docs: DataFrame, per_lang: int = 2000, least: float = 0.5) -> DataFrame:
    """The rows whose language is found: not ``und``, and likelier than all other languages together. Columns stay."""
    names = ("__lang_pred", "__lang_score")
    found = predict(docs, train(docs, per_lang), names=names)
    return found.filter((F.col(names[0]) != "und") & (F.col(names[1]) >= least)).drop(*names)
