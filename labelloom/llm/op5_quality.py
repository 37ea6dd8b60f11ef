"""Text quality: fixed rules, then a logistic regression over hashed word and character n-grams whose probability is calibrated.

Features: shares of hashed words, word pairs and runs of four bytes, ``DIMS`` of each. The regression is fitted on labelled rows
by reweighted least squares over the kernel of the rows, on three quarters of them; the other quarter fits slope and offset of the
probability. Parameter ``train_rows`` bounds the labelled rows that are learnt from, chosen by a hash of the id. Rules and scores
read every whole text, in Arrow batches.

Null text: no words. Labels: null quality or id, and ids with both labels, are left out; with only one class (or no labels) there is
no verdict and the rules decide alone (quality_p null). Repeated rows get equal results; other columns pass through.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from labelloom.llm.common import annotate, arrow, chunks, column
from labelloom.llm.words import Words, mix

DIMS = 1 << 12
#: Rejected is only what is more likely than not by a good margin to be poor.
KEPT_FROM = 0.3
FOLD = np.arange(256, dtype=np.uint8)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
BEGINS = np.ones(256, bool)  # bytes that begin a code point
BEGINS[0x80:0xC0] = False


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def rules(w: Words, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per text."""
    inside = IS_WORD[data]
    out = {"n_words": np.diff(w.first), "word_chars": per_text(inside & BEGINS[data], offsets), "n_symbols": per_text(SYMBOL[data], offsets)}
    raw = data.tobytes()
    lines = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        some = [x for x in raw[a:b].split(b"\n") if x.strip()]  # of bytes: strips space and \t..\r
        lines.append(len(some) - len(set(some)))
    out["n_dup_lines"] = np.array(lines, np.int64)
    h, whole = w.shingles(5)
    at = np.flatnonzero(whole)
    key = mix(h[at] + w.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(w) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + 5, -1)
    out["n_repeat_words"] = per_text(np.cumsum(edge)[:len(w)] > 0, w.first)
    return out


def features(w: Words, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, dimension) of every word, word pair and run of four characters."""
    top = np.uint64(52)
    pair, whole = w.shingles(2)
    d = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    four = np.zeros(max(0, len(d) - 3), np.uint64)
    for i in range(4):
        four = four * np.uint64(0x110001) + d[i:i + len(four)]  # more than there are code points
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    of_char = np.repeat(np.arange(len(offsets) - 1), np.diff(begins))
    inside = of_char[:len(four)] == of_char[3:3 + len(four)] if len(four) else np.zeros(0, bool)
    return [(w.doc, (w.h >> top).astype(np.int64)), (w.doc[:len(pair)][whole], (pair[whole] >> top).astype(np.int64)),
            (of_char[:len(four)][inside], (four[inside] * np.uint64(0x9E3779B97F4A7C15) >> top).astype(np.int64))]


class Model:
    """Weights per dimension (features already scaled), offset, and slope and offset of the probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 0.05):
        test = np.arange(len(y)) % 4 == 3
        mean, std = x.mean(0), x.std(0)
        std[std == 0] = np.inf
        scale = (1 / std / np.sqrt(np.isfinite(std).sum() or 1)).astype(np.float32)
        z = (x[~test] - mean) * scale
        kernel = (z @ z.T).astype(np.float64) + 1
        a, t = np.zeros(len(z)), y[~test]
        for _ in range(12):
            f = kernel @ a
            p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
            v = np.maximum(p * (1 - p), 1e-4)
            a = np.linalg.solve(kernel + np.diag(ridge / v), f + (t - p) / v)
        w = z.T @ a
        self.w = (w * scale).astype(np.float64)
        self.offset = float(a.sum() - mean @ self.w)
        self.slope, self.shift = self._calibrated((x[test] @ self.w + self.offset).astype(np.float64), y[test])

    @staticmethod
    def _calibrated(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
        """Maximum likelihood of slope and shift, targets drawn in a little so that perfect rows stay finite."""
        n1, n0 = y.sum(), len(y) - y.sum()
        if not n1 or not n0:
            return 1.0, 0.0
        t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        g = np.array([1.0, 0.0])
        m = np.stack([f, np.ones(len(f))], 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(m @ g, -30, 30)))
            v = np.maximum(p * (1 - p), 1e-6)
            g = g - np.linalg.solve((m * v[:, None]).T @ m + 1e-6 * np.eye(2), m.T @ (p - t))
        return (float(g[0]), float(g[1])) if g[0] > 0 else (1.0, 0.0)

    def probability(self, found: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
        score = np.full(n, self.offset)
        for i, (doc, dim) in enumerate(found):
            total = np.bincount(doc, minlength=n)
            score += np.bincount(doc, self.w[i * DIMS + dim], n) / np.maximum(total, 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = 2000) -> Model | None:
    """Fits on at most ``train_rows`` labelled documents; these alone come to the driver, as shares of dimensions."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("k")).agg(F.min("quality").alias("y"), F.max("quality").alias("y2")).filter("y = y2")
    some = known.orderBy(F.xxhash64("k"), "k").limit(train_rows).select("k", "y")
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("k")).select("k", "y", "text")  # train_rows rows at most

    def shares(batches):
        for batch in batches:
            for first, data, offsets in chunks(column(batch, "text")):
                n = len(offsets) - 1
                x = np.zeros((n, 3 * DIMS), np.float32)
                for i, (doc, dim) in enumerate(features(Words(data, offsets, IS_WORD, FOLD), data, offsets)):
                    count = np.bincount(doc * DIMS + dim, minlength=n * DIMS).reshape(n, DIMS)
                    x[:, i * DIMS:(i + 1) * DIMS] = count / np.maximum(count.sum(1, keepdims=True), 1)
                at = [np.flatnonzero(r) for r in x]
                keys = [hashlib.md5(data[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([column(batch, c).slice(first, n) for c in "ky"] + [pa.array(keys), pa.array([i.astype(np.int32).tobytes() for i in at]), pa.array([r[i].tobytes() for r, i in zip(x, at)])], names=["k", "y", "digest", "at", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    # of rows that share an id the text of the least digest counts
    once = arrow(rows, shares, f"k {kinds['k']}, y {kinds['y']}, digest string, at binary, x binary").groupBy("k").agg(F.min(F.struct("digest", "y", "at", "x")).alias("r")).select("k", "r.y", "r.at", "r.x")
    got = sorted(once.collect(), key=lambda r: r["k"])
    y = np.array([r["y"] for r in got], float)
    fit, test = y[np.arange(len(y)) % 4 != 3], y[np.arange(len(y)) % 4 == 3]
    if len(y) < 8 or fit.min() == fit.max() or not len(test):
        return None
    x = np.zeros((len(got), 3 * DIMS), np.float32)
    for row, r in zip(x, got):
        row[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["x"], np.float32)
    return Model(x, (y > 0).astype(float))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Narrow: appends the counts, base_failed, kept and quality_p."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out = {c: np.zeros(batch.num_rows, np.int64) for c in COUNTS}
        p = np.ones(batch.num_rows)
        for first, data, offsets in chunks(column(batch, text)):
            w, rows = Words(data, offsets, IS_WORD, FOLD), slice(first, first + len(offsets) - 1)
            for c, x in rules(w, data, offsets).items():
                out[c][rows] = x
            if shared.value is not None:
                p[rows] = shared.value.probability(features(w, data, offsets), w.n_docs)
        failed = (out["n_words"] < 10) | (100 * out["n_repeat_words"] > 20 * out["n_words"])
        return [*[pa.array(out[c]) for c in COUNTS], pa.array(failed), pa.array(~failed & (p >= KEPT_FROM)), pa.array(p) if shared.value is not None else pa.nulls(len(p), pa.float64())]

    return annotate(docs, run, [*[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("quality_p", T.DoubleType())])
