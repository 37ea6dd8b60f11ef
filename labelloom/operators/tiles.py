"""All-pairs scoring in tiles: no pair of rows ever becomes a row.

Both sides are cut by a hash of the id into tiles of at most about ``tile_rows`` rows (their counts decide how
many). Every left tile meets every right tile in one Arrow call that multiplies two matrices and returns only
what the operator keeps, e.g. k rows per left row. The ids are hashed, so no tile is hotter than another.
Cost: left rows x right tiles + right rows x left tiles are shuffled once.
"""
from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of a tile of vectors alone, whose scores are worked out in chunks; what is shuffled, and handed on, falls with it. TILE_BYTES bounds it for long vectors.
TILE_ROWS = 65_536
CHUNK_CELLS = 4_000_000
#: Bytes of one side of a pair of tiles, and partitions that pairs of tiles are dealt to at most; a task works on its pairs one after the other.
TILE_BYTES = 64 << 20
MOST_PARTITIONS = 20_000
#: Scores are rounded to this many digits before they are compared.
DIGITS = 9


def grid(left_rows: int, right_rows: int, tile_rows: int | tuple[int, int], cores: int) -> tuple[int, int]:
    """Number of left and right tiles: bounded by memory, and enough of them for the cores."""
    mine, theirs = tile_rows if isinstance(tile_rows, tuple) else (tile_rows, tile_rows)
    rows = max(1, math.ceil(left_rows / mine))
    cols = max(1, math.ceil(right_rows / theirs))
    spread = min(math.ceil(cores / (rows * cols)), math.ceil(left_rows / 256) or 1)
    return rows * max(1, spread), cols


def _width(df: DataFrame) -> int:
    """Numbers of the longest vector, at least one."""
    return max(1, df.agg(F.max(F.size("vector"))).first()[0] or 1) if "vector" in df.columns else 1


def tiled(left: DataFrame, left_id: str, right: DataFrame, right_id: str,
          kernel: Callable[[pa.Table, pa.Table], pa.Table], schema: str, tile_rows: int | tuple[int, int] = TILE_ROWS,
          rows: tuple[int, int] | None = None) -> DataFrame:
    """Apply ``kernel(left_tile, right_tile)`` to all pairs of tiles.

    ``rows`` = row counts (or upper bounds) of both sides where the caller knows them; otherwise they are counted. ``tile_rows`` may
    be a pair, one for each side.
    """
    spark = left.sparkSession
    cores = spark.sparkContext.defaultParallelism
    width = max([_width(df) for df in (left, right)] if rows is None and "vector" in left.columns else [1])
    if not isinstance(tile_rows, tuple):
        tile_rows = max(1, min(tile_rows, TILE_BYTES // (8 * width)))
    n_rows, n_cols = grid(*(rows or (left.count(), right.count())), tile_rows, cores)
    n = n_rows * n_cols

    def spread(df, mine, own, n_own, other, n_other):
        # fresh column identities: both sides may come from one DataFrame
        df = df.select([F.col(c).alias(c) for c in df.columns])
        return (df.withColumn(own, F.pmod(F.xxhash64(mine), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
                .repartition(min(n, MOST_PARTITIONS), "_r", "_c"))

    a = spread(left, left_id, "_r", n_rows, "_c", n_cols)
    b = spread(right, right_id, "_c", n_cols, "_r", n_rows)

    def one(l: pa.Table, r: pa.Table) -> pa.Table:
        return kernel(l.drop_columns(["_r", "_c"]), r.drop_columns(["_r", "_c"]))

    return a.groupBy("_r", "_c").cogroup(b.groupBy("_r", "_c")).applyInArrow(one, schema)


# --- helpers for kernels (numpy inside one tile) ------------------------------------------------

def matrix(table: pa.Table, column: str, normalise: bool = True) -> np.ndarray:
    """Vector column -> rows x dimension."""
    values = table.column(column).combine_chunks()
    m = np.asarray(values.flatten(), dtype=np.float64).reshape(len(values), -1)
    if normalise:
        n = np.linalg.norm(m, axis=1, keepdims=True)
        m = np.divide(m, n, out=m.copy(), where=n > 0)
    return m


def nested(table: pa.Table, column: str) -> list[list]:
    return table.column(column).to_pylist()


def chunks(n_left: int, n_right: int):
    """Row ranges of the left tile that keep the score matrix small."""
    step = max(1, CHUNK_CELLS // max(1, n_right))
    for start in range(0, n_left, step):
        yield slice(start, min(n_left, start + step))


def best_k(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best finite cells per row, best first; ties by column."""
    k = min(k, scores.shape[1])
    if k <= 0:
        return np.empty(0, int), np.empty(0, int)
    limit = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    r, c = np.nonzero((scores >= limit) & np.isfinite(scores))
    order = np.lexsort((c, -scores[r, c], r))
    r, c = r[order], c[order]
    first = np.searchsorted(r, np.arange(scores.shape[0]))
    keep = np.arange(len(r)) - first[r] < k
    return r[keep], c[keep]


#: Columns of a block whose maximum stands for it, and how far a score may lie from its rounded one.
BLOCK, SLACK = 64, 2e-9


def near(limit: np.ndarray) -> np.ndarray:
    """Raw scores whose rounded ones may reach ``limit`` are not below this."""
    return limit - SLACK - np.abs(limit) * 1e-15


def best_rounded(raw: np.ndarray, k: int, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rounded score) of the k best finite cells per row by rounded score, best first; ties by column, or by its place in ``order``.

    The k-th largest of the maxima of blocks of columns is a bound that k cells reach, so only the cells above it are rounded and sorted.
    """
    n = raw.shape[1]
    k = min(k, n)
    if k <= 0 or not len(raw):
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    block = max(1, min(BLOCK, n // (2 * k)))
    whole = n // block * block
    tops = raw[:, :whole].reshape(len(raw), whole // block, block).max(axis=2) if block > 1 else raw
    if np.isnan(tops).any() or (tops == np.inf).any():
        return best_rounded(np.where(np.isfinite(raw), raw, -np.inf), k, order)
    limit = np.partition(tops, tops.shape[1] - k, axis=1)[:, tops.shape[1] - k]
    r, c = np.nonzero(raw >= near(limit)[:, None])
    s = raw[r, c]
    if (off := ~np.isfinite(s)).any():
        r, c, s = r[~off], c[~off], s[~off]
    s = np.round(s, DIGITS)
    at = np.lexsort((c if order is None else order[c], -s, r))
    r, c, s = r[at], c[at], s[at]
    first = np.searchsorted(r, np.arange(raw.shape[0]))
    keep = np.arange(len(r)) - first[r] < k
    return r[keep], c[keep], s[keep]


#: Items of a piece of a packed set, and items from which a piece is a bitmap (all of these have the same length, which no list reaches).
PIECE, DENSE = 4096, 256


def pack_pieces(pieces: pa.Array, n: int = PIECE) -> pa.Array:
    """Lists of different numbers below ``n`` -> binary: a list of 16-bit numbers, or a bitmap where that is shorter."""
    flat, ends = pieces.flatten().to_numpy(zero_copy_only=False).astype(np.uint16), np.cumsum(np.asarray(pieces.value_lengths()))
    out = []
    for some in np.split(flat, ends[:-1]) if len(pieces) else []:
        if len(some) < DENSE:
            out.append(np.sort(some).tobytes())
        else:
            bits = np.zeros(n, bool)
            bits[some] = True
            out.append(np.packbits(bits).tobytes())
    return pa.array(out, pa.binary())


def _bitmaps(pieces: pa.Array) -> np.ndarray:
    """Packed pieces -> a bitmap in words per row."""
    out = np.zeros((len(pieces), PIECE // 8), np.uint8)
    raw = pieces.to_pylist()
    sizes = np.array([len(x) for x in raw], dtype=np.int64)
    dense = sizes == PIECE // 8
    if dense.any():
        out[dense] = np.frombuffer(b"".join(x for x in raw if len(x) == PIECE // 8), np.uint8).reshape(-1, PIECE // 8)
    if not dense.all():
        items = np.frombuffer(b"".join(x for x in raw if len(x) != PIECE // 8), np.uint16).astype(np.int64)
        bits = np.zeros((int((~dense).sum()), PIECE), bool)
        bits[np.repeat(np.arange(len(bits)), sizes[~dense] // 2), items] = True
        out[~dense] = np.packbits(bits, axis=1)
    return out.view(np.uint64)


def packed_counts(a: pa.ChunkedArray | pa.Array, b: pa.ChunkedArray | pa.Array):
    """As ``shared_counts`` for columns list<struct<block, items>> of packed pieces. Only the pieces of one block are unpacked at a time."""
    def blocks(column):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        block, items = column.flatten().flatten()
        row, block = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths().fill_null(0))), np.asarray(block)
        order = np.argsort(block, kind="stable")
        names, first = np.unique(block[order], return_index=True)
        return {int(name): (row[at], items.take(pa.array(at))) for name, at in zip(names, np.split(order, first[1:]) if len(names) else [])}

    n_b, ours, theirs = len(b), blocks(a), blocks(b)
    both = sorted(ours.keys() & theirs.keys())

    def count(rows: slice) -> np.ndarray:
        out = np.zeros((rows.stop - rows.start, n_b), dtype=np.float32)
        for name in both:
            (mine, left), (cols, right) = ours[name], theirs[name]
            low, high = np.searchsorted(mine, [rows.start, rows.stop])
            if low == high:
                continue
            left, right = _bitmaps(left[low:high]), _bitmaps(right)
            for i, bits in zip(mine[low:high].tolist(), left):
                out[i - rows.start, cols] += np.bitwise_count(bits & right).sum(axis=1, dtype=np.int64)
        return out

    return count


def shared_counts(a: pa.Array | pa.ChunkedArray | list, b: pa.Array | pa.ChunkedArray | list, block: int = 4096):
    """Function rows -> matrix of |a[i] & b[j]| for that range of rows of two list columns. Items are taken as sets, as bits of ``block`` items at a time."""
    a, b = ((x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x if isinstance(x, pa.Array) else pa.array(x, pa.list_(pa.int64()))) for x in (a, b))
    n_b = len(b)
    left, right = a.flatten(), b.flatten()
    code = pa.concat_arrays([left, right]).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_items = int(code.max()) + 1 if len(code) else 0
    held = np.zeros((2, n_items), bool)
    held[0, code[:len(left)]] = held[1, code[len(left):]] = True
    place = np.where(held[0] & held[1], np.cumsum(held[0] & held[1]) - 1, -1)  # only items of both sides count
    n_items = int((place >= 0).sum())

    def pairs(column: pa.Array, codes: np.ndarray) -> np.ndarray:
        """Different (item, row), in this order."""
        sizes = np.asarray(column.value_lengths().fill_null(0))
        item, row = place[codes], np.repeat(np.arange(len(column)), sizes)
        known = item >= 0
        both = np.unique(item[known] * max(1, len(column)) + row[known])
        return np.stack([both // max(1, len(column)), both % max(1, len(column))], axis=1)

    pa_, pb = pairs(a, code[:len(left)]), pairs(b, code[len(left):])

    def bits(some: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that have items of the block, and their bits."""
        low, high = np.searchsorted(some[:, 0], [start, start + block])
        rows, at = np.unique(some[low:high, 1], return_inverse=True)
        m = np.zeros((len(rows), min(block, -(-(n_items - start) // 64) * 64)), dtype=bool)
        m[at, some[low:high, 0] - start] = True
        return rows, np.packbits(m, axis=1).view(np.uint64)

    blocks = [(bits(pa_, start), bits(pb, start)) for start in range(0, n_items, block)]

    def count(rows: slice) -> np.ndarray:
        out = np.zeros((rows.stop - rows.start, n_b), dtype=np.float32)
        for (mine, left), (cols, right) in blocks:
            for i in range(*np.searchsorted(mine, [rows.start, rows.stop])):
                out[mine[i] - rows.start, cols] += np.bitwise_count(left[i] & right).sum(axis=1, dtype=np.int64)
        return out

    return count
