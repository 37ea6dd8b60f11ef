"""Blocked Bloom filters of 64-bit hashes in shards: built by Spark as partial ORs, broadcast with a fixed bound of size.

A filter never denies a key that it holds. It lets strangers through now and then, the more often the fuller it is, so whoever asks must settle
what passes by an exact join or count. That is why the size may be bounded: beyond it the filter only saves less.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labelloom.llm.common import arrow
from labelloom.llm.words import mix

#: 64-bit blocks that all shards of a filter may have together: 16 MB.
BLOCKS = 1 << 21
#: Bits that a key sets in its block, and bits of filter for a key while there is room.
PROBES, ROOM = 5, 16


def _place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and mask of each hash. ``blocks`` is a power of two."""
    h = mix(h)
    mask = np.zeros(len(h), np.uint64)
    for i in range(PROBES):
        mask |= np.uint64(1) << ((h >> np.uint64(34 + 6 * i)) & np.uint64(63))
    return (h & np.uint64(blocks - 1)).astype(np.int64), mask


def sizes(counts: dict[int, int], limit: int = BLOCKS) -> dict[int, int]:
    """Blocks of each shard: powers of two with ROOM bits for a key, all halved until they keep to ``limit`` together (one block each at least)."""
    out = {s: 1 << max(0, (max(1, n) * ROOM // 64 - 1).bit_length()) for s, n in counts.items()}
    while sum(out.values()) > limit and max(out.values()) > 1:
        out = {s: max(1, n // 2) for s, n in out.items()}
    return out


class Filter:
    """``shards``: shard -> blocks as unsigned longs."""

    def __init__(self, shards: dict[int, np.ndarray]):
        self.shards = shards

    def has(self, shard: int, h: np.ndarray) -> np.ndarray:
        bits = self.shards.get(shard)
        if bits is None:
            return np.zeros(h.shape, bool)
        block, mask = _place(h.ravel(), len(bits))
        return ((bits[block] & mask) == mask).reshape(h.shape)


def build(keys: DataFrame, hashed: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]], counts: dict[int, int], limit: int = BLOCKS) -> Filter:
    """Filter over the rows of ``keys``: ``hashed`` gives (shard, hashes) of a batch, ``counts`` the number of keys by shard.

    Blocks are ORed on the map side and again by (shard, block); at most ``limit`` of them come to the driver.
    """
    room = sizes(counts, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, h in hashed(batch):
                if len(h) and shard in room:
                    block, mask = _place(h, room[shard])
                    order = np.argsort(block, kind="stable")
                    block, mask = block[order], mask[order]
                    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), shard, np.int32)), pa.array(block[first]), pa.array(np.bitwise_or.reduceat(mask, first).view(np.int64))], names=["shard", "block", "bits"])

    parts = arrow(keys, run, "shard int, block long, bits long").groupBy("shard", "block").agg(F.bit_or("bits").alias("bits"))
    out = {s: np.zeros(n, np.uint64) for s, n in room.items()}
    got = parts.toArrow()
    shard, block, bits = (got.column(c).to_numpy() for c in ("shard", "block", "bits"))
    for s in np.unique(shard).tolist():
        mine = shard == s
        out[s][block[mine]] = bits[mine].view(np.uint64)
    return Filter(out)
