"""Counting quotient filters over packed n-grams of 64-bit word ids: lossless, sorted, mergeable.

A key is a tuple of ids, one lane each. ``permute`` is invertible: the first lane is mixed with a hash of the others, so its bits are even whatever the
words are. The leading bits of that lane name the shard, the next ones the quotient, and the rest, with the other lanes in full, is the remainder that is
stored. Entries stand in the order of their quotients and remainders; two bit vectors (which quotients occur, where a run ends) give the quotients back.
Nothing is hashed away, so counts are exact. A counter takes one byte, larger ones are kept aside.
"""
from __future__ import annotations

import struct

import numpy as np

from labelloom.llm.words import _MIX, _SHIFT, mix

_UNMIX = np.uint64(pow(int(_MIX), -1, 1 << 64))
_LANE = np.uint64(0xA24BAED4963EE407)


def unmix(h: np.ndarray) -> np.ndarray:
    """Undoes ``mix``."""
    h = h ^ (h >> _SHIFT[1])
    h = h * _UNMIX
    h = h ^ (h >> _SHIFT[0]) ^ (h >> np.uint64(58))
    h = h * _UNMIX
    return h ^ (h >> _SHIFT[1])


def _others(lanes: list[np.ndarray]) -> np.ndarray | np.uint64:
    out = np.uint64(0)
    for lane in reversed(lanes[1:]):
        out = mix(lane * _LANE + out)
    return out


def permute(lanes: list[np.ndarray]) -> list[np.ndarray]:
    return [mix(lanes[0] ^ _others(lanes)), *lanes[1:]]


def restore(lanes: list[np.ndarray]) -> list[np.ndarray]:
    return [unmix(lanes[0]) ^ _others(lanes), *lanes[1:]]


def combine(lanes: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted different keys and the sums of their counts (of one each)."""
    if not len(lanes[0]):
        return lanes, np.zeros(0, np.int64)
    order = np.argsort(lanes[0])
    held = [lane[order] for lane in lanes]
    equal = held[0][1:] == held[0][:-1]
    alike = np.logical_and.reduce([equal, *(lane[1:] == lane[:-1] for lane in held[1:])])
    if not np.array_equal(equal, alike):  # different keys share a first lane: put the others in order too
        order = np.lexsort(lanes[::-1])
        held = [lane[order] for lane in lanes]
        alike = np.logical_and.reduce([lane[1:] == lane[:-1] for lane in held])
    first = np.flatnonzero(np.r_[True, ~alike])
    sums = np.diff(np.r_[first, len(order)]) if counts is None else np.add.reduceat(counts[order], first)
    return [lane[first] for lane in held], sums.astype(np.int64)


def shard_bounds(lane: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2^bits shards begins in a sorted lane, and the end."""
    return np.searchsorted(lane >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else np.array([0, len(lane)])


def pack(lanes: list[np.ndarray], counts: np.ndarray, bits: int) -> bytes:
    """The filter of sorted entries of one shard of 2^bits."""
    n = len(counts)
    q = min(max(0, n.bit_length() - 1), 63 - bits)
    low = 64 - bits - q
    quotient = ((lanes[0] << np.uint64(bits)) >> np.uint64(bits + low)) if q else np.zeros(n, np.uint64)
    occupied = np.zeros(1 << q, np.uint8)
    occupied[quotient.astype(np.int64)] = 1
    ends = np.r_[quotient[1:] != quotient[:-1], True].astype(np.uint8)
    width = -(-low // 8)
    rest = np.ascontiguousarray(lanes[0]).view(np.uint8).reshape(n, 8)[:, :width]
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join([struct.pack("<IBB", n, q, width), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), rest.tobytes(), *[np.ascontiguousarray(lane).tobytes() for lane in lanes[1:]],
                     small.tobytes(), counts[counts >= 255].astype(np.int64).tobytes()])


def unpack(data: bytes, shard: int, bits: int, n_lanes: int) -> tuple[list[np.ndarray], np.ndarray]:
    n, q, width = struct.unpack_from("<IBB", data)
    at = 6

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    occupied = np.flatnonzero(np.unpackbits(take(max(1, (1 << q) // 8)), count=1 << q)).astype(np.uint64)
    ends = np.unpackbits(take(-(-n // 8)), count=n)
    low = 64 - bits - q
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :width] = take(n * width).reshape(n, width)
    lane = rest.view(np.uint64).ravel()
    if low < 64:
        lane &= np.uint64((1 << low) - 1)
        run = np.cumsum(ends) - ends
        lane |= occupied[run] << np.uint64(low)
        if bits:
            lane |= np.uint64(shard << (64 - bits))
    lanes = [lane, *[take(8 * n).view(np.uint64) for _ in range(n_lanes - 1)]]
    counts = take(n).astype(np.int64)
    large = counts == 255
    counts[large] = take(8 * int(large.sum())).view(np.int64)
    return lanes, counts


def merge(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted union of filters; counters of equal keys add up."""
    if len(parts) == 1:
        return parts[0]
    return combine([np.concatenate(lane) for lane in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))
