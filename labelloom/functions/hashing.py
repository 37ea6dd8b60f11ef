"""Reproducible randomness: md5(seed, parts...) gives an order that no partitioning can change."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_order(seed: int | str, *parts: Column) -> Column:
    """Hexadecimal sort key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_uniform(seed: int | str, *parts: Column) -> Column:
    """Number in (0, 1) from the first 13 hexadecimal digits (52 bits) of the same key."""
    top = F.conv(F.substring(hash_order(seed, *parts), 1, 13), 16, 10).cast("double")
    return (top + 0.5) / F.lit(float(1 << 52))


def text_key(text: Column) -> Column:
    return F.md5(text)


def model_key(model: str) -> str:
    import hashlib
    return hashlib.md5(model.encode()).hexdigest()[:8]
