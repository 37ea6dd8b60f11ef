"""Mining: calibrate on drawn samples, then mine every sample with the calibrated threshold."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.similarity import calibrate, calibrate_from, mine_hard_negatives
from ..operators.stats import mining_stats


def mine(samples: DataFrame, pool: DataFrame, k: int = 8, max_pos_sim: float | None = None, pairs: DataFrame | None = None):
    """(mined, statistics). Threshold: given, else from a pair table, else calibrated on the samples (one number to the driver)."""
    if max_pos_sim is None:
        found = calibrate_from(pairs) if pairs is not None else calibrate(samples, pool)
        max_pos_sim = found.first().max_positive_similarity
    mined = mine_hard_negatives(samples, pool, k, max_pos_sim)
    return mined, mining_stats(mined)
