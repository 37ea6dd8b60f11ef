"""The tile kernel of mining and the selection of best cells."""
from inspect import signature

import numpy as np
import pyarrow as pa
import pytest

from labelloom.operators import similarity as sim, tiles


@pytest.mark.parametrize("n, k", [(1, 1), (7, 3), (300, 8), (1000, 2), (40, 500)])
def test_best_rounded_equals_rounding_everything(n, k):
    rng = np.random.default_rng(n)
    raw = np.round(rng.normal(size=(20, n)), 1) + 1e-10 * rng.integers(-3, 4, size=(20, n))  # ties that only rounding shows
    raw[rng.random(raw.shape) < .3] = -np.inf
    raw[0] = -np.inf
    raw[1, ::2], raw[2, 0] = np.nan, np.inf
    order = rng.permutation(n)
    for place in (None, order):
        rows, cols, scores = tiles.best_rounded(raw, k, place)
        s = np.round(raw, tiles.DIGITS)
        for i in range(20):
            want = sorted((j for j in range(n) if np.isfinite(s[i, j])), key=lambda j: (-s[i, j], j if place is None else place[j]))[:k]
            assert cols[rows == i].tolist() == want and scores[rows == i].tolist() == s[i, want].tolist()


def table(vectors, ids, lists):
    f = pa.list_(pa.float32())
    return pa.table({"sample_id": ids, "vector": pa.array([v.tolist() for v in vectors], f), "used": [["b", "none", "d"]] * len(ids), "pv": pa.array(lists, f)})


def test_equal_positives_are_compared_once():
    """A sample each was compared with its positives before, three times the work of its own scores and more."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(40, 4)).astype(np.float32)
    lists = [v[:2].ravel().tolist(), v[2:3].ravel().tolist(), []]
    l = table(v, list(range(40)), [lists[i % 3] for i in range(40)])
    r = pa.table({"label": ["a", "b", "b", "c", "d"], "vector": l["vector"][5:10]})
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    (rows, scores, close, which, used), = sim._walk(l, r, 0.2)
    assert close.shape == (3, 5) and sorted(rows) == list(range(40))
    assert np.allclose(scores, unit[rows] @ unit[5:10].T, atol=1e-6)
    pos = [unit[:2], unit[2:3], unit[:0]]
    for i, row in enumerate(rows):
        want = (pos[row % 3] @ unit[5:10].T >= 0.2).any(axis=0)
        assert close[which[i]].tolist() == want.tolist()
        assert sorted(used[1][used[0] == i]) == [1, 2, 4]  # equal labels are all used


def test_mining_tiles_grow_to_their_bytes():
    """360,000 samples and labels made 1,936 pairs of tiles, each of which handed on up to 64 skipped labels a sample."""
    p = signature(sim.mine_hard_negatives).parameters
    rows, skipped = p["tile_rows"].default, p["skipped_rows"].default
    n_rows, n_cols = tiles.grid(360_000, 360_000, (min(rows, tiles.TILE_BYTES // (8 * 64 * 4)), min(rows, tiles.TILE_BYTES // (8 * 64))), 12)
    assert n_rows * n_cols <= 100 and n_cols * skipped <= 64
