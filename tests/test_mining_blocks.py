"""Mining over tiles of several blocks of labels: nearly all cells are only compared with a bound, and the picks and counts are those of a walk over all of them."""
import numpy as np
import pyarrow as pa
import pytest

from labelloom.operators import similarity as sim


def tables(rng, n, m, n_lists):
    f = pa.list_(pa.float32())
    v, w = rng.normal(size=(n, 4)).astype(np.float32), rng.normal(size=(m, 4)).astype(np.float32)
    w[5:9] = w[4]
    lists = [w[rng.choice(m, i % 3, replace=False)].ravel() for i in range(n_lists)]
    names = [f"l{i:04d}" for i in range(m)]
    l = pa.table({"sample_id": list(range(n)), "vector": pa.array([x.tolist() for x in v], f), "used": [[names[i], "none", names[-1 - i]] for i in range(n)], "pv": pa.array([lists[i % n_lists].tolist() for i in range(n)], f)})
    return l, pa.table({"label": names, "vector": pa.array([x.tolist() for x in w], f)})


@pytest.mark.parametrize("n_lists", [2, 40])
def test_single_cells_agree_with_all_cells(n_lists):
    rng = np.random.default_rng(2)
    l, r = tables(rng, 40, 500, n_lists)
    walk = sim._Walk(l, r, 0.6)
    assert (walk.table is None) == (n_lists == 40)
    limit = np.full(40, 0.9)
    for rows, scores, close, which, (x, y) in sim._walk(l, r, 0.6):
        a, b = (i.ravel() for i in np.indices(scores.shape))
        assert np.array_equal(walk.close(rows[a], b), close[which].ravel())
        few = rng.choice(len(a), 30, replace=False)
        assert np.array_equal(walk.close(rows[a[few]], b[few]), close[which[a[few]], b[few]])
        mine = np.zeros(scores.shape, bool)
        mine[x, y] = True
        assert np.array_equal(walk.has(rows[a], b), mine.ravel())
        got = set(zip(*(i.tolist() for i in walk.cells(slice(0, 40), slice(0, 500), limit)[:2])))
        want = {(int(rows[i]), int(j)) for i, j in zip(*np.nonzero(np.round(scores, 9) >= 0.9))}
        assert want <= got and len(got) <= len(want) + 5


@pytest.mark.parametrize("limit", [-0.5, 0.5, 2.0])
def test_picks_and_counts_over_blocks(spark, limit):
    rng = np.random.default_rng(4)
    n = 900
    v = np.round(rng.normal(size=(n, 6)), 2).astype(np.float32)
    v[100:110], v[300] = v[50], 0
    names = [f"l{i:04d}" for i in range(n)]
    rows = [(i, v[i].tolist(), [names[j] for j in rng.choice(n, 1 + i % 2, replace=False)], [names[(7 * i + 3) % n]]) for i in range(0, 30)]
    got = {r.sample_id: r for r in sim.mine_hard_negatives(spark.createDataFrame(rows, "sample_id long, vector array<float>, pos array<string>, neg array<string>"),
                                                           spark.createDataFrame([(x, u.tolist()) for x, u in zip(names, v)], "label string, vector array<float>"), 4, limit).collect()}
    u = v.astype(float)
    u = u / np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
    for i, _, pos, neg in rows:
        s = np.round(u @ u[i], 9)
        near = (np.round(np.array([u[names.index(p)] for p in pos]) @ u.T, 9) >= limit).any(axis=0)
        new, used, close, seen = [], 0, 0, 0
        for j in sorted(range(n), key=lambda j: (-s[j], names[j])):
            if len(new) == 4:
                break
            seen += 1
            if names[j] in pos + neg:
                used += 1
            elif near[j]:
                close += 1
            else:
                new.append(names[j])
        assert got[i].neg == neg + new
        assert (got[i].candidates, got[i].excluded_used, got[i].excluded_by_positive_similarity) == (seen, used, close)
