"""Shared groups, light and heavy, against brute force over all pairs."""
import random

import numpy as np
import pyarrow as pa
import pytest

from labelloom.operators import groups
from labelloom.operators.tiles import PIECE, pack_pieces, packed_counts, shared_counts


def relation(seed, labels=60):
    """Few huge groups, some small ones, a label without any, and repeated memberships."""
    rng = random.Random(seed)
    out = {f"{rng.choice('abc')} {rng.choice('de')} x{i}": [] for i in range(labels)}
    for name in out:
        out[name] += [f"big{g}" for g in range(6) if rng.random() < .5] + [f"small{rng.randrange(25)}" for _ in range(rng.randint(0, 3))]
        out[name] += out[name][:1]
    out["a d twin"] = list(out[next(iter(out))])
    out["none"] = []
    return out


def test_counts_as_bitmaps():
    rng = random.Random(1)
    a, b = ([[rng.randrange(300) for _ in range(rng.randint(0, 60))] for _ in range(n)] for n in (13, 17))
    for block in (64, 128, 4096):
        count = shared_counts(a, b, block)
        got = np.vstack([count(slice(0, 5)), count(slice(5, 13))])
        assert (got == [[len(set(x) & set(y)) for y in b] for x in a]).all()
    assert shared_counts([], [])(slice(0, 0)).shape == (0, 0)


@pytest.mark.parametrize("light", [0, 3, 20, 1000])
@pytest.mark.parametrize("min_shared, k", [(1, 4), (2, 3), (0, 100)])
def test_cooccurring_equals_brute_force(spark, light, min_shared, k):
    some = relation(k)
    df = spark.createDataFrame(list(some.items()), "label string, occupations array<string>")
    expected = set()
    for t, mine in some.items():
        scored = sorted((-len(set(mine) & set(o)), l) for l, o in some.items() if l != t and len(set(mine) & set(o)) >= max(1, min_shared))
        expected |= {(t, l, -s, rank) for rank, (s, l) in enumerate(scored[:k], 1)}
    assert {tuple(r) for r in groups.cooccurring_by_group(df, df, min_shared, k, tile_rows=20, light=light).collect()} == expected
    half = df.where("label like 'a%'")
    got = {tuple(r) for r in groups.cooccurring_by_group(half, df, min_shared, k, light=light).collect()}
    assert got == {r for r in expected if r[0].startswith("a")}


@pytest.mark.parametrize("light", [0, 3, 20, 1000])
@pytest.mark.parametrize("vectors", [False, True])
@pytest.mark.parametrize("n", [1, 5, 200])
def test_hard_negatives_equal_brute_force(spark, light, vectors, n):
    some = relation(n + light)
    rng = np.random.default_rng(n)
    vec = {l: rng.normal(size=4).tolist() for l in some}
    covered = {l for i, l in enumerate(some) if i % 3 == 0}
    names = list(some)
    targets = {i: names[3 * i:3 * i + 1 + i % 3] for i in range(12)} | {50: ["none"], 51: ["unknown"], 52: [names[0], "none"]}
    expected = set()
    for t, pos in targets.items():
        mine = set().union(*(some.get(p, []) for p in pos))
        mw = set(" ".join(pos).lower().split())
        m = np.array([np.array(vec[p]) / np.linalg.norm(vec[p]) for p in pos if p in vec])
        scored = []
        for l, o in some.items():
            shared, w = len(mine & set(o)), len(mw & set(l.lower().split()))
            if l in pos or not shared or w > 2:
                continue
            dist = 1 - max(round(float(x), 9) for x in m @ (np.array(vec[l]) / np.linalg.norm(vec[l]))) if vectors else 1 - w / max(len(mw), len(set(l.lower().split())))
            scored.append((-round(2 * shared + (min(5 * dist, 3) if dist >= .63 else 0) + (w <= 1) + .5 * (l in covered), 9), l))
        expected |= {(t, l, rank) for rank, (_, l) in enumerate(sorted(scored)[:n], 1)}
    skills = spark.createDataFrame([(l, o, vec[l]) for l, o in some.items()], "label string, occupations array<string>, vector array<double>")
    got = groups.group_hard_negatives(spark.createDataFrame(list(targets.items()), "target_id long, positives array<string>"), skills,
                                      spark.createDataFrame([(l,) for l in covered], "label string"), n, vectors, tile_rows=25, light=light)
    assert {(r["target_id"], r["label"], r["rank"]) for r in got.collect()} == expected


def test_empty(spark):
    none = spark.createDataFrame([], "label string, occupations array<string>")
    assert groups.cooccurring_by_group(none, none).count() == 0
    some = spark.createDataFrame([("a", [])], "label string, occupations array<string>")
    assert groups.cooccurring_by_group(some, none).count() == 0
    targets = spark.createDataFrame([(1, ["a"])], "target_id long, positives array<string>")
    assert groups.group_hard_negatives(targets, some, some.select("label")).count() == 0


def test_packed_counts():
    rng = random.Random(2)
    sets = [[rng.sample(range(13_000), rng.choice([0, 1, 40, 3_000, 9_000])) for _ in range(n)] for n in (23, 31)]

    def column(rows):
        pieces = [{x // PIECE: [y % PIECE for y in row if y // PIECE == x // PIECE] for x in {z - z % PIECE for z in row}} for row in rows]
        packed = [[{"block": k, "items": pack_pieces(pa.array([v], pa.list_(pa.int32())))[0].as_py()} for k, v in p.items()] for p in pieces]
        return pa.array(packed, pa.list_(pa.struct([("block", pa.int64()), ("items", pa.binary())])))

    a, b = map(column, sets)
    assert max(len(x["items"]) for row in a.to_pylist() for x in row) == PIECE // 8
    count = packed_counts(a, b)
    assert (np.vstack([count(slice(0, 9)), count(slice(9, 23))]) == [[len(set(x) & set(y)) for y in sets[1]] for x in sets[0]]).all()


def test_sets_of_many_groups_are_packed(spark):
    """No names of groups go to the tiles: a set of 20,000 groups takes some KB there."""
    df = spark.createDataFrame([(f"l{i}", [f"occupation {i % 2}{g}" for g in range(20_000)]) for i in range(4)], "id string, groups array<string>")
    split = groups.Split(df, df, 1)
    rows = split.packed(df).collect()
    assert [r["size"] for r in rows] == [20_000] * 4 and len({str(r.groups) for r in rows}) == 2
    assert max(sum(len(p["items"]) for p in r.groups) for r in rows) <= 40_000 < sum(map(len, df.first().groups))
    assert groups._tile_rows(split.packed(df), 1_000_000) < 1_000_000


@pytest.mark.parametrize("use_vectors", [False, True])
def test_labels_are_tried_from_the_highest_score_down(spark, monkeypatch, use_vectors):
    """Few different sets of groups, so that many labels share one and tie: as by brute force, and rows with equal sets go to their tile with one key, to be counted once."""
    import numpy as np
    rng = np.random.default_rng(11)
    sides, kept = [], groups.tiled
    monkeypatch.setattr(groups, "tiled", lambda *a: sides.append((a[0], a[2], a[6])) or kept(*a))
    sets = [["g1"], ["g1", "g2"], ["g2", "g3"], ["g1", "g2", "g3"], ["g4"]]
    words = ["red", "blue", "bolt", "plate"]
    skills = {f"{' '.join(rng.choice(words, rng.integers(1, 4), replace=False))} {i:03d}": (sets[rng.integers(len(sets))], np.round(rng.normal(size=4), 3).tolist()) for i in range(150)}
    names = sorted(skills)
    covered = [x for x in names if x < "p"]
    targets = {i: [names[j] for j in rng.choice(len(names), rng.integers(1, 3), replace=False)] for i in range(40)}
    got = groups.group_hard_negatives(spark.createDataFrame(list(targets.items()), "target_id long, positives array<string>"),
                                      spark.createDataFrame([(k, *v) for k, v in skills.items()], "label string, occupations array<string>, vector array<double>"),
                                      spark.createDataFrame([(x,) for x in covered], "label string"), 3, use_vectors, tile_rows=16, light=5)
    found = {}
    for r in got.orderBy("target_id", "rank").collect():
        found.setdefault(r.target_id, []).append((r.label, round(r.score, 6)))
    unit = {k: np.array(v[1]) / np.linalg.norm(v[1]) for k, v in skills.items()}
    for i, pos in targets.items():
        have, mine, want = set().union(*[skills[p][0] for p in pos]), set(" ".join(pos).split()), []
        for x in names:
            o, w = len(have & set(skills[x][0])), len(mine & set(x.split()))
            if x not in pos and o and w <= 2:
                dist = 1 - max(round(float(unit[p] @ unit[x]), 9) for p in pos) if use_vectors else 1 - w / max(len(mine), len(x.split()))
                want.append((x, round(2 * o + (min(5 * dist, 3) if dist >= 0.63 else 0) + (w <= 1) + 0.5 * (x in covered), 6)))
        assert found.get(i, []) == sorted(want, key=lambda t: (-t[1], t[0]))[:3]
    (left, right, tile_rows), = sides
    assert tile_rows == (16, 16 * groups.LABEL_ROWS)
    assert right.select("key").distinct().count() == len(sets) and left.count() == len(targets)
