"""Stores that several jobs write to, calls in flight, and distributions over all pairs."""
import os
import random
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.operators import distribution, generation, similarity as sim


def items(spark, names):
    return spark.createDataFrame([(n, f"about {n}") for n in names], "label string, description string")


def encode(df, column):
    return sim.hashing_embed(df, column, 8)


def test_interleaved_fills_leave_one_row_each(spark, tmp_path):
    """The second fill commits while the first one is still encoding."""
    first, second = (sim.EmbeddingCache(spark, str(tmp_path), "m") for _ in range(2))
    names = [f"n{i}" for i in range(40)]

    def slow(df, column):
        assert second.fill(items(spark, names[10:30]), encode) == 20
        return encode(df, column)

    assert first.fill(items(spark, names[:20]), slow) == 10
    table = first.table().collect()
    assert len(table) == 30 and len({r.text_id for r in table}) == 30
    assert first.embed(items(spark, names + names[:5]), encode).count() == 45
    assert first._manifest()[0] == 3 and first.fill(items(spark, names), encode) == 0 and first._manifest()[0] == 3
    assert not second._commit(3, ["other"]) and len(first._manifest()[1]) == 3


def test_uncommitted_folders_do_not_count(spark, tmp_path):
    cache = sim.EmbeddingCache(spark, str(tmp_path), "m")
    cache._write(encode(cache.misses(items(spark, ["a", "b"])), "text"))
    assert cache.table().count() == 0 and cache.fill(items(spark, ["a"]), encode) == 1 and cache.table().count() == 1


def test_calls_in_flight(spark):
    """Eight calls of a slow backend at a time in each partition; order and reasons are kept."""
    def backend():
        lock, now = threading.Lock(), [0, 0]

        def ask(prompt):
            with lock:
                now[0] += 1
                now[1] = max(now)
            time.sleep(0.05)
            with lock:
                now[0] -= 1
            if prompt == "bad":
                raise KeyError("no such thing")
            return f"{prompt} {now[1]}"
        return ask

    x = spark.createDataFrame([(i, f"p{i}") for i in range(40)] + [(99, "bad")], "id int, prompt string").coalesce(1)
    got = {r.id: r for r in generation.generate(x, backend, tries=2, delay=0.0, in_flight=4).collect()}
    assert len(got) == 41 and all(got[i].text.split()[0] == f"p{i}" for i in range(40))
    assert 1 <= max(int(got[i].text.split()[1]) for i in range(40)) <= 4
    assert got[99].status == "failed" and "no such thing" in got[99].error and got[99].text is None
    assert generation.generate(x.limit(0), backend).count() == 0


def test_stored_answers_are_not_asked_again(spark, tmp_path):
    """An attempt that is killed half way leaves its complete parts; the next one asks only for the rest."""
    calls, store = str(tmp_path / "calls"), str(tmp_path / "store")
    os.mkdir(calls)

    def backend():
        def ask(prompt):
            with open(os.path.join(calls, prompt), "a") as f:
                f.write("x")
            if prompt == "p3" and not os.path.exists(calls + ".calm"):
                raise RuntimeError("busy")
            return prompt.upper()
        return ask

    x = spark.createDataFrame([(i, f"p{i}") for i in range(30)], "request_id int, prompt string")
    part = F.pmod(F.xxhash64("request_id"), F.lit(5))
    generation.generate_stored(x.where(part < 3), backend, store, rounds=5, tries=1)  # ended after three of five parts
    asked = set(os.listdir(calls))
    open(calls + ".calm", "w").close()
    got = {r.request_id: r for r in generation.generate_stored(x, backend, store, rounds=5, tries=1).collect()}
    assert len(got) == 30 and all(got[i].text == f"P{i}" and got[i].status == "ok" for i in range(30))
    assert all(len(open(os.path.join(calls, p)).read()) == (2 if p == "p3" and "p3" in asked else 1) for p in os.listdir(calls))


@pytest.mark.parametrize("tile_rows", [7, 2048])
def test_distribution_over_all_pairs(spark, tile_rows):
    rng = np.random.default_rng(3)
    vectors = {f"l{i}": rng.normal(size=5) for i in range(60)} | {"zero": np.zeros(5)}
    r = random.Random(1)
    member = {g: r.sample(sorted(vectors), n) for g, n in (("a", 40), ("b", 9), ("c", 2), ("d", 1))}
    unit = {k: v / (np.linalg.norm(v) or 1) for k, v in vectors.items()}
    s = [unit[x] @ unit[y] for m in member.values() for i, x in enumerate(m) for y in m[:i]]
    v = spark.createDataFrame([(k, x.tolist()) for k, x in vectors.items()], "label string, vector array<double>")
    g = spark.createDataFrame([(x, k) for k, m in member.items() for x in m + m[:1]], "label string, occupation string")
    got = distribution.group_similarities(v, g, tile_rows).first()
    assert got.n == len(s) and abs(got["mean"] - np.mean(s)) < 1e-9 and abs(got["std"] - np.std(s)) < 1e-9
    for name, q in (("min", 0), ("p10", .1), ("p25", .25), ("median", .5), ("p50", .5), ("p75", .75), ("p90", .9), ("max", 1)):
        assert abs(got[name] - np.quantile(s, q)) < 2e-9
    every = distribution.group_similarities(v, None, tile_rows).first()
    assert every.n == 61 * 60 // 2
    none = distribution.group_similarities(v, g.where("occupation = 'd'"), tile_rows).first()
    assert none.n == 0 and none["mean"] is None and none["p50"] is None


def test_column_quantiles(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=500), np.full(300, 0.125), [1e3, -1e3]])
    n, got = distribution.column_quantiles(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double"), "v", (0, .3, .5, .99, 1))
    assert n == len(x) and np.allclose(got, np.quantile(x, (0, .3, .5, .99, 1)), atol=2e-9)
    assert distribution.column_quantiles(spark.createDataFrame([], "v double"), "v", (.5,)) == (0, [None])


@pytest.mark.parametrize("skipped_rows", [0, 2, 64])
@pytest.mark.parametrize("k, close", [(3, 0.6), (500, 0.9), (2, -1.0)])
def test_mining_in_one_pass(spark, skipped_rows, k, close):
    """Counts of the walk, whether or not a tile can hand on what it skipped."""
    rng = np.random.default_rng(k)
    base = rng.normal(size=(6, 4))
    vec = {f"v{i:03d}": (base[i % 6] + .4 * rng.normal(size=4)) for i in range(90)}
    unit = {x: v / np.linalg.norm(v) for x, v in vec.items()}
    names = sorted(vec)
    samples = [(i, names[i], names[i::30][:2], names[i + 1::25][:2]) for i in range(20)] + [(99, names[5], [], ["v001"])]
    df = spark.createDataFrame([(i, vec[q].tolist(), p, n) for i, q, p, n in samples], "sample_id long, vector array<double>, pos array<string>, neg array<string>")
    pool = spark.createDataFrame([(x, v.tolist()) for x, v in vec.items()], "label string, vector array<double>")
    got = {r.sample_id: r for r in sim.mine_hard_negatives(df, pool, k, close, tile_rows=20, skipped_rows=skipped_rows).collect()}
    for i, q, pos, neg in samples[:-1]:
        order = sorted(names, key=lambda x: (-round(float(unit[q] @ unit[x]), 9), x))
        seen = used = near = 0
        new = []
        for x in order:
            if len(new) == k:
                break
            seen += 1
            if x in pos or x in neg:
                used += 1
            elif max(round(float(unit[p] @ unit[x]), 9) for p in pos) >= close:
                near += 1
            else:
                new.append(x)
        r = got[i]
        assert (r.candidates, r.excluded_used, r.excluded_by_positive_similarity, r.neg[len(set(neg)):]) == (seen, used, near, new)
    assert got[99].neg == ["v001"] and got[99].candidates is None
