"""The inverted file against brute force."""
import numpy as np
import pytest

from labelloom.operators import inverted, similarity

SCHEMA = "corpus_id long, vector array<double>"


def clustered(n, groups=6, dim=8, spread=0.15, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return [(i, (centres[i % groups] + spread * rng.normal(size=dim)).tolist()) for i in range(n)]


def brute(queries, corpus, k, normalise=True, exclude=False):
    def unit(v):
        n = np.linalg.norm(v)
        return np.array(v) / n if normalise and n > 0 else np.array(v)
    out = set()
    for q, v in queries:
        scored = sorted((-round(float(unit(v) @ unit(w)), 9) + 0.0, c) for c, w in corpus if w is not None and not (exclude and c == q))
        out |= {(q, c, rank, -s) for rank, (s, c) in enumerate(scored[:k], 1)}
    return out


def rows(df):
    return {(r["query_id"], r["corpus_id"], r["rank"], r["score"]) for r in df.collect()}


def same(got, expected):
    assert {x[:3] for x in got} == {x[:3] for x in expected}
    scores = {x[:3]: x[3] for x in expected}
    assert all(abs(x[3] - scores[x[:3]]) < 2e-9 for x in got)


@pytest.mark.parametrize("normalise", [True, False])
@pytest.mark.parametrize("tile_rows, cells, probes", [(8192, None, None), (7, 5, 1), (50, 1, 1), (8192, 64, 3)])
def test_exact_search_equals_brute_force(spark, normalise, tile_rows, cells, probes):
    data = clustered(150)
    data += [(1000, [0.0] * 8), (1001, data[3][1]), (1002, data[3][1]), (1003, [-x for x in data[3][1]])]  # zero, repeats, the opposite
    corpus = spark.createDataFrame(data + [(1004, None)], SCHEMA)
    file = inverted.InvertedFile(corpus, cells=cells, normalise=normalise, tile_rows=tile_rows)
    asked = data[::7] + [(1000, [0.0] * 8), (1001, data[3][1])]
    queries = spark.createDataFrame(asked + [(7777, None)], "query_id long, vector array<double>").dropDuplicates(["query_id"])
    asked = {q: v for q, v in asked}.items()
    same(rows(file.topk(queries, 9, exclude_same=True, probes=probes)), brute(asked, data, 9, normalise, True))
    same(rows(file.topk(queries, 500, probes=probes)), brute(asked, data, 500, normalise))


def test_clusters_are_skipped(spark):
    data = clustered(600, groups=12, spread=0.03)
    file = inverted.InvertedFile(spark.createDataFrame(data, SCHEMA), cells=12)
    queries = spark.createDataFrame(data[:60], "query_id long, vector array<double>")
    visited = file.visited(queries, 5, exclude_same=True, probes=1).collect()
    assert len(visited) == 60 and np.mean([r["share"] for r in visited]) < 0.4
    same(rows(file.topk(queries, 5, exclude_same=True, probes=1)), brute(data[:60], data, 5, exclude=True))
    assert int(file.cells.sizes.sum()) == 600


def test_approximate_search_reaches_its_recall(spark):
    data = clustered(800, groups=20, spread=0.5, dim=6, seed=4)
    file = inverted.InvertedFile(spark.createDataFrame(data, SCHEMA), cells=25)
    queries = spark.createDataFrame(data[::10], "query_id long, vector array<double>")
    for wanted in (0.5, 0.9, 1.0):
        probes, measured = file.probes_for(queries, 10, wanted, check=80, exclude_same=True)
        found = rows(file.topk(queries, 10, exclude_same=True, probes=probes, exact=False))
        true = brute(data[::10], data, 10, exclude=True)
        recall = len({x[:2] for x in found} & {x[:2] for x in true}) / len(true)
        assert measured >= wanted and abs(recall - measured) < 1e-9


def test_one_crowded_cell_is_cut(spark):
    data = [(i, [1.0, 0.0]) for i in range(300)] + [(1000, [0.0, 1.0])]
    file = inverted.InvertedFile(spark.createDataFrame(data, SCHEMA), tile_rows=16)
    got = rows(file.topk(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id long, vector array<double>"), 3))
    same(got, brute([(1, [1.0, 0.0]), (2, [0.0, 1.0])], data, 3))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, vector array<double>")
    assert inverted.InvertedFile(none).topk(queries, 3).count() == 0
    some = inverted.InvertedFile(spark.createDataFrame([(5, [1.0, 2.0])], SCHEMA))
    assert some.topk(queries.limit(0), 3).count() == 0 and some.topk(queries, 3).count() == 1
    assert some.probes_for(queries.limit(0)) == (1, 1.0)


def test_recall_holds_for_all_queries(spark):
    """A recall that just holds for 20 drawn queries (these: 9 cells) is 0.894 over all of them."""
    m = np.random.default_rng(5).normal(size=(3000, 12))
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(3000)], "id long, vector array<double>")
    true = similarity.topk_similar(df, df, 10, exclude_same=True, query_id="id", corpus_id="id").select("query_id", "corpus_id")
    file = inverted.InvertedFile(df, "id")
    probes, _ = file.probes_for(df, 10, 0.9, check=20, exclude_same=True, query_id="id", seed=3)
    found = file.topk(df, 10, exclude_same=True, query_id="id", probes=probes, exact=False).select("query_id", "corpus_id")
    assert found.join(true, ["query_id", "corpus_id"]).count() >= 0.9 * 30_000


def test_tiles_of_vectors_grow_to_their_bytes():
    """360,000 vectors make 36 pairs of tiles; with tiles of 8,192 rows each vector was sent 44 times."""
    from inspect import signature

    from labelloom.operators import tiles
    rows = signature(similarity.topk_similar).parameters["tile_rows"].default
    assert tiles.grid(360_000, 360_000, rows, 12) == (6, 6)
    assert rows * 64 * 8 <= tiles.TILE_BYTES


def test_cells_travel_in_bundles(spark):
    """A query was sent to each of its cells, and brought up to k rows back from each."""
    assert inverted.bundles(np.array([3, 0, 4, 9, 2, 2, 25, 1]), 10) == [(0, 3, 1), (3, 4, 1), (4, 6, 1), (6, 7, 3), (7, 8, 1)]
    assert inverted.bundles(np.array([30, 30]), 10) == [(0, 1, 3), (1, 2, 3)] and inverted.bundles(np.zeros(3, int), 10) == [(0, 3, 1)]
    m = np.random.default_rng(2).normal(size=(100, 8))
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(100)], SCHEMA)
    file = inverted.InvertedFile(df, cells=49, tile_rows=60)
    assert len(file.bundles) == 2
    queries = df.withColumnRenamed("corpus_id", "query_id")
    assert file._search(queries, 10, False, 49).count() <= 100 * 10 * 2


def test_equal_ids_are_all_left_out(spark):
    data = [(i % 40, [float(i % 7), float(i % 11) + 1]) for i in range(120)]
    file = inverted.InvertedFile(spark.createDataFrame(data, SCHEMA), cells=4, tile_rows=50)
    queries = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(40)], "query_id long, vector array<double>")
    found = file.topk(queries, 500, exclude_same=True).collect()
    assert len(found) == 40 * 117 and all(r["query_id"] != r["corpus_id"] for r in found)
