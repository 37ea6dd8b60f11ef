"""K12 and G9 at size: the ranks behind a report are worked out once, and compared in single precision without a change to them."""
import numpy as np
import pytest

from labelloom.operators import evaluation, similarity as sim


def test_a_report_works_its_ranks_out_once(spark):
    n = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            n.add(batch.num_rows)
            yield batch

    ranks = spark.createDataFrame([(i, i % 5 + 1, "T1" if i % 3 else "S1") for i in range(30)], "sample_id long, best_rank long, topic string")
    report = evaluation.evaluation_report(ranks.mapInArrow(seen, ranks.schema), ["topic"], 4)
    assert report["overall"].first()["count"] == 30 and {r.bucket for r in report["breakdowns"].collect()} == {"T1", "S1"}
    assert [r.sample_id for r in report["details"].collect()] == [0, 1, 2, 3] and report["categories"].count() == 2
    assert n.value == 30


@pytest.mark.parametrize("normalise", [True, False])
def test_ranks_of_scores_that_single_precision_cannot_tell_apart(spark, normalise):
    rng = np.random.default_rng(3)
    base = rng.normal(size=8)
    pool = [(f"p{i:03d}", (base + rng.choice([0, 1e-9, 1e-8, 1e-7, 1e-3]) * rng.normal(size=8)).tolist()) for i in range(120)] + [("zero", [0.0] * 8), ("far", (-base).tolist())]
    samples = [(i, (base + 1e-4 * rng.normal(size=8)).tolist(), [pool[j][0] for j in rng.choice(120, 1 + i % 4, replace=False)]) for i in range(30)]
    got = sim.rank_positives(spark.createDataFrame(samples, "sample_id long, vector array<double>, pos array<string>"),
                             spark.createDataFrame(pool, "label string, vector array<double>"), normalise, tile_rows=50)
    m, names = np.array([v for _, v in pool]), [x for x, _ in pool]
    unit = (lambda v: v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-300)) if normalise else (lambda v: v)
    want = {}
    for i, v, pos in samples:
        s = np.round(unit(m) @ unit(np.array(v)), 9)
        want |= {(i, p): 1 + int((s > s[names.index(p)]).sum()) for p in pos}
    assert {(r.sample_id, r.label): r["rank"] for r in got.collect()} == want
