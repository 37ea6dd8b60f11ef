"""Edge cases on hand-made rows: ties, nulls, duplicates, empty arrays, padded labels, malformed input."""
import json
import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.functions import payloads as pl, text as tx
from labelloom.functions.arrays import chunk_sequential
from labelloom.functions.ranking import global_rank
from labelloom.operators import balance, classify, dedup, evaluation, fuzzy, generation, pairs, relations, samples as op, similarity as sim, stats
from labelloom.sources import readers, writers


def one(spark, col, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(col.alias("x")).first().x


def samples(spark, rows):
    return spark.createDataFrame([(i, i, *r) for i, r in enumerate(rows)], "sample_id long, row_no long, query string, pos array<string>, neg array<string>")


# --- sources --------------------------------------------------------------------------------------

def test_read_formats(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"query": "a", "pos": ["x"], "neg": [], "meta": {"source": "s", "k": 1}}, {"query": "b", "pos": [], "neg": []}], indent=1))
    (tmp_path / "b.json").write_text('\n{"query": "c", "pos": ["ü"], "neg": ["n"]}\n\n{"query": broken\n{"query": "c", "pos": ["ü"], "neg": ["n"]}\n')
    (tmp_path / "c.json").write_text('{\n "query": "d",\n "pos": ["y"],\n "neg": []\n}')
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.json").write_text('{"query": "hidden", "pos": [], "neg": []}')
    loaded = readers.read_directories(spark, [str(tmp_path)])
    assert sorted(r.query for r in loaded.rows.collect()) == ["a", "b", "c", "c", "d"]
    assert loaded.rejected.select("record").first().record.strip() == '{"query": broken'
    meta = loaded.rows.where("query = 'a'").select("meta.source", "meta.extra").first()
    assert meta.source == "s" and meta.extra == {"k": "1"}
    with pytest.raises(ValueError):
        readers.read_samples(spark, str(tmp_path / "c.json"), variant="gen")
    (tmp_path / "e.json").write_text("\n")
    with pytest.raises(ValueError):
        readers.read_samples(spark, str(tmp_path / "e.json"))


def test_write_round_trip(spark, tmp_path):
    df = samples(spark, [("ä", ["x"], []), ("b", [], ["n"])])
    writers.write_samples(df, str(tmp_path / "out"))
    back = readers.read_jsonl(spark, str(tmp_path / "out")).rows
    assert sorted((r.query, tuple(r.pos), tuple(r.neg)) for r in back.collect()) == [("b", (), ("n",)), ("ä", ("x",), ())]
    writers.write_samples(df, str(tmp_path / "arr.json"), fmt="array")
    parts = [json.loads(p.read_text(encoding="utf-8")) for p in (tmp_path / "arr.json").glob("part-*")]
    assert sorted(x["query"] for part in parts for x in part) == ["b", "ä"]
    assert readers.read_samples(spark, str(tmp_path / "arr.json")).rows.count() == 2


def test_sample_ids_do_not_depend_on_packing(spark, tmp_path):
    for n in range(4):
        (tmp_path / f"f{n}.jsonl").write_text("".join(json.dumps({"query": f"q{i % 7}", "pos": ["a"], "neg": []}) + "\n" for i in range(20)), encoding="utf-8")
    name, found = "spark.sql.files.maxPartitionBytes", []
    for size in ("128m", "200"):
        spark.conf.set(name, size)
        found.append(sorted(r.sample_id for r in readers.read_jsonl(spark, str(tmp_path)).rows.collect()))
    spark.conf.unset(name)
    assert found[0] == found[1] and len(set(found[0])) == 80


def test_skills_csv_last_wins(spark, tmp_path):
    (tmp_path / "s.csv").write_text('preferredLabel,title,description,isEssentialForOccupations,isOptionalForOccupations,skillType\n'
                                    ' a ,,first,x|y,,k\n,b,"two\nlines","[{""title"": "" p ""}]","[""q"", ""p""]",k\na,,second,bad [json|z,,k\n,,none,,,k\n')
    got = {r.label: r for r in readers.read_skills_csv(spark, str(tmp_path / "s.csv")).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].description == "second" and got["a"].occupations == ["bad [json", "z"]
    assert got["b"].description == "two\nlines" and got["b"].occupations == ["p", "q"]


@pytest.mark.parametrize("record,reason", [
    ('{"query": "a", "pos": [], "neg": ["x"]}', None), ('{"query": "a", "pos": [], "neg": [], "meta": null}', None),
    ('{"query": null, "pos": [], "neg": []}', "query is not a string"), ('{"query": "a", "neg": []}', "pos is not a list of strings"),
    ('{"query": "a", "pos": ["x", 1], "neg": []}', "pos is not a list of strings"), ('{"query": "a", "pos": [], "neg": "n"}', "neg is not a list of strings"),
    ('{"query": "a", "pos": [null], "neg": []}', "pos is not a list of strings"),
    ('{"query": "a", "pos": [], "neg": [], "meta": 3}', "meta is not an object"), ("[]", "not an object"), ("{", "not json")])
def test_validate(spark, record, reason):
    assert one(spark, readers.reject_reason(F.col("r")), r=record) == reason


def test_target_labels(spark):
    rows = spark.createDataFrame([('["a", 1, "b"]',), ('{"skills": ["c", null]}',)], "value string")
    assert sorted(r.label for r in readers.target_labels(rows).collect()) == ["a", "b", "c"]


# --- texts ----------------------------------------------------------------------------------------

def test_clean_text(spark):
    assert one(spark, tx.clean_text(F.col("t")), t=" See HTTP://x.y/z  a@b.de www.q Ende\n") == "see ende"


def test_words_split_on_unicode_blanks(spark):
    assert one(spark, tx.word_count(F.col("t")), t="a b c\x0bd e​f") == len("a b c\x0bd e​f".split())
    assert one(spark, tx.word_count(F.col("t")), t="  ") == 0


def test_bullets(spark):
    assert one(spark, tx.bullets(F.col("t")), t="- one\n\n  2. two \r\n•• three\n - \nfour 5") == ["one", "two", "three", "four 5"]


def test_cut_to_length(spark):
    cut = tx.cut_to_length(F.col("t"), 20)
    assert one(spark, cut, t="short") == "short"
    assert one(spark, cut, t="aaaa bbbb cccc, dddd eeee") == "aaaa bbbb cccc."
    assert one(spark, cut, t="x" * 30) is None
    assert one(spark, cut, t="aa bbbbbbbbbbbbbbbbbbbbbbbbbb") is None


def test_occupations(spark):
    cases = {None: [], " ": [], '[{"title": " a "}, "b", {"x": 1}, "", 3]': ["a", "b"], '{"title": "a"}': [], "a | b||": ["a", "b"], "7": []}
    for cell, want in cases.items():
        assert one(spark, pl.parse_occupations(F.col("c")), c=cell) == want


def test_extract_json(spark):
    found = pl.extract_json(F.col("t"))
    assert json.loads(one(spark, found, t='Here:\n```json\n{"a": 1}\n```')) == {"a": 1}
    assert json.loads(one(spark, found, t='x ```\n{"a": 2}\n``` y')) == {"a": 2}
    assert json.loads(one(spark, found, t='say `{"a": 3}` now')) == {"a": 3}
    assert json.loads(one(spark, found, t='so {"a": {"b": 4}} end')) == {"a": {"b": 4}}
    assert json.loads(one(spark, found, t='{bad}\n  {\n"a": 5\n}\nrest }')) == {"a": 5}
    assert one(spark, found, t="nothing") is None


@pytest.mark.parametrize("payload,want", [
    ('{"predictions": [{"skill": "a", "score": 1}, {"name": "b", "score": "0.5"}, {"skill": "c"}, 4]}', [("a", 1.0), ("b", 0.5)]),
    ('{"skills": ["a", "b", "c"], "scores": [0.1, 0.2]}', [("a", 0.1), ("b", 0.2)]), ('[{"name": "a", "score": 2}]', [("a", 2.0)]),
    ('{"results": [{"name": "a", "score": 2}, {"skill": "b", "score": 3}]}', [("b", 3.0)]), ("{}", []), ("broken", None)])
def test_predictions_json(spark, payload, want):
    got = one(spark, pl.parse_predictions_json(F.col("p")), p=payload)
    assert [(r.title, r.score) for r in got or []] == (want or [])


# --- samples and joins ----------------------------------------------------------------------------

def test_merge_keeps_single_rows_untouched(spark):
    df = samples(spark, [("q", ["b", "a"], ["z"]), ("single", ["y", "y", "x"], []), ("q", ["c", "a"], [])])
    got = {r.query: r for r in dedup.merge_duplicates(df).collect()}
    assert got["q"].pos == ["a", "b", "c"] and got["q"].neg == ["z"] and got["q"].row_no == 0
    assert got["single"].pos == ["y", "y", "x"] and got["single"].n == 1


def test_enrich(spark):
    skills = spark.createDataFrame([("a", "alpha"), ("b", None)], "label string, description string")
    df = samples(spark, [("q", [" a ", "miss", "b"], ["miss ", "a"]), ("e", [], [])])
    got = {r.query: r for r in relations.enrich_labels(df, skills, pos_fallback=True, neg_fallback=False).collect()}
    assert got["q"].pos == ["a: alpha", "miss", "b"] and got["q"].neg == ["a: alpha"]
    assert got["e"].pos == [] and got["e"].neg == []


def test_cooccurrence_counts_repeats(spark):
    got = {(r.label, r.other): r.n for r in relations.label_cooccurrence(samples(spark, [("q", ["a", "a", "b"], [])])).collect()}
    assert got == {("a", "b"): 2, ("b", "a"): 2}


def test_qrels_prefix(spark):
    corpus = spark.createDataFrame([(1, "a"), (2, "a: b"), (3, "c")], "corpus_id long, title string")
    df = samples(spark, [("q", ["a: b: text", "c", "cc: x"], [])])
    assert sorted(r.corpus_id for r in relations.resolve_qrels(df, corpus).collect()) == [1, 2, 3]
    assert sorted(r.corpus_id for r in relations.resolve_qrels(df, corpus, prefix=False).collect()) == [3]


def test_fuzzy_matches_difflib(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(5, 60))) for _ in range(25)]
    texts = base[:5] + [b[:i % 7] + "x" + b[i % 7:] for i, b in enumerate(base)] + ["".join(rng.sample(b, len(b))) for b in base]
    df = samples(spark, [(t, [], []) for t in texts])
    real = spark.createDataFrame([(b,) for b in base], "query string")
    got = {r.query: r.source for r in fuzzy.annotate_fuzzy(df, real, 0.95).collect()}
    for t in texts:
        best = max(SequenceMatcher(None, t, b).ratio() for b in base)
        assert got[t] == ("real" if best >= 0.95 else "synthetic")


def test_fuzzy_compares_few_pairs():
    """Long texts of the same words: nearly equal counts of characters, but hardly a pair that needs matching; verdicts as difflib's, with its junk rule for long texts."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopäöüßéè") for _ in range(rng.randint(2, 9))) for _ in range(300)] + [chr(0x400 + i) for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(150)) for _ in range(30)]
    texts = [" ".join(rng.choice(words) for _ in range(150)) for _ in range(20)] + [b[:50] + "Q" + b[55:] for b in base[:4]] + [b[200:] + b[:200] for b in base[:4]]
    texts += [" ".join(w if rng.random() < 0.95 else rng.choice(words) for w in b.split(" ")) for b in base[:20]]
    found = fuzzy.candidates(texts, base, 0.95)
    assert sum(map(len, found)) <= 2 * len(texts)
    verdicts = set()
    for threshold in (0.5, 0.9, 0.95, 1):
        near = fuzzy.candidates(texts, base, threshold)
        for i, t in enumerate(texts):
            for j in sorted({*range(0, len(base), 7), i % len(base), (i - 20) % len(base), (i - 28) % len(base)}):
                want = SequenceMatcher(None, t, base[j]).ratio() >= threshold
                verdicts.add(want)
                assert fuzzy.reaches(t, base[j], threshold) == want and (not want or j in near[i] and fuzzy.in_place(t, base[j], threshold))
    assert verdicts == {True, False}


def test_embed_turns_few_texts_into_strings(spark):
    """A batch is handed on in parts, each with its own vectors; nulls reach the encoder."""
    df = spark.range(3000).coalesce(1).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("text"))
    encoder = (lambda: lambda texts: np.array([[len(texts) <= 40, 0.0 if t is None else int(t)] for t in texts]))
    got = sim.embed(df, "text", encoder, batch=40, normalise=False)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert {r.id: list(r.vector) for r in got.collect()} == {i: [1.0, float(i if i % 7 else 0)] for i in range(3000)}


# --- vectors --------------------------------------------------------------------------------------

def vectors(spark, n, dim=8, seed=0, ties=True):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    if ties:
        m[n // 2:] = m[: n - n // 2]
    return m, spark.createDataFrame([(f"{i:04d}", m[i].tolist()) for i in range(n)], "label string, vector array<float>")


@pytest.mark.parametrize("tiles", [16, 1000])
def test_topk_with_ties_and_many_tiles(spark, tiles):
    m, df = vectors(spark, 60)
    q = df.withColumnRenamed("label", "query_id")
    got = sim.topk_similar(q, df, 7, corpus_id="label", tile_rows=tiles).collect()
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    for i in range(60):
        want = sorted(range(60), key=lambda j: (-s[i, j], j))[:7]
        mine = [r.corpus_id for r in sorted((r for r in got if r.query_id == f"{i:04d}"), key=lambda r: r.rank)]
        assert mine == [f"{j:04d}" for j in want]


@pytest.mark.parametrize("threshold", [0.2, 2.0, -1.0])
def test_mining_equals_the_walk(spark, threshold):
    m, pool = vectors(spark, 50, ties=False)
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    rows = [(i, m[i].tolist(), [f"{(i + 1) % 50:04d}", " x "] if i else [], [f"{(i + 2) % 50:04d} "]) for i in range(50)]
    df = spark.createDataFrame(rows, "sample_id int, vector array<float>, pos array<string>, neg array<string>")
    got = {r.sample_id: r for r in sim.mine_hard_negatives(df, pool, 4, threshold, tile_rows=16).collect()}
    assert got[0].neg == ["0002 "] and got[0].hard_negatives_added is None
    for i in range(1, 50):
        used, p = {(i + 1) % 50, (i + 2) % 50}, (i + 1) % 50
        picks, seen, close, skipped = [], 0, 0, 0
        for j in sorted(range(50), key=lambda j: (-s[i, j], j)):
            seen += 1
            if j in used:
                skipped += 1
            elif s[p, j] >= threshold:
                close += 1
            else:
                picks.append(j)
                if len(picks) == 4:
                    break
        assert got[i].neg == [f"{(i + 2) % 50:04d}"] + [f"{j:04d}" for j in picks]
        assert (got[i].candidates, got[i].excluded_used, got[i].excluded_by_positive_similarity) == (seen, skipped, close)


def test_chunk_by_similarity(spark):
    pool = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [0.99, 0.01]), ("d", [1.0, 0.02]), ("e", [1.0, 0.0])], "label string, vector array<float>")
    df = samples(spark, [("q", ["a", "b", "no vector", "c", "d", "e"], []), ("r", ["u", "v", "w", "x"], [])])
    got = {r.sample_id: r.chunks for r in sim.chunk_by_similarity(df, pool, 3, 0.88).collect()}
    assert got[0] == [["a", "c", "d"], ["b"], ["e"]] and got[1] == [["u", "v", "w"], ["x"]]


def test_embedding_cache(spark, tmp_path):
    cache = sim.EmbeddingCache(spark, str(tmp_path), "model")
    items = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None)], "label string, description string")
    encode = (lambda df, col: sim.hashing_embed(df, col, 8))
    assert cache.fill(items, encode) == 2 and cache.fill(items, encode) == 0
    assert cache.embed(items, encode).count() == 3
    assert cache.lookup_stats(items).first().hit_rate == 1.0
    cache.clear()
    assert cache.table().count() == 0 and sim.cache_stats(cache.table().select(F.lit(True).alias("hit"))).first().hit_rate == 0


# --- balancing ------------------------------------------------------------------------------------

def test_cap_multi_label_equals_the_greedy_walk(spark):
    rng = random.Random(3)
    rows = [("q", [rng.choice("aaabbcdefg") for _ in range(rng.randint(1, 5))], []) for _ in range(200)]
    limit = 40
    count = {}
    for _, p, _ in rows:
        for l in p:
            count[l] = count.get(l, 0) + 1
    over = {l for l, n in count.items() if n > limit}
    multi = sorted(((i, [l for l in p if l in over]) for i, (_, p, _) in enumerate(rows) if sum(l in over for l in p) > 1), key=lambda x: -len(x[1]))
    removed = {}
    for i, ls in multi:
        hit = [l for l in ls if count[l] > limit]
        if hit:
            removed[i] = set(hit)
            for l in ls:
                count[l] -= 1
    got = {r.sample_id: set(r.labels) for r in balance.cap_multi_label(samples(spark, rows), limit, order_bucket=7).collect()}
    assert got == removed


def test_split_is_disjoint_and_meets_quotas(spark):
    rows = [(i, c, b) for i in range(300) for c in ({"A"} if i < 20 else {"B", "C"} if i % 3 else {"UNCLASSIFIED"}) for b in [["short", "medium", "long"][i % 3]]]
    df = spark.createDataFrame(rows, "sample_id int, category string, bucket string")
    chosen = balance.representative_split(df, ratio=0.1, minimum=5)
    ids = [r.sample_id for r in chosen.collect()]
    assert len(ids) == len(set(ids))
    n = {r.category: r["count"] for r in chosen.groupBy("category").count().collect()}
    size = {r.category: r["count"] for r in df.groupBy("category").count().collect()}
    assert all(n[c] == max(5, int(size[c] * 0.1)) for c in size)
    sized = balance.representative_split(df, ratio=None, eval_size=50, minimum=5)
    assert sized.count() == 50


def test_draw_count_shares(spark):
    x = spark.range(20000).select(balance.draw_count((F.col("id") + 0.5) / 20000, 3).alias("n")).groupBy("n").count().collect()
    got = {r.n: r["count"] / 20000 for r in x}
    assert abs(got[1] - 4 / 7) < 1e-3 and abs(got[2] - 2 / 7) < 1e-3 and abs(got[3] - 1 / 7) < 1e-3


def test_scenarios_do_not_repeat_in_a_cycle(spark):
    x = spark.range(27).select(balance.assign_scenario(F.lit("a"), F.col("id")).alias("s")).collect()
    for c in range(3):
        assert len({r.s for r in x[9 * c:9 * c + 9]}) == 9


def test_global_rank(spark):
    df = spark.createDataFrame([(i, round(random.Random(i).random(), 2)) for i in range(500)], "id int, score double")
    got = [r.id for r in global_rank(df, "score", "id", 1).orderBy("rank").collect()]
    assert got == [r.id for r in sorted(df.collect(), key=lambda r: (-r.score, r.id))]


# --- generation -----------------------------------------------------------------------------------

def groups_of(spark, labels, answer, n):
    df = spark.createDataFrame([(labels, answer)], "l array<string>, a string")
    return df.select(generation.reconcile_groups(F.col("l"), F.col("a"), n).alias("g")).first().g


def test_reconcile(spark):
    ask = (lambda gs: json.dumps({"groups": [{"labels": g} for g in gs]}))
    assert groups_of(spark, ["a", "b"], "junk", 3) == [["a", "b"]]
    assert groups_of(spark, ["a", "b", "c"], "junk", 2) is None
    assert groups_of(spark, list("abcd"), ask([["b", "zz", " a "], ["b"]]), 3) == [["b", "a"], ["c", "d"]]
    assert groups_of(spark, list("abcd"), ask([["a"], ["b"]]), 3) == [["a"], ["b", "c", "d"]]
    assert groups_of(spark, list("abcd"), "```json\n" + ask([]) + "\n```", 3) == [["a", "b", "c"], ["d"]]
    assert groups_of(spark, list("abcd"), '{"other": 1}', 3) is None


def test_accept(spark):
    rows = [(1, 1, " Suche nach: Guter Text", []), (1, 2, "zweiter", []), (2, 1, "guter text", []), (3, 1, "mit Verbot", ["VERBOT"]), (4, 1, "  ", []), (5, 1, "x" * 99, []), (6, 1, "Schon da", [])]
    cand = spark.createDataFrame(rows, "request_id int, cand_no int, text string, forbidden array<string>")
    known = spark.createDataFrame([("schon DA",)], "text string")
    got = {(r.request_id, r.cand_no): r for r in generation.accept(cand, 50, known).collect()}
    assert got[(1, 1)].accepted == "Guter Text" and got[(1, 1)].first_survivor and not got[(1, 2)].first_survivor
    assert [got[(i, 1)].reject_reason for i in (2, 3, 4, 5, 6)] == [None, "forbidden term", "blank", "too long", "existing text"]


def test_accept_between_requests(spark):
    rows = [(1, 1, "alpha", ["x"]), (1, 2, "beta", ["x"]), (1, 3, "Alpha", ["x"]), (2, 1, "beta", ["x", "y"]), (3, 1, "alpha", ["z"]), (4, 1, "BETA", ["y"]), (4, 2, "gamma", ["y"]), (5, 1, "gamma", ["y"]), (5, 2, "delta", ["y"])]
    cand = spark.createDataFrame([(*r[:3], [], r[3]) for r in rows], "request_id int, cand_no int, text string, forbidden array<string>, focus array<string>")
    known = spark.createDataFrame([(3, "delta"), (5, "nothing")], "request_id int, text string")
    got = {(r.request_id, r.cand_no): (r.reject_reason, r.first_survivor) for r in generation.accept(cand, 50, known).collect()}
    assert got == {(1, 1): (None, True), (1, 2): (None, False), (1, 3): ("repeated text", False), (2, 1): (None, True), (3, 1): (None, True),
                   (4, 1): ("repeated text", False), (4, 2): (None, True), (5, 1): ("repeated text", False), (5, 2): (None, True)}


def test_compress_result_reports_empty_answers(spark):
    df = samples(spark, [("long", ["a"], []), ("other", ["b"], []), ("never answered", ["c"], [])])
    answers = spark.createDataFrame([(0, " kurz "), (1, " ")], "sample_id long, text string")
    good, failed = generation.compress_result(df, answers)
    assert good.first().query == "kurz" and sorted((r.query, r.error) for r in failed.collect()) == [("never answered", "empty answer"), ("other", "empty answer")]


def test_fill_deficits_reaches_the_minimum(spark):
    df = samples(spark, [("q1", ["lab-a", "lab-b"], ["neg-1"]), ("q2", ["lab-a"], []), ("q3", ["lab-c", "lab-a"], [])])
    skills = spark.createDataFrame([("lab-b", "beta", ["job"])], "label string, description string, occupations array<string>")
    f = generation.fill_deficits(df, skills, 3)
    assert f.leftover.count() == 0
    after = df.select("pos").unionAll(f.samples.select("pos"))
    assert all(r.n == 3 for r in stats.label_frequency(after).collect())


# --- evaluation -----------------------------------------------------------------------------------

def test_metrics_by_hand(spark):
    preds = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (4, 10, 1)], "query_id int, corpus_id int, rank int")
    qrels = spark.createDataFrame([(1, 11), (1, 12), (1, 99), (2, 50), (3, 10)], "query_id int, corpus_id int")
    got = {r.query_id: r for r in evaluation.per_query_metrics(preds, qrels).collect()}
    assert set(got) == {1, 2, 3}
    g = got[1]
    assert g["accuracy@1"] == 0 and g["accuracy@3"] == 1 and g["precision@10"] == pytest.approx(0.2) and g["recall@3"] == pytest.approx(2 / 3)
    assert g["mrr@10"] == 0.5 and g["map@100"] == pytest.approx((1 / 2 + 2 / 3) / 3)
    idcg = sum(1 / np.log2(i + 1) for i in (1, 2, 3))
    assert g["ndcg@10"] == pytest.approx((1 / np.log2(3) + 1 / np.log2(4)) / idcg)
    assert got[3]["accuracy@10"] == 0 and got[2]["map@100"] == 0
    table = {r.metric: r.value for r in evaluation.metric_table(evaluation.per_query_metrics(preds, qrels), "m", total_time=3.0, chars=1000).collect()}
    assert table["avg_time_per_query"] == 1.0 and table["avg_time_per_1000_chars"] == 3.0


def test_best_rank_counts_misses(spark):
    r = evaluation.best_rank_metrics(spark.createDataFrame([(1,), (4,), (0,)], "best_rank int")).first()
    assert r["mrr"] == pytest.approx((1 + 0.25) / 3) and r["recall_at_5"] == pytest.approx(2 / 3)


def test_pairs(spark):
    df = samples(spark, [(" q ", ["a", " ", "b"], ["n1", "n2", " n3 ", "n4"]), (" ", ["a"], []), ("r", ["c"], [])])
    got = pairs.training_pairs(df).collect()
    assert [(r.anchor, r.positive) for r in got] == [("query: q", "passage: a"), ("query: q", "passage: b"), ("query: r", "passage: c")]
    assert len(got[0].negatives) == 3 and got[0].negatives == got[1].negatives and got[2].negatives == []


def test_keyword_ties_keep_taxonomy_order(spark):
    cats = classify.categories([(2, "B", ["x"]), (1, "A", ["y"]), (3, "C", ["z"])])
    df = samples(spark, [("x y", [], []), ("none", [], []), ("z", ["z x"], [])])
    got = [r.c for r in df.select(classify.classify_keywords(F.col("query"), F.col("pos"), cats).alias("c")).collect()]
    assert got == [["A", "B"], ["UNCLASSIFIED"], ["C"]]


def test_standardise(spark):
    rows = [('{"text": "t", "title": "u", "labels": "one", "hard_negatives": ["n"], "k": 1}',), ('{"query": "", "text": "t", "pos": ["a"]}',),
            ('{"query": "q", "pos": [], "skills": ["s"], "neg": null, "negative": ["m"]}',), ('{"query": "q"}',)]
    got = op.standardise(spark.createDataFrame(rows, "record string"), "src").collect()
    assert [(r.query, r.pos, r.neg) for r in got] == [("t", ["one"], ["n"]), ("q", ["s"], ["m"])]
    assert got[0].metadata == {"k": "1", "source_dataset": "src"}


def test_chunks_of_nothing(spark):
    assert samples(spark, [("q", [], [])]).select(chunk_sequential(F.col("pos"), 3).alias("c")).first().c == []


def _backends():
    """(groups, texts); local functions travel to the workers by value."""
    def groups():
        return lambda prompt: '{"groups": [{"labels": ["c", "a"]}, {"labels": ["b", "d"]}]}' if "- e" not in prompt else "no idea"

    def texts():
        return lambda prompt: "  " if "silent" in prompt else f" short {len(prompt)} "

    return groups, texts


def test_compress_or_split(spark):
    from labelloom.plans.compress import compress_or_split
    long = "word " * 400
    rows = [(1, "few words", ["a", "b", "c", "d"], ["n"]), (2, long, ["a", "b", "c", "d"], ["n", "a"]), (3, long, ["a"], None), (4, long + "silent", ["a"], []), (5, None, None, None),
            (6, long, ["a", "b", "c", "e"], ["n"])]
    df = spark.createDataFrame(rows, "sample_id long, query string, pos array<string>, neg array<string>")
    made, failed = compress_or_split(df, n=2, backend=_backends()[1], cluster_backend=_backends()[0])
    got = sorted((r.sample_id, r.strategy, r.group_index, tuple(r.pos), tuple(r.neg)) for r in made.collect())
    assert got == [(1, "keep", None, ("a", "b", "c", "d"), ("n",)), (2, "llm_label_group", 0, ("c", "a"), ("a", "b", "d", "n")), (2, "llm_label_group", 1, ("b", "d"), ("a", "c", "n")),
                   (3, "compress", None, ("a",), ()), (5, "keep", None, (), ()), (6, "compress", None, ("a", "b", "c", "e"), ("n",))]
    assert [(r.sample_id, r.error) for r in failed.collect()] == [(4, "empty answer")]
    vectors = spark.createDataFrame([(x, [1.0, 0.0] if x in "ad" else [0.0, 1.0]) for x in "abcd"], "label string, vector array<double>")
    made, failed = compress_or_split(df.where("sample_id = 2"), n=2, pool=vectors)
    assert sorted(tuple(r.pos) for r in made.collect()) == [("a", "d"), ("b", "c")] and failed.count() == 0
    made, failed = compress_or_split(df.limit(0))
    assert made.count() == 0 and failed.count() == 0


def test_new_label_samples(spark):
    from labelloom.plans.new_labels import new_label_samples
    skills = spark.createDataFrame([("a", "what a is", ["x"]), ("silent", "says nothing", ["x"]), ("c", None, None)], "label string, description string, occupations array<string>")
    records, refused = new_label_samples(skills.select("label"), skills, per_label=2, backend=_backends()[1])
    assert sorted((r.label, r.sample_no, tuple(r.pos)) for r in records.collect()) == [("a", 0, ("a",)), ("a", 1, ("a",)), ("c", 0, ("c",)), ("c", 1, ("c",))]
    assert sorted((r.target, r.reject_reason) for r in refused.collect()) == [("silent", "blank"), ("silent", "blank")]


def test_similar_texts_over_bands_and_tiles(spark):
    from difflib import SequenceMatcher
    import random
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(1, 90))) for _ in range(60)]
    texts = [(str(i), b[:rng.randint(1, len(b))] + rng.choice(["", "x", "yz"])) for i, b in enumerate(base)] + [("e", ""), ("n", None)]
    for threshold in (0.6, 0.9):
        want = {k for k, x in texts if x and any(SequenceMatcher(None, x, b).ratio() >= threshold for b in base)}
        got = fuzzy.similar_texts(spark.createDataFrame(texts, "text_key string, text string"), spark.createDataFrame([(str(i), b) for i, b in enumerate(base)], "real_key string, query string"),
                                  threshold, tile_rows=3)
        assert {r.text_key for r in got.collect()} == want
