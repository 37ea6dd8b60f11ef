"""G: vector similarity, retrieval, embedding cache, negative mining."""
from pyspark.sql import Window, functions as F

from ..operators import distribution, inverted, similarity as op, stats
from ..session import scratch_dir
from ..sources import tables as t
from .base import joined, query, rounded
from .relations import occupation_lists
from .views import sql

SIM = "SELECT a.vec_id AS q, b.vec_id AS c, a.label AS ql, b.label AS cl, round(list_cosine_similarity(a.vector, b.vector), 9) AS s FROM v_vec a, v_vec b"
TOP = "SELECT q AS query_id, c AS corpus_id, s AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, c) AS rank FROM sim WHERE q <> c) WHERE rank <= {k}"


def neighbours(spark, d, k):
    v = t.v_vec(spark, d)
    return op.topk_similar(v, v, k, exclude_same=True, query_id="vec_id", corpus_id="vec_id")


def vec_samples(spark, d):
    """Each vector as a query: pos = the 3 smallest ids of its label, neg = the 2 smallest ids of the next label."""
    v = t.v_vec(spark, d)
    nth = F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))
    first = v.select("label", "vec_id", nth.alias("n")).where("n <= 3").groupBy("label").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    text = (lambda c, n: F.transform(F.slice(c, 1, n), lambda x: x.cast("string")))
    pos = first.select("label", text(F.col("ids"), 3).alias("pos"))
    neg = first.select(F.pmod(F.col("label") - 1, F.lit(10)).cast("int").alias("label"), text(F.col("ids"), 2).alias("neg"))
    return v.join(pos, "label").join(neg, "label").select(F.col("vec_id").alias("sample_id"), "vector", "pos", "neg")


VS = """SELECT v.vec_id AS sample_id, v.vector, p.ids[1:3] AS pos, n.ids[1:2] AS neg FROM v_vec v JOIN f p ON p.label = v.label JOIN f n ON n.label = (v.label + 1) % 10"""
FIRST = "SELECT label, list(id ORDER BY vec_id) AS ids FROM v_vec GROUP BY 1"


def pool(spark, d):
    return t.v_vec(spark, d).select(F.col("id").alias("label"), "vector")


@query("g1_embed")
def g1(spark, d):
    """Hashed word counts through the encoder hook (Arrow batches)."""
    def encoder():
        import numpy as np
        import zlib

        def encode(texts):
            m = np.zeros((len(texts), 32))
            for i, text in enumerate(texts):
                for w in text.split():
                    m[i, zlib.crc32(w.encode()) % 32] += 1
            return m
        return encode
    x = op.embed(t.v_text(spark, d).select("doc_id", "query"), "query", encoder)
    return x.select("doc_id", F.size("vector").alias("dim"), F.round(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v), 4).alias("squared"))


@query("g1_hashing_embed")
def g1b(spark, d):
    x = op.hashing_embed(t.v_text(spark, d).select("doc_id", "query"), "query")
    return x.select("doc_id", F.size("vector").alias("dim"), F.round(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v), 4).alias("squared"))


def _cache(spark, name="hashing"):
    return op.EmbeddingCache(spark, scratch_dir(spark), name)


def _encode(df, col):
    return op.hashing_embed(df, col, 64)


@query("g2_embed_cached", sql("SELECT label, md5(CASE WHEN size > 12 THEN label || ': ' || description ELSE label END) AS text_id, 64 AS dim FROM v_skill", "v_skill"))
def g2(spark, d):
    items = t.v_skill(spark, d).select("label", F.when(F.col("size") > 12, F.col("description")).alias("description"))
    cache = _cache(spark)
    cache.fill(items.where("description is null"), _encode)
    return cache.embed(items, _encode).select("label", "text_id", F.size("vector").alias("dim"))


@query("g3_prepopulate", sql("SELECT count(DISTINCT label || ': ' || description) AS added, count(DISTINCT label || ': ' || description) AS stored, 0 AS again FROM v_skill", "v_skill"))
def g3(spark, d):
    items, cache = t.v_skill(spark, d), _cache(spark)
    added = cache.prepopulate(items, _encode)
    again = cache.prepopulate(items, _encode)
    return cache.table().agg(F.count(F.lit(1)).alias("stored")).select(F.lit(added).cast("long").alias("added"), "stored", F.lit(again).alias("again"))


@query("g4_cache_stats", sql("""SELECT count(*) AS total, count(*) FILTER (size > 12) AS hits, count(*) FILTER (size <= 12) AS misses,
    round(count(*) FILTER (size > 12) / count(*), 6) AS hit_rate FROM v_skill""", "v_skill"))
def g4(spark, d):
    items, cache = t.v_skill(spark, d), _cache(spark)
    cache.fill(t.v_skill_partial(spark, d), _encode)
    return rounded(cache.lookup_stats(items))


@query("g5_separation", sql("""SELECT round(avg(s) FILTER (p), 6) AS pos_mean, round(stddev_pop(s) FILTER (p), 6) AS pos_std, round(avg(s) FILTER (NOT p), 6) AS neg_mean, round(stddev_pop(s) FILTER (NOT p), 6) AS neg_std,
    count(*) FILTER (p) AS n_pos, count(*) FILTER (NOT p) AS n_neg, round(avg(s) FILTER (p) - avg(s) FILTER (NOT p), 6) AS separation,
    round((SELECT count(*) FROM x a, x b WHERE a.p AND NOT b.p AND a.s > b.s) / (count(*) FILTER (p) * count(*) FILTER (NOT p)), 6) AS pair_share,
    'poor' AS separation_class, 'poor' AS pair_class FROM x""", "v_vec", f=FIRST, vs=VS,
    x="""SELECT round(list_cosine_similarity(y.vector, v.vector), 9) AS s, y.side = 'pos' AS p FROM (SELECT vector, 'pos' AS side, unnest(pos) AS l FROM vs UNION ALL SELECT vector, 'neg', unnest(neg) FROM vs) y JOIN v_vec v ON y.l = v.id"""))
def g5(spark, d):
    from ..functions.vectors import cosine
    s = vec_samples(spark, d)
    rows = s.select("vector", F.explode("pos").alias("label"), F.lit(True).alias("is_positive")).unionAll(
        s.select("vector", F.explode("neg"), F.lit(False)))
    v = pool(spark, d).select("label", F.col("vector").alias("v"))
    scores = rows.join(v, "label").select(F.round(cosine(F.col("vector"), F.col("v")), 9).alias("score"), "is_positive")
    return rounded(op.separation(scores))


@query("g6_find_similar", sql("SELECT query_id, corpus_id, round(score, 6) AS score, rank FROM top10 WHERE corpus_id NOT IN (SELECT vec_id FROM v_vec WHERE label = 3)", "v_vec", sim=SIM, top10=TOP.format(k=10)))
def g6(spark, d):
    v = t.v_vec(spark, d)
    out = op.find_similar(v, v, 10, v.where("label = 3").select(F.col("vec_id").alias("corpus_id")), exclude_same=True, query_id="vec_id", corpus_id="vec_id")
    return rounded(out)


@query("g7_topk_similar", sql("SELECT query_id, corpus_id, round(score, 6) AS score, rank FROM top30", "v_vec", sim=SIM, top30=TOP.format(k=30)))
def g7(spark, d):
    return rounded(neighbours(spark, d, 30))


def index(spark, d):
    return inverted.InvertedFile(t.v_vec(spark, d), "vec_id")


@query("g7_topk_inverted", sql("SELECT query_id, corpus_id, round(score, 6) AS score, rank FROM top30", "v_vec", sim=SIM, top30=TOP.format(k=30)))
def g7_inverted(spark, d):
    return rounded(index(spark, d).topk(t.v_vec(spark, d), 30, exclude_same=True, query_id="vec_id"))


@query("g7_topk_approximate")
def g7_approximate(spark, d):
    """Every 20th vector against all rows, from as few cells as hold nine tenths of the true neighbours of drawn queries."""
    file, asked = index(spark, d), t.v_vec(spark, d).where("vec_id % 20 = 0")
    probes, _ = file.probes_for(asked, 30, 0.9, exclude_same=True, query_id="vec_id")
    return rounded(file.topk(asked, 30, exclude_same=True, query_id="vec_id", probes=probes, exact=False))


@query("g7_index_recall", sql("SELECT count(*) AS queries, least(30, count(*) * 20 - 1) AS k, true AS reached FROM v_vec WHERE vec_id % 20 = 0", "v_vec"))
def g7_recall(spark, d):
    """The approximate search of g7_topk_approximate against brute force over all rows."""
    asked = t.v_vec(spark, d).where("vec_id % 20 = 0")
    true = op.topk_similar(asked, t.v_vec(spark, d), 30, exclude_same=True, query_id="vec_id", corpus_id="vec_id").select("query_id", "corpus_id")
    found = g7_approximate(spark, d).select("query_id", "corpus_id", F.lit(1).alias("hit"))
    both = true.join(found, ["query_id", "corpus_id"], "left")
    return both.agg(F.countDistinct("query_id").alias("queries"), F.lit(30).cast("long").alias("k"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("reached"))


@query("g7_cells_visited")
def g7_visited(spark, d):
    """What the exact search compares with each query."""
    return rounded(index(spark, d).visited(t.v_vec(spark, d), 30, exclude_same=True, query_id="vec_id"))


@query("g8_rerank", sql("""SELECT query_id, corpus_id, round(1.0 / (1 + abs(query_id - corpus_id)), 6)::DOUBLE AS score,
    row_number() OVER (PARTITION BY query_id ORDER BY abs(query_id - corpus_id), corpus_id) AS rank FROM top10""", "v_vec", sim=SIM, top10=TOP.format(k=10)))
def g8(spark, d):
    """Pair scorer over texts: here the closeness of the two ids."""
    def scorer():
        return lambda qs, ts: [1.0 / (1 + abs(int(a) - int(b))) for a, b in zip(qs, ts)]
    p = neighbours(spark, d, 10).select("query_id", "corpus_id", "score", F.col("query_id").cast("string").alias("query"), F.col("corpus_id").cast("string").alias("title"))
    return rounded(op.rerank(p, scorer)).select("query_id", "corpus_id", "score", "rank")


RANKS = """SELECT vs.sample_id, v.id AS label, x.s AS similarity, 1 + (SELECT count(*) FROM sim y WHERE y.q = vs.sample_id AND y.s > x.s) AS rank
    FROM vs, LATERAL (SELECT unnest(vs.pos) AS id) p JOIN v_vec v ON v.id = p.id JOIN sim x ON x.q = vs.sample_id AND x.c = v.vec_id"""


@query("g9_rank_positives", sql("SELECT sample_id, label, round(similarity, 6) AS similarity, rank FROM r", "v_vec", f=FIRST, vs=VS, sim=SIM, r=RANKS))
def g9(spark, d):
    return rounded(op.rank_positives(vec_samples(spark, d), pool(spark, d)))


@query("g9_best_ranks", sql("""SELECT sample_id, rank AS best_rank, label AS best_label, round(similarity, 6) AS similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY rank, label) AS k FROM r) WHERE k = 1""", "v_vec", f=FIRST, vs=VS, sim=SIM, r=RANKS))
def g9b(spark, d):
    return rounded(op.best_ranks(op.rank_positives(vec_samples(spark, d), pool(spark, d))))


def groups(spark, d):
    """Two memberships per vector: its label and the sign pattern of its first two numbers."""
    v = t.v_vec(spark, d)
    sign = F.concat(*[F.when(F.col("vector")[i] > 0, "+").otherwise("-") for i in range(4)])
    return v.select(F.col("id").alias("label"), F.explode(F.array(F.concat(F.lit("L"), F.col("label").cast("string")), sign)).alias("occupation"))


GROUPS = """SELECT id AS label, unnest(['L' || label, concat(CASE WHEN vector[1] > 0 THEN '+' ELSE '-' END, CASE WHEN vector[2] > 0 THEN '+' ELSE '-' END,
    CASE WHEN vector[3] > 0 THEN '+' ELSE '-' END, CASE WHEN vector[4] > 0 THEN '+' ELSE '-' END)]) AS occupation FROM v_vec"""
PAIRS = """SELECT class, a, b, list_cosine_similarity(x.vector, y.vector) AS similarity FROM (
    SELECT 'same_group' AS class, min(label) AS a, max(label) AS b FROM (SELECT g.label, w.occupation, w.draw, row_number() OVER (PARTITION BY w.occupation, w.draw
        ORDER BY md5('42|' || w.occupation || '|' || w.draw || '|' || g.label), g.label) AS i FROM g JOIN w ON g.occupation = w.occupation) WHERE i <= 2 GROUP BY occupation, draw
    UNION ALL SELECT 'different_group', s1.label, s2.label FROM s1 JOIN s2 ON s1.i = s2.i AND s1.label <> s2.label
        WHERE NOT EXISTS (SELECT 1 FROM g g1 JOIN g g2 ON g1.occupation = g2.occupation WHERE g1.label = s1.label AND g2.label = s2.label)) p
    JOIN v_vec x ON x.id = p.a JOIN v_vec y ON y.id = p.b"""
DRAWS = """SELECT occupation, draw FROM (SELECT occupation FROM g GROUP BY 1 HAVING count(*) >= 2), (SELECT unnest([1,2,3,4,5]) AS draw) ORDER BY md5('42|' || occupation || '|' || draw) LIMIT 500"""
SLOT = "SELECT label, row_number() OVER (ORDER BY k) AS i FROM (SELECT id AS label, md5('42{s}|' || id || '|' || draw) AS k FROM v_vec, (SELECT unnest([1,2]) AS draw) ORDER BY k LIMIT 500)"
PV = dict(g=GROUPS, w=DRAWS, s1=SLOT.format(s="a"), s2=SLOT.format(s="b"), pairs=PAIRS)


def drawn_pairs(spark, d):
    return op.pair_similarities(pool(spark, d), groups(spark, d), 1000)


@query("g10_pair_similarities", sql("SELECT class, a, b, round(similarity, 6) AS similarity FROM pairs", "v_vec", **PV))
def g10(spark, d):
    return rounded(drawn_pairs(spark, d))


@query("g11_similarity_distribution", sql("""SELECT class, count(*) AS n, round(min(s), 6) AS min, round(max(s), 6) AS max, round(avg(s), 6) AS mean, round(median(s), 6) AS median, round(stddev_pop(s), 6) AS std,
    round(quantile_cont(s, 0.1), 6) AS p10, round(quantile_cont(s, 0.25), 6) AS p25, round(quantile_cont(s, 0.5), 6) AS p50, round(quantile_cont(s, 0.75), 6) AS p75, round(quantile_cont(s, 0.9), 6) AS p90
    FROM (SELECT unnest([class, 'all_pairs']) AS class, similarity AS s FROM pairs) GROUP BY 1""", "v_vec", **PV))
def g11(spark, d):
    return rounded(op.similarity_distribution(drawn_pairs(spark, d)))


@query("g12_threshold_recommendation", sql("""SELECT round(1 - quantile_cont(similarity, 0.75), 6) AS distance_threshold, round(1 - quantile_cont(similarity, 0.5), 6) AS conservative_threshold
    FROM pairs WHERE class = 'same_group'""", "v_vec", **PV))
def g12(spark, d):
    return rounded(op.threshold_recommendation(drawn_pairs(spark, d)))


CAL = """SELECT 'pos' AS side, list_cosine_similarity(s.vector, v.vector) AS s FROM (SELECT sample_id, vector, unnest(pos) AS l FROM dr) s JOIN v_vec v ON v.id = s.l
    UNION ALL SELECT 'neg', list_cosine_similarity(s.vector, v.vector) FROM (SELECT sample_id, vector, unnest(neg) AS l FROM dr) s JOIN v_vec v ON v.id = s.l
    UNION ALL SELECT 'pp', list_cosine_similarity(a.vector, b.vector) FROM (SELECT pos, generate_subscripts(pos, 1) AS i FROM dr) x, LATERAL (SELECT unnest(range(x.i + 1, len(x.pos) + 1)) AS j) y
    JOIN v_vec a ON a.id = x.pos[x.i] JOIN v_vec b ON b.id = x.pos[y.j]"""


@query("g13_calibrate", sql("""SELECT round(avg(s) FILTER (side='pos'), 6) AS query_pos_mean, round(stddev_pop(s) FILTER (side='pos'), 6) AS query_pos_std, round(quantile_cont(s, 0.25) FILTER (side='pos'), 6) AS query_pos_p25,
    round(quantile_cont(s, 0.5) FILTER (side='pos'), 6) AS query_pos_p50, round(avg(s) FILTER (side='neg'), 6) AS query_neg_mean, round(stddev_pop(s) FILTER (side='neg'), 6) AS query_neg_std,
    round(quantile_cont(s, 0.75) FILTER (side='neg'), 6) AS query_neg_p75, round(quantile_cont(s, 0.9) FILTER (side='neg'), 6) AS query_neg_p90, round(avg(s) FILTER (side='pp'), 6) AS pos_pos_mean,
    round(quantile_cont(s, 0.5) FILTER (side='pp'), 6) AS pos_pos_p50, round(quantile_cont(s, 0.5) FILTER (side='pos'), 6) AS max_positive_similarity, 0.0::DOUBLE AS min_query_similarity FROM x""",
    "v_vec", f=FIRST, vs=VS, dr="SELECT * FROM vs ORDER BY md5('42|' || sample_id) LIMIT 50", x=CAL))
def g13(spark, d):
    return rounded(op.calibrate(vec_samples(spark, d), pool(spark, d)))


@query("g13_calibrate_from", sql("""SELECT round(quantile_cont(similarity, 0.5), 6) AS max_positive_similarity, round(quantile_cont(similarity, 0.75), 6) AS min_query_similarity FROM pairs WHERE class = 'same_group'""", "v_vec", **PV))
def g13b(spark, d):
    return rounded(op.calibrate_from(drawn_pairs(spark, d)))


ALL_PAIRS = """SELECT list_cosine_similarity(x.vector, y.vector) AS s FROM g a JOIN g b ON a.occupation = b.occupation AND a.label < b.label JOIN v_vec x ON x.id = a.label JOIN v_vec y ON y.id = b.label"""


@query("g11_similarity_distribution_all", sql("""SELECT count(*) AS n, round(min(s), 6) AS min, round(max(s), 6) AS max, round(avg(s), 6) AS mean, round(median(s), 6) AS median, round(stddev_pop(s), 6) AS std,
    round(quantile_cont(s, 0.1), 6) AS p10, round(quantile_cont(s, 0.25), 6) AS p25, round(quantile_cont(s, 0.5), 6) AS p50, round(quantile_cont(s, 0.75), 6) AS p75, round(quantile_cont(s, 0.9), 6) AS p90 FROM ap""",
    "v_vec", g=GROUPS, ap=ALL_PAIRS))
def g11_all(spark, d):
    """Over all pairs of a group, none drawn."""
    return rounded(distribution.group_similarities(pool(spark, d), groups(spark, d)))


@query("g12_threshold_recommendation_all", sql("SELECT round(1 - quantile_cont(s, 0.75), 6) AS distance_threshold, round(1 - quantile_cont(s, 0.5), 6) AS conservative_threshold FROM ap", "v_vec", g=GROUPS, ap=ALL_PAIRS))
def g12_all(spark, d):
    x = distribution.group_similarities(pool(spark, d), groups(spark, d))
    return rounded(x.select((1 - F.col("p75")).alias("distance_threshold"), (1 - F.col("p50")).alias("conservative_threshold")))


@query("g13_calibrate_all", sql("""SELECT round(avg(s) FILTER (side='pos'), 6) AS query_pos_mean, round(stddev_pop(s) FILTER (side='pos'), 6) AS query_pos_std, round(quantile_cont(s, 0.25) FILTER (side='pos'), 6) AS query_pos_p25,
    round(quantile_cont(s, 0.5) FILTER (side='pos'), 6) AS query_pos_p50, round(avg(s) FILTER (side='neg'), 6) AS query_neg_mean, round(stddev_pop(s) FILTER (side='neg'), 6) AS query_neg_std,
    round(quantile_cont(s, 0.75) FILTER (side='neg'), 6) AS query_neg_p75, round(quantile_cont(s, 0.9) FILTER (side='neg'), 6) AS query_neg_p90, round(avg(s) FILTER (side='pp'), 6) AS pos_pos_mean,
    round(quantile_cont(s, 0.5) FILTER (side='pp'), 6) AS pos_pos_p50, round(quantile_cont(s, 0.5) FILTER (side='pos'), 6) AS max_positive_similarity, 0.0::DOUBLE AS min_query_similarity FROM x""",
    "v_vec", f=FIRST, vs=VS, dr="SELECT * FROM vs", x=CAL))
def g13_all(spark, d):
    """All samples and all negatives."""
    return rounded(op.calibrate(vec_samples(spark, d), pool(spark, d), n=None, max_negs=None))


@query("g17_novelty_all", sql("""SELECT v.id AS label, round(greatest(0, least(1, 1 - least(1, max(list_inner_product(v.vector, r.vector))))), 6)::DOUBLE AS novelty
    FROM v_vec v, (SELECT vector FROM v_vec WHERE label < 5) r GROUP BY 1""", "v_vec"))
def g17_all(spark, d):
    """Against all covered vectors."""
    v = t.v_vec(spark, d)
    return rounded(op.novelty(pool(spark, d), v.where("label < 5").select(F.col("id").alias("label"), "vector"), sample=None))


@query("g14_chunk_by_similarity")
def g14(spark, d):
    s = t.v_sample(spark, d)
    labels = op.hashing_embed(t.v_skill(spark, d).select("label"), "label", 64)
    return op.chunk_by_similarity(s, labels, 3, 0.4).select("sample_id", F.size("chunks").alias("n_chunks"),
        F.array_join(F.transform("chunks", lambda c: F.array_join(c, "|")), " / ").alias("chunks"))


CAND = """SELECT vs.sample_id, s.c AS cid, CAST(s.c AS VARCHAR) AS label, s.s, list_contains(vs.pos, CAST(s.c AS VARCHAR)) OR list_contains(vs.neg, CAST(s.c AS VARCHAR)) AS used,
    (SELECT max(p.s) FROM (SELECT unnest(vs.pos) AS id) u JOIN sim p ON p.q = CAST(u.id AS BIGINT) AND p.c = s.c) >= 0.3 AS close FROM vs JOIN sim s ON s.q = vs.sample_id"""
WALK = """SELECT *, sum(CASE WHEN used OR close THEN 0 ELSE 1 END) OVER (PARTITION BY sample_id ORDER BY s DESC, label ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS got,
    sum(CASE WHEN used OR close THEN 0 ELSE 1 END) OVER (PARTITION BY sample_id ORDER BY s DESC, label ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - CASE WHEN used OR close THEN 0 ELSE 1 END AS had FROM cand"""
MINED = """SELECT w.sample_id, array_to_string(any_value(vs.neg), '|') || '|' || string_agg(label, '|' ORDER BY s DESC, label) FILTER (NOT used AND NOT close AND had < 8) AS neg,
    count(*) FILTER (NOT used AND NOT close AND had < 8) AS hard_negatives_added, count(*) FILTER (NOT used AND NOT close AND had < 8) + 2 AS total_negatives,
    count(*) FILTER (had < 8) AS candidates, count(*) FILTER (used AND had < 8) AS excluded_used, count(*) FILTER (close AND NOT used AND had < 8) AS excluded_by_positive_similarity
    FROM walk w JOIN vs ON vs.sample_id = w.sample_id GROUP BY 1"""
MINE = dict(f=FIRST, vs=VS, sim=SIM, cand=CAND, walk=WALK, mined=MINED)


def mined(spark, d):
    return op.mine_hard_negatives(vec_samples(spark, d), pool(spark, d), 8, 0.3)


@query("g15_mine_hard_negatives", sql("SELECT * FROM mined", "v_vec", **MINE))
def g15(spark, d):
    return mined(spark, d).select("sample_id", joined("neg"), "hard_negatives_added", "total_negatives", "candidates", "excluded_used", "excluded_by_positive_similarity")


@query("e14_mining_stats", sql("""SELECT 2.0::DOUBLE AS avg_before, round(avg(total_negatives), 6) AS avg_after, round(avg(hard_negatives_added), 6) AS avg_added, count(*) FILTER (hard_negatives_added > 0) AS with_additions,
    CAST(sum(candidates) AS BIGINT) AS candidates, CAST(sum(excluded_used) AS BIGINT) AS excluded_used, CAST(sum(excluded_by_positive_similarity) AS BIGINT) AS excluded_similar, CAST(sum(hard_negatives_added) AS BIGINT) AS added FROM mined""", "v_vec", **MINE))
def e14(spark, d):
    return rounded(stats.mining_stats(mined(spark, d)))


WORDS = "list_distinct(string_split(lower({c}), ' '))"
HARD = """SELECT target, label, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, label) AS rank FROM (
    SELECT target, label, round(2 * o + CASE WHEN dist >= 0.63 THEN least(5 * dist, 3) ELSE 0 END + CASE WHEN w <= 1 THEN 1 ELSE 0 END + CASE WHEN label < 'm' THEN 0.5 ELSE 0 END, 9) AS score
    FROM (SELECT *, {dist} AS dist FROM n) WHERE w <= 2)) WHERE rank <= 4"""
SHARED = f"""SELECT a.label AS target, b.label AS label, count(*)::DOUBLE AS o, any_value(len(list_intersect({WORDS.format(c='a.label')}, {WORDS.format(c='b.label')})))::DOUBLE AS w,
    any_value(greatest(len({WORDS.format(c='a.label')}), len({WORDS.format(c='b.label')}))) AS m FROM v_skill_occ a JOIN v_skill_occ b ON a.occupation = b.occupation AND a.label <> b.label GROUP BY ALL"""


@query("g16_group_hard_negatives", sql(HARD.format(dist="1 - w / m"), "v_skill_occ", n=SHARED))
def g16(spark, d):
    lists = occupation_lists(spark, d)
    targets = lists.select(F.col("label").alias("target_id"), F.array("label").alias("positives"))
    out = op.group_hard_negatives(targets, lists, lists.where("label < 'm'"), 4)
    return rounded(out.withColumnRenamed("target_id", "target"))


@query("g16_group_hard_negatives_vectors", sql("""SELECT target, label, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, label) AS rank FROM (
    SELECT q AS target, cid AS label, round(2 * o + CASE WHEN 1 - s >= 0.63 THEN least(5 * (1 - s), 3) ELSE 0 END + 1 + CASE WHEN cid < '3' THEN 0.5 ELSE 0 END, 9) AS score FROM (
    SELECT a.label AS q, b.label AS cid, count(*) AS o FROM g a JOIN g b ON a.occupation = b.occupation AND a.label <> b.label GROUP BY ALL) JOIN (SELECT CAST(q AS VARCHAR) AS sq, CAST(c AS VARCHAR) AS sc, s FROM sim) ON sq = q AND sc = cid)) WHERE rank <= 4""", "v_vec", g=GROUPS, sim=SIM))
def g16b(spark, d):
    occ = groups(spark, d).groupBy("label").agg(F.collect_list("occupation").alias("occupations"))
    skills = pool(spark, d).join(occ, "label")
    targets = skills.select(F.col("label").alias("target_id"), F.array("label").alias("positives"))
    out = op.group_hard_negatives(targets, skills, skills.where("label < '3'"), 4, use_vectors=True)
    return rounded(out.withColumnRenamed("target_id", "target"))


@query("g17_novelty", sql("""SELECT v.id AS label, round(greatest(0, least(1, 1 - least(1, max(list_inner_product(v.vector, r.vector))))), 6)::DOUBLE AS novelty
    FROM v_vec v, (SELECT vector FROM v_vec WHERE label < 5 ORDER BY md5('42|' || id) LIMIT 30) r GROUP BY 1""", "v_vec"))
def g17(spark, d):
    v = t.v_vec(spark, d)
    return rounded(op.novelty(pool(spark, d), v.where("label < 5").select(F.col("id").alias("label"), "vector")))


@query("g18_in_group_redundancy", sql("""SELECT q AS id, ql AS "group", count(*) + 1 AS n, round(avg(s), 5) AS redundancy FROM sim WHERE q <> c AND ql = cl GROUP BY ALL""", "v_vec", sim=SIM))
def g18(spark, d):
    return op.in_group_redundancy(t.v_vec(spark, d), 64, "vec_id").withColumn("redundancy", F.round("redundancy", 5))
