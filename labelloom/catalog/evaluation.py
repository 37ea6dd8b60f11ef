"""K: retrieval evaluation."""
from pyspark.sql import functions as F

from ..functions import payloads as pl
from ..functions import text as tx
from ..operators import evaluation as op
from ..operators.similarity import best_ranks, rank_positives
from ..plans import mining, retrieval
from ..sources import tables as t
from .base import joined, query, rounded
from .similarity import CAL, FIRST, MINE, RANKS, SIM, TOP, VS, neighbours, pool, vec_samples
from .views import sql

QRELS = "SELECT a.vec_id AS query_id, b.vec_id AS corpus_id FROM v_vec a JOIN v_vec b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.label < 9"
HITS = """SELECT p.query_id, p.rank, row_number() OVER (PARTITION BY p.query_id ORDER BY p.rank) AS hit_no FROM preds p JOIN qrels r ON r.query_id = p.query_id AND r.corpus_id = p.corpus_id"""


def _per_query():
    acc = ", ".join(f"(count(rank) FILTER (rank <= {k}) > 0)::INT::DOUBLE AS \"accuracy@{k}\", count(rank) FILTER (rank <= {k}) / {k} AS \"precision@{k}\", count(rank) FILTER (rank <= {k}) / any_value(n_rel) AS \"recall@{k}\"" for k in op.CUTS)
    return f"""SELECT n.query_id, {acc},
    coalesce(sum(1 / log2(rank + 1)) FILTER (rank <= 10), 0) / (SELECT sum(1 / log2(i + 1)) FROM range(1, CAST(least(any_value(n_rel), 10) AS BIGINT) + 1) x(i)) AS "ndcg@10",
    coalesce(1 / min(rank) FILTER (rank <= 10), 0) AS "mrr@10", coalesce(sum(hit_no / rank) FILTER (rank <= 100), 0) / least(any_value(n_rel), 100) AS "map@100"
    FROM (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY 1) n LEFT JOIN hits h ON h.query_id = n.query_id GROUP BY 1"""


EVAL = dict(sim=SIM, preds=TOP.format(k=100), qrels=QRELS, hits=HITS, pq=_per_query())


def relevant(spark, d):
    """(query_id, n_rel): as many other vectors have the same label; label 9 has no relevant items, so that some queries are not evaluable."""
    v = t.v_vec(spark, d).where("label < 9").select("vec_id", "label")
    n = v.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("n_rel")).where("n_rel > 0")
    return v.join(n, "label").select(F.col("vec_id").alias("query_id"), "n_rel")


def hits(spark, d, k):
    """(query_id, rank) of the predictions with the label of the query."""
    v = t.v_vec(spark, d).where("label < 9")
    p = neighbours(spark, d, k).select("query_id", "corpus_id", "rank")
    p = p.join(v.select(F.col("vec_id").alias("query_id"), F.col("label").alias("_q")), "query_id")
    return p.join(v.select(F.col("vec_id").alias("corpus_id"), F.col("label").alias("_c")), "corpus_id").where("_q = _c").select("query_id", "rank")


def per_query(spark, d):
    return op.metrics_of_hits(hits(spark, d, 100), relevant(spark, d))


@query("k1_evaluable_queries", sql("SELECT DISTINCT query_id FROM qrels", "v_vec", qrels=QRELS))
def k1(spark, d):
    return op.evaluable_queries(t.v_vec(spark, d).select(F.col("vec_id").alias("query_id")), relevant(spark, d))


def _metric(key, prefix, names):
    cols = ", ".join(f'round("{n}", 6) AS "{n}"' for n in names)

    @query(key, sql(f"SELECT query_id, {cols} FROM pq", "v_vec", **EVAL))
    def one(spark, d):
        return rounded(per_query(spark, d).select("query_id", *[F.col(f"`{n}`") for n in names]))


_metric("k2_accuracy_at_k", "accuracy", [f"accuracy@{k}" for k in op.CUTS])
_metric("k3_precision_at_k", "precision", [f"precision@{k}" for k in op.CUTS])
_metric("k4_recall_at_k", "recall", [f"recall@{k}" for k in op.CUTS])
_metric("k5_mrr_at_k", "mrr", ["mrr@10"])
_metric("k6_ndcg_at_k", "ndcg", ["ndcg@10"])
_metric("k7_map_at_k", "map", ["map@100"])

NAMES = [n for k in op.CUTS for n in (f"accuracy@{k}", f"precision@{k}", f"recall@{k}")] + ["ndcg@10", "mrr@10", "map@100"]


def table_sql(model):
    return " UNION ALL ".join(f"SELECT '{model}' AS model, '{n}' AS metric, round(avg(\"{n}\"), 6) AS value FROM pq" for n in NAMES)


@query("k8_metric_table", sql(table_sql("cosine"), "v_vec", **EVAL))
def k8(spark, d):
    return rounded(op.metric_table(per_query(spark, d), "cosine"))


QR = dict(f=FIRST, vs=VS, qrels="SELECT DISTINCT sample_id AS query_id, CAST(l AS BIGINT) AS corpus_id FROM (SELECT sample_id, unnest(pos) AS l FROM vs WHERE len(pos) > 0) WHERE sample_id <> CAST(l AS BIGINT)")
SEEN = "SELECT query_id, corpus_id, score, rank FROM (SELECT q AS query_id, c AS corpus_id, s AS score, row_number() OVER (PARTITION BY q ORDER BY s DESC, c) AS rank FROM sim) WHERE rank <= 100"


def judgements(spark, d):
    """(query_id, corpus_id): the positive labels of each vector, but for itself."""
    pairs = vec_samples(spark, d).select(F.col("sample_id").alias("query_id"), F.explode(F.col("pos").cast("array<bigint>")).alias("corpus_id"))
    return pairs.where("query_id <> corpus_id")


@query("k2_k7_per_query_qrels", sql("SELECT query_id, " + ", ".join(f'round("{n}", 6) AS "{n}"' for n in NAMES) + " FROM pq WHERE query_id IN (SELECT vec_id FROM v_vec WHERE label < 7)",
    "v_vec", sim=SIM, preds=TOP.format(k=100), **QR, hits=HITS, pq=_per_query()))
def k_per_query(spark, d):
    """All metrics of the queries of seven labels, from predictions and a table of judgements."""
    asked = t.v_vec(spark, d).where("label < 7").select(F.col("vec_id").alias("query_id"))
    return rounded(op.per_query_metrics(neighbours(spark, d, 100), judgements(spark, d), asked))


@query("k8_evaluate_qrels", sql(table_sql("cosine"), "v_vec", sim=SIM, preds=TOP.format(k=100), **QR, hits=HITS, pq=_per_query()))
def k_evaluate(spark, d):
    return rounded(op.evaluate(neighbours(spark, d, 100), judgements(spark, d), "cosine"))


@query("plan_evaluate_retrieval", sql(table_sql("vectors"), "v_vec", sim=SIM, preds=SEEN, **QR, hits=HITS, pq=_per_query()))
def plan_retrieval(spark, d):
    """Search over the whole corpus, each vector included, then the metric table."""
    v = t.v_vec(spark, d)
    queries, corpus = v.select(F.col("vec_id").alias("query_id"), "vector"), v.select(F.col("vec_id").alias("corpus_id"), "vector")
    return rounded(retrieval.evaluate_retrieval(queries, corpus, judgements(spark, d), "vectors"))


CALIBRATED = MINE | dict(dr="SELECT * FROM vs ORDER BY md5('42|' || sample_id) LIMIT 50", x=CAL, th="SELECT quantile_cont(s, 0.5) AS th FROM x WHERE side = 'pos'")
CALIBRATED = {k: CALIBRATED[k].replace(">= 0.3", ">= (SELECT th FROM th)") for k in ("f", "vs", "sim", "dr", "x", "th", "cand", "walk", "mined")}


@query("plan_calibrated_mining", sql("SELECT * FROM mined", "v_vec", **CALIBRATED))
def plan_mining(spark, d):
    """The threshold is the median similarity of queries and positives of drawn samples."""
    mined, _ = mining.mine(vec_samples(spark, d), pool(spark, d), 8)
    return mined.select("sample_id", joined("neg"), "hard_negatives_added", "total_negatives", "candidates", "excluded_used", "excluded_by_positive_similarity")


def traits(spark, d):
    """Best ranks of the vectors with the text traits of the document of the same number."""
    ranks = best_ranks(rank_positives(vec_samples(spark, d), pool(spark, d)))
    docs = t.v_text(spark, d)
    info = docs.select(F.col("doc_id").alias("sample_id"), *[c.alias(n) for n, c in tx.query_traits(F.col("query")).items()],
                       tx.positive_count_bucket(F.pmod(F.col("n_chars"), F.lit(8)) + 1).alias("positive_count"),
                       F.when(F.col("lang") == "en", "T1").when(F.col("lang") == "fr", "S5").when(F.col("lang") == "de", "S2").otherwise("06").alias("topic"))
    return ranks.join(info, "sample_id", "left").select("sample_id", "best_rank", *[F.coalesce(c, F.lit("?")).alias(c) for c in DIMS])


DIMS = ["length_category", "word_category", "complexity_level", "positive_count", "topic"]
_W = r"len(regexp_extract_all(text, '[^\s\x0B\x{1c}-\x{1f}\x{85}\p{Z}]+'))"
_L = r"len(regexp_extract_all(text, '[^\s\x0B\x{1c}-\x{1f}\x{85}\p{Z}]{9,}'))"
INFO = f"""SELECT doc_id, CASE WHEN length(text) < 100 THEN 'Short (50-100 chars)' WHEN length(text) < 200 THEN 'Medium (100-200 chars)' WHEN length(text) < 400 THEN 'Long (200-400 chars)' ELSE 'Very Long (> 400 chars)' END AS length_category,
    CASE WHEN {_W} < 10 THEN 'Few Words (5-10)' WHEN {_W} < 20 THEN 'Moderate Words (10-20)' WHEN {_W} < 40 THEN 'Many Words (20-40)' ELSE 'Very Many Words (> 40)' END AS word_category,
    CASE WHEN {_L} / greatest({_W}, 1) < 0.1 THEN 'Simple' WHEN {_L} / greatest({_W}, 1) < 0.3 THEN 'Moderate' ELSE 'Complex' END AS complexity_level,
    CASE WHEN n_chars % 8 + 1 = 1 THEN 'Single (1)' WHEN n_chars % 8 + 1 <= 3 THEN 'Few (2-3)' WHEN n_chars % 8 + 1 <= 5 THEN 'Several (4-5)' ELSE 'Many (6-10)' END AS positive_count,
    CASE lang WHEN 'en' THEN 'T1' WHEN 'fr' THEN 'S5' WHEN 'de' THEN 'S2' ELSE '06' END AS topic FROM documents"""
BEST = "SELECT sample_id, min(rank) AS best_rank FROM r GROUP BY 1"
TRAITS = "SELECT sample_id, best_rank, " + ", ".join(f"coalesce({c}, '?') AS {c}" for c in DIMS) + " FROM best LEFT JOIN info ON sample_id = doc_id"
RANKED = dict(f=FIRST, vs=VS, sim=SIM, r=RANKS, best=BEST, info=INFO, tr=TRAITS)
AGG = """count(*) AS count, round(avg(1 / best_rank), 6) AS mrr, round(avg((best_rank <= 1)::INT), 6) AS recall_at_1, round(avg((best_rank <= 5)::INT), 6) AS recall_at_5, round(avg((best_rank <= 10)::INT), 6) AS recall_at_10,
    round(avg((best_rank <= 20)::INT), 6) AS recall_at_20, round(avg(CASE WHEN best_rank <= 5 THEN 1 / log2(best_rank + 1) ELSE 0 END), 6) AS ndcg_at_5, round(avg(CASE WHEN best_rank <= 10 THEN 1 / log2(best_rank + 1) ELSE 0 END), 6) AS ndcg_at_10,
    round(avg(best_rank), 6) AS average_rank, round(quantile_cont(best_rank, 0.5), 6) AS median_rank, round(stddev_pop(best_rank), 6) AS std_rank, min(best_rank) AS min_rank, max(best_rank) AS max_rank,
    round(quantile_cont(best_rank, 0.25), 6) AS percentile_25, round(quantile_cont(best_rank, 0.75), 6) AS percentile_75"""
CELLS = " UNION ALL ".join(f"SELECT '{c}' AS dimension, {c} AS bucket, best_rank FROM tr" for c in DIMS)


@query("k9_best_rank_metrics", sql(f"SELECT {AGG} FROM best", "v_vec", f=FIRST, vs=VS, sim=SIM, r=RANKS, best=BEST))
def k9(spark, d):
    return rounded(op.best_rank_metrics(best_ranks(rank_positives(vec_samples(spark, d), pool(spark, d)))))


@query("k10_breakdowns", sql(f"SELECT dimension, bucket, {AGG} FROM ce GROUP BY ALL", "v_vec", **RANKED, ce=CELLS))
def k10(spark, d):
    return rounded(op.breakdowns(traits(spark, d), DIMS))


INSIGHTS = """SELECT dimension AS topic, 'best: ' || arg_max(bucket, mrr) AS finding FROM br WHERE dimension IN ('length_category', 'topic') GROUP BY dimension
    UNION ALL SELECT dimension, 'worst: ' || arg_min(bucket, mrr) FROM br WHERE dimension IN ('length_category', 'topic') GROUP BY dimension
    UNION ALL SELECT 'positive_count', CASE WHEN s < m THEN 'more positive labels perform better' ELSE 'single positive label performs well' END FROM a WHERE s IS NOT NULL AND m IS NOT NULL
    UNION ALL SELECT 'topic', 'computing categories above average' FROM a WHERE it > al * 1.2
    UNION ALL SELECT 'topic', 'computing categories below average' FROM a WHERE it < al * 0.8
    UNION ALL SELECT 'topic', 'transversal better than specific' FROM a WHERE tv > sp * 1.1
    UNION ALL SELECT 'topic', 'specific better than transversal' FROM a WHERE sp > tv * 1.1
    UNION ALL SELECT 'complexity_level', 'struggles with complex queries' FROM a WHERE si > co * 1.2
    UNION ALL SELECT 'complexity_level', 'handles complex queries well' FROM a WHERE co > si * 1.2"""
AVG = """SELECT avg(mrr) FILTER (dimension = 'positive_count' AND bucket = 'Single (1)') AS s, avg(mrr) FILTER (dimension = 'positive_count' AND bucket = 'Many (6-10)') AS m,
    avg(mrr) FILTER (dimension = 'topic' AND bucket IN ('S5', '06')) AS it, avg(mrr) FILTER (dimension = 'topic') AS al, avg(mrr) FILTER (dimension = 'topic' AND bucket LIKE 'T%') AS tv,
    avg(mrr) FILTER (dimension = 'topic' AND bucket LIKE 'S%') AS sp, avg(mrr) FILTER (dimension = 'complexity_level' AND bucket = 'Simple') AS si, avg(mrr) FILTER (dimension = 'complexity_level' AND bucket = 'Complex') AS co FROM br"""


@query("k11_insights", sql(INSIGHTS, "v_vec", **RANKED, ce=CELLS, br="SELECT dimension, bucket, avg(1 / best_rank) AS mrr FROM ce GROUP BY ALL", a=AVG))
def k11(spark, d):
    return op.insights(op.breakdowns(traits(spark, d), DIMS))


@query("k12_evaluation_report", sql("SELECT sample_id, best_rank, topic FROM tr ORDER BY sample_id LIMIT 100", "v_vec", **RANKED))
def k12(spark, d):
    """The detail part; the other parts of the report are k9 and k10."""
    return op.evaluation_report(traits(spark, d), DIMS)["details"].select("sample_id", "best_rank", "topic")


@query("k12_evaluation_report_parts", sql(f"""SELECT 'overall' AS part, '' AS dimension, '' AS bucket, unnest(['count', 'mrr', 'recall_at_10', 'median_rank']) AS name, unnest([count::DOUBLE, mrr, recall_at_10, median_rank]) AS value FROM (SELECT {AGG} FROM tr)
    UNION ALL SELECT 'breakdowns', dimension, bucket, unnest(['count', 'mrr', 'recall_at_10', 'median_rank']), unnest([count::DOUBLE, mrr, recall_at_10, median_rank]) FROM (SELECT dimension, bucket, {AGG} FROM ce GROUP BY ALL)
    UNION ALL SELECT 'details', topic, CAST(sample_id AS VARCHAR), 'best_rank', best_rank FROM (SELECT * FROM tr ORDER BY sample_id LIMIT 100) UNION ALL SELECT DISTINCT 'categories', 'topic', topic, 'found', 1 FROM tr""", "v_vec", **RANKED, ce=CELLS))
def k12_parts(spark, d):
    """All four parts of the report as rows."""
    report = op.evaluation_report(traits(spark, d), DIMS)
    none = F.lit("")

    def measures(df, dimension, bucket, part):
        cells = F.array(*[F.struct(F.lit(n).alias("name"), F.round(F.col(n).cast("double"), 6).alias("value")) for n in ("count", "mrr", "recall_at_10", "median_rank")])
        return df.select(F.lit(part).alias("part"), dimension.alias("dimension"), bucket.alias("bucket"), F.inline(cells))

    out = measures(report["overall"], none, none, "overall").unionByName(measures(report["breakdowns"], F.col("dimension"), F.col("bucket"), "breakdowns"))
    out = out.unionByName(report["details"].select(F.lit("details").alias("part"), F.col("topic").alias("dimension"), F.col("sample_id").cast("string").alias("bucket"), F.lit("best_rank").alias("name"), F.col("best_rank").cast("double").alias("value")))
    return out.unionByName(report["categories"].select(F.lit("categories").alias("part"), F.lit("topic").alias("dimension"), F.col("topic").alias("bucket"), F.lit("found").alias("name"), F.lit(1.0).alias("value")))


def model_metrics(spark, d):
    """Order priority as model, averages over its lines as metrics."""
    l = t.table(spark, d, "lineitem").join(t.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    x = l.groupBy(F.col("o_orderpriority").alias("model")).agg(F.avg("l_discount").alias("a"), F.avg("l_tax").alias("p"), F.avg("l_quantity").alias("t"))
    return x.select("model", F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.round(F.col(c), 6).alias("value")) for n, c in
                                                (("accuracy@1", "a"), ("ndcg@10", "p"), ("avg_time_per_query", "t"))])))


MM = """SELECT model, unnest(['accuracy@1', 'ndcg@10', 'avg_time_per_query']) AS metric, unnest([a, p, t]) AS value FROM (SELECT o_orderpriority AS model, round(avg(l_discount), 6) AS a, round(avg(l_tax), 6) AS p,
    round(avg(l_quantity), 6) AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)"""


@query("k13_compare_models", sql("SELECT model, " + ", ".join(f"max(value) FILTER (metric = '{n}') AS \"{n}\"" for n in op.METRICS) + " FROM mm GROUP BY 1", mm=MM))
def k13(spark, d):
    return op.compare_models(model_metrics(spark, d))


@query("k14_grade_models", sql("""SELECT *, grade = 1 AS is_best FROM (SELECT model, metric, value, rank() OVER (PARTITION BY metric ORDER BY CASE WHEN contains(metric, 'time') THEN value ELSE -value END) AS grade FROM mm)""", mm=MM))
def k14(spark, d):
    return op.grade_models(model_metrics(spark, d))


def payload(spark, d):
    """Prediction payloads of the events: four shapes by event type, made from user, value and number."""
    e = t.table(spark, d, "events").select("event_id", "event_type", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("u"), F.col("event_id").cast("double").alias("v"))
    item = F.struct(F.col("u").alias("skill"), F.col("v").alias("score"))
    named = F.struct(F.col("u").alias("name"), F.col("v").alias("score"))
    kind = F.col("event_type")
    other = F.to_json(F.array(item, F.struct(F.lit("x").alias("skill"), F.lit(0.25).alias("score"))))
    j = (F.when(kind == "click", F.concat(F.lit('{"predictions": [1, '), F.to_json(item), F.lit(', {"skill": "no score"}, '), F.to_json(named), F.lit("]}")))
         .when(kind == "view", F.to_json(F.struct(F.array("u", F.lit("b"), F.lit("left over")).alias("skills"), F.array("v", F.lit(0.5)).alias("scores"))))
         .when(kind == "error", F.to_json(F.struct(F.array(item).alias("results")))).otherwise(other))
    return e.withColumn("json", j)


def _rows(df, col):
    return df.select("event_id", F.posexplode(col).alias("i", "p")).select("event_id", "i", "p.title", F.col("p.score").alias("score"))


BASE = "SELECT event_id, event_type, 'u' || user_id AS u, event_id::DOUBLE AS v FROM events"


@query("k15_parse_predictions_json", sql("""SELECT event_id, i - 1 AS i, p[1] AS title, CAST(p[2] AS DOUBLE) AS score FROM (SELECT event_id, unnest(l) AS p, generate_subscripts(l, 1) AS i FROM (SELECT event_id, CASE event_type
    WHEN 'click' THEN [[u, v::VARCHAR], [u, v::VARCHAR]] WHEN 'view' THEN [[u, v::VARCHAR], ['b', '0.5']] WHEN 'error' THEN [[u, v::VARCHAR]] ELSE [[u, v::VARCHAR], ['x', '0.25']] END AS l FROM e))""", e=BASE))
def k15(spark, d):
    return _rows(payload(spark, d), pl.parse_predictions_json(F.col("json")))


@query("k16_parse_predictions_text", sql("""SELECT event_id, unnest([0, 1]) AS i, unnest([u, 'b']) AS title, unnest([v, 0.5::DOUBLE]) AS score FROM e""", e=BASE))
def k16(spark, d):
    p = payload(spark, d)
    text = F.concat(F.lit("\n"), "u", F.lit("\t"), F.col("v").cast("string"), F.lit("\nno number, x\nno separator\n b , 0.5 ,z\n"))
    return _rows(p.select("event_id", text.alias("t")), pl.parse_predictions_text(F.col("t")))


@query("k17_parse_nested_predictions", sql("""SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY s DESC, o) - 1 AS i, title, s AS score FROM (SELECT event_id, unnest([0, 1, 2]) AS o, unnest([u, 'five', 'six']) AS title, unnest([v, 5::DOUBLE, 6::DOUBLE]) AS s FROM e)""", e=BASE))
def k17(spark, d):
    p = payload(spark, d)
    text = F.concat(F.lit('{"learning_outcomes": {"skills": [{"title": "'), "u", F.lit('", "score": '), F.col("v").cast("string"),
                    F.lit('}, {"title": "five", "score": 5}, {"title": "none"}, {"title": "six", "score": 6}]}}'))
    return _rows(p.select("event_id", text.alias("t")), pl.parse_nested_predictions(F.col("t")))


@query("k17_positional_scores", sql("""SELECT event_id, unnest([0, 1]) AS i, unnest([u, 'b']) AS title, unnest([1.0::DOUBLE, 0.5::DOUBLE]) AS score FROM e""", e=BASE))
def k17b(spark, d):
    p = payload(spark, d)
    text = F.concat(F.lit('[{"name": "'), "u", F.lit('", "conceptUrl": "c"}, {"name": "no url"}, {"conceptUrl": "d", "name": "b"}, 7]'))
    return _rows(p.select("event_id", text.alias("t")), pl.positional_scores(F.col("t")))


@query("k18_restrict_to_corpus", sql("""SELECT o_orderkey AS query_id, corpus_id, score, row_number() OVER (PARTITION BY o_orderkey ORDER BY score DESC, corpus_id) AS r, corpus_id IS NOT NULL AS known FROM orders LEFT JOIN
    (SELECT l_orderkey, l_extendedprice AS score, m.corpus_id FROM lineitem JOIN part ON l_partkey = p_partkey JOIN (SELECT p_name, min(p_partkey) AS corpus_id FROM part WHERE p_size > 30 AND p_type = 'PROMO' GROUP BY 1) m
    ON m.p_name = part.p_name) ON l_orderkey = o_orderkey""".replace("SELECT o_orderkey AS query_id, corpus_id, score, row_number()", "SELECT query_id, corpus_id, score, CASE WHEN known THEN r END AS rank FROM (SELECT o_orderkey AS query_id, corpus_id, score, row_number()") + ")"))
def k18(spark, d):
    lines = t.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    part = t.table(spark, d, "part")
    preds = lines.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("query_id"), F.col("p_name").alias("title"), F.col("l_extendedprice").alias("score"))
    corpus = part.where("p_size > 30 and p_type = 'PROMO'").select(F.col("p_partkey").alias("corpus_id"), F.col("p_name").alias("title"))
    return op.restrict_to_corpus(preds, corpus, t.table(spark, d, "orders").select(F.col("o_orderkey").alias("query_id")))
