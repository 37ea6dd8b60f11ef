"""E: counts, length statistics, before/after statistics, histograms."""
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import pairs, stats as op
from ..sources import tables as t
from .base import joined, query, rounded
from .views import sql, words

FREQ = "SELECT l AS label, count(*) AS n FROM (SELECT unnest(pos) AS l FROM v_sample) GROUP BY 1"
COARSE = "SELECT coarse_label AS label, count(*) AS n FROM v_sample_label WHERE NOT is_neg GROUP BY 1"


def coarse_samples(spark, d):
    """Samples with the coarse label (64 values) in place of the fine one."""
    x = t.v_sample_label(spark, d).groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("pos_no", "coarse_label", "is_neg"))).alias("a"))
    pick = (lambda neg: F.transform(F.filter("a", lambda e: e.is_neg if neg else ~e.is_neg), lambda e: e.coarse_label))
    return x.select("sample_id", F.col("sample_id").alias("row_no"), pick(False).alias("pos"), pick(True).alias("neg"))


def freq(spark, d):
    return op.label_frequency(t.v_sample(spark, d))


@query("e1_label_frequency", sql(FREQ, "v_sample"))
def e1(spark, d):
    return freq(spark, d)


@query("e2_overfull_labels", sql(f"SELECT * FROM ({FREQ}) WHERE n > (SELECT CAST(floor(avg(n) * 1.5) AS BIGINT) FROM ({FREQ}))", "v_sample"))
def e2(spark, d):
    f = freq(spark, d)
    return op.overfull_labels(f, f.agg(F.floor(F.avg("n") * 1.5)).scalar())


LIMIT = 600


@query("e3_multi_overfull_samples", sql(f"""SELECT sample_id, count(*) AS n_overfull, string_agg(coarse_label, '|' ORDER BY pos_no) AS labels
    FROM v_sample_label WHERE NOT is_neg AND coarse_label IN (SELECT label FROM f WHERE n > {LIMIT}) GROUP BY 1 HAVING count(*) > 1""", "v_sample_label", f=COARSE))
def e3(spark, d):
    s = coarse_samples(spark, d)
    m = op.multi_overfull_samples(s, op.overfull_labels(op.label_frequency(s), LIMIT))
    return m.withColumn("labels", joined("labels"))


@query("e4_rare_labels", sql(f"SELECT label, n, 25 - n AS deficit FROM ({FREQ}) WHERE n < 25", "v_sample"))
def e4(spark, d):
    return op.rare_labels(freq(spark, d), 25)


@query("e4_total_deficit", sql(f"SELECT count(*) AS n_labels, CAST(sum(25 - n) AS BIGINT) AS total_deficit FROM ({FREQ}) WHERE n < 25", "v_sample"))
def e4b(spark, d):
    return op.total_deficit(op.rare_labels(freq(spark, d), 25))


@query("e5_top_labels", sql(f"SELECT * FROM ({FREQ}) ORDER BY n DESC, label LIMIT 20", "v_sample"))
def e5(spark, d):
    return op.top_labels(freq(spark, d), 20)


@query("e5_frequency_totals", sql("SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct_labels FROM (SELECT l, count(*) AS n FROM (SELECT unnest(neg) AS l FROM v_sample) GROUP BY 1)", "v_sample"))
def e5b(spark, d):
    return op.frequency_totals(op.label_frequency(t.v_sample(spark, d), "neg"))


@query("e6_frequency_histogram", sql(f"SELECT n, count(*) AS n_labels FROM ({FREQ}) GROUP BY 1", "v_sample"))
def e6(spark, d):
    return op.frequency_histogram(freq(spark, d))[1]


@query("e6_frequency_summary", sql(f"SELECT min(n) AS min_n, max(n) AS max_n, median(n)::DOUBLE AS median_n FROM ({FREQ})", "v_sample"))
def e6b(spark, d):
    return op.frequency_histogram(freq(spark, d))[0]


TEXTS = f"""SELECT kind, {words('text')} AS w, length(text) AS c FROM (SELECT 'query' AS kind, query AS text FROM v_text_sample
    UNION ALL SELECT 'pos', unnest(pos) FROM v_text_sample UNION ALL SELECT 'neg', unnest(neg) FROM v_text_sample)"""


@query("e7_length_stats", sql(f"""SELECT kind, count(*) AS count, min(w) AS words_min, max(w) AS words_max, round(avg(w), 6) AS words_mean, round(stddev_pop(w), 6) AS words_std,
    min(c) AS chars_min, max(c) AS chars_max, round(avg(c), 6) AS chars_mean, quantile_cont(c, 0.5) AS chars_median, round(stddev_pop(c), 6) AS chars_std,
    quantile_cont(w, 0.5) AS words_median, round(quantile_cont(w, 0.25), 6) AS words_p25, round(quantile_cont(w, 0.75), 6) AS words_p75, round(quantile_cont(w, 0.9), 6) AS words_p90,
    round(quantile_cont(w, 0.95), 6) AS words_p95, round(quantile_cont(w, 0.99), 6) AS words_p99 FROM x GROUP BY kind""", "v_text_sample", x=TEXTS))
def e7(spark, d):
    return rounded(op.length_stats(op.texts_of(t.v_text_sample(spark, d)), group="kind"))


@query("e8_context_budget", sql("""SELECT c.coverage, round(cutoff, 6) AS cutoff_words, round(cutoff * 1.3, 6) AS query_tokens, round(cutoff * 1.3 + lw * 1.3, 6) AS pair_tokens,
    CASE WHEN p99 * 1.3 <= 256 THEN 'short' WHEN p99 * 1.3 <= 512 THEN 'medium' ELSE 'long' END AS context_class, CAST(floor(p95 * 1.3) AS BIGINT) AS recommended_length
    FROM (SELECT quantile_cont(w, 0.9) AS p90, quantile_cont(w, 0.95) AS p95, quantile_cont(w, 0.99) AS p99 FROM x WHERE kind = 'query') q,
    (SELECT avg(w) AS lw FROM x WHERE kind = 'pos') l, LATERAL (SELECT * FROM (VALUES (90, p90), (95, p95), (99, p99)) v(coverage, cutoff)) c""", "v_text_sample", x=TEXTS))
def e8(spark, d):
    return rounded(op.context_budget(t.v_text_sample(spark, d)))


@query("e9_length_outliers", sql("""SELECT round(p99, 6) AS p99, nq AS n_queries, nl AS n_labels, vl AS very_long_queries, vs AS very_short_queries, ll AS very_long_labels,
    round(vl * 100.0 / nq, 6)::DOUBLE AS long_pct, round(vs * 100.0 / nq, 6)::DOUBLE AS short_pct, round(ll * 100.0 / nl, 6)::DOUBLE AS long_label_pct,
    vl > nq * 0.05 AS needs_chunking, vs > nq * 0.1 AS needs_minimum_length FROM (SELECT p99, count(*) FILTER (kind = 'query') AS nq, count(*) FILTER (kind = 'pos') AS nl,
    count(*) FILTER (kind = 'query' AND w > p99) AS vl, count(*) FILTER (kind = 'query' AND w < 5) AS vs, count(*) FILTER (kind = 'pos' AND w > 10) AS ll
    FROM x, (SELECT quantile_cont(w, 0.99) AS p99 FROM x WHERE kind = 'query') GROUP BY p99)""", "v_text_sample", x=TEXTS))
def e9(spark, d):
    return rounded(op.length_outliers(t.v_text_sample(spark, d)))


@query("e10_lengths_by_dataset", f"""SELECT lang AS dataset, round(avg({words('text')}), 1) AS words_mean, round(stddev_samp({words('text')}), 1) AS words_std,
    max({words('text')}) AS words_max, round(avg({words('source')}), 1) AS pos_words_mean FROM documents GROUP BY 1""")
def e10(spark, d):
    s = t.v_text(spark, d).select(F.col("lang").alias("dataset"), "query", F.array("source").alias("pos"))
    return op.lengths_by_dataset(s)


@query("e11_length_asymmetry", sql("""SELECT round(qw, 6) AS query_words, round(sd, 6) AS query_words_std, round(lw, 6) AS label_words, round(qw / lw, 6) AS ratio,
    CASE WHEN qw / lw > 10 THEN 'very asymmetric' WHEN qw / lw > 5 THEN 'moderate' ELSE 'similar' END AS asymmetry, sd > qw * 0.5 AS high_variance
    FROM (SELECT avg(w) AS qw, stddev_pop(w) AS sd FROM x WHERE kind = 'query'), (SELECT avg(w) AS lw FROM x WHERE kind = 'pos')""", "v_text_sample", x=TEXTS))
def e11(spark, d):
    return rounded(op.length_asymmetry(t.v_text_sample(spark, d)))


SPLIT = "SELECT *, CASE WHEN left(query, 1) = '1' THEN 'eval' ELSE 'train' END AS split FROM v_sample"


@query("e12_split_stats", sql(f"""SELECT split, count(*) AS n, min(w) AS words_min, max(w) AS words_max, round(avg(w), 6) AS words_mean, round(stddev_pop(w), 6) AS words_std, median(w) AS words_median,
    round(avg(p), 6) AS pos_mean, round(stddev_pop(p), 6) AS pos_std, median(p) AS pos_median, round(avg(m), 6) AS neg_mean, round(stddev_pop(m), 6) AS neg_std, median(m) AS neg_median,
    round(count(*) * 100.0 / (SELECT count(*) FROM v_sample), 6)::DOUBLE AS pct FROM (SELECT split, {words('query')} AS w, len(pos) AS p, len(neg) AS m FROM s) GROUP BY split""", "v_sample", s=SPLIT))
def e12(spark, d):
    s = t.v_sample(spark, d).withColumn("split", F.when(F.col("query").startswith("1"), "eval").otherwise("train"))
    return rounded(op.split_stats(s))


@query("e12_category_stats", sql("""SELECT source AS category, count(*) AS total_available, count(*) FILTER (quality = 1) AS selected,
    round(count(*) FILTER (quality = 1) * 100.0 / count(*), 6)::DOUBLE AS percentage FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id GROUP BY 1"""))
def e12b(spark, d):
    all_rows = t.v_text(spark, d).select(F.col("doc_id").alias("sample_id"), F.col("source").alias("category"))
    good = t.table(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("sample_id"))
    return rounded(op.category_stats(all_rows, all_rows.join(good, "sample_id")))


@query("e13_compression_stats", sql(f"""SELECT *, round(need_compress * 100.0 / n_before, 6)::DOUBLE AS need_compress_pct, round(need_split * 100.0 / n_before, 6)::DOUBLE AS need_split_pct,
    round(n_after / n_before, 6) AS expansion_ratio FROM (SELECT count(*) AS n_before, round(avg(tok), 6) AS avg_before, max(tok) AS max_before, min(tok) AS min_before, count(*) FILTER (r <> 'keep') AS need_compress,
    count(*) FILTER (r = 'split') AS need_split, CAST(sum(n_pos) AS BIGINT) AS n_pos FROM b), (SELECT count(*) AS n_after, round(avg(t2), 6) AS avg_after, max(t2) AS max_after, min(t2) AS min_after,
    count(*) FILTER (t2 > 320) AS still_too_long, count(*) FILTER (r = 'keep') AS n_keep, count(*) FILTER (r = 'split') AS n_split, count(*) FILTER (r = 'compress') AS n_compress FROM a)""",
    b=f"SELECT doc_id, CAST(floor({words('text')} * 1.3) AS BIGINT) AS tok, 4 AS n_pos, CASE WHEN CAST(floor({words('text')} * 1.3) AS BIGINT) <= 320 THEN 'keep' WHEN lang = 'en' THEN 'split' ELSE 'compress' END AS r FROM documents",
    a="SELECT r, CASE WHEN r = 'keep' THEN tok ELSE tok // 2 END AS t2 FROM b, (SELECT unnest([1, 2]) AS g) WHERE g = 1 OR r = 'split'"))
def e13(spark, d):
    tokens = tx.token_count(F.col("query"))
    route = F.when(tokens <= 320, "keep").when(F.col("lang") == "en", "split").otherwise("compress")
    before = t.v_text(spark, d).select("doc_id", tokens.alias("tokens"), route.alias("route"), F.lit(4).alias("n_pos"))
    copies = F.when(F.col("route") == "split", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    after = before.select(F.col("route").alias("strategy"), F.when(F.col("route") == "keep", F.col("tokens")).otherwise(F.floor(F.col("tokens") / 2)).alias("tokens"), F.explode(copies))
    return rounded(op.compression_stats(before, after))


@query("e15_reduction_by_label", sql(f"SELECT f.label, f.n AS n_before, coalesce(g.n, 0) AS n_after, f.n - coalesce(g.n, 0) AS removed, f.n > {LIMIT} AS overfull FROM f LEFT JOIN g ON f.label = g.label",
    "v_sample_label", f=COARSE, g="SELECT coarse_label AS label, count(*) AS n FROM v_sample_label JOIN orders ON sample_id = o_orderkey WHERE NOT is_neg AND o_orderstatus <> 'P' GROUP BY 1"))
def e15(spark, d):
    s = coarse_samples(spark, d)
    kept = s.join(t.table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("sample_id")), "sample_id", "left_semi")
    return op.reduction_by_label(op.label_frequency(s), op.label_frequency(kept), LIMIT)


@query("e15_reduction_stats", sql(f"""SELECT (SELECT count(*) FROM v_sample) AS original, (SELECT count(*) FROM v_sample WHERE split_part(query,' ',-2) <> 'P') AS final,
    (SELECT count(*) FROM v_sample WHERE split_part(query,' ',-2) = 'P') AS removed, (SELECT count(*) FROM f WHERE n > {LIMIT}) AS overfull_labels""", "v_sample", f=COARSE))
def e15b(spark, d):
    s = coarse_samples(spark, d)
    kept = s.join(t.table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("sample_id")), "sample_id", "left_semi")
    return op.reduction_stats(s, kept, op.reduction_by_label(op.label_frequency(s), op.label_frequency(kept), LIMIT))


@query("e15_top_reduced", sql("SELECT label, n AS n_before, 0 AS n_after, n AS removed, false AS overfull FROM f ORDER BY n DESC, label LIMIT 10", "v_sample_label", f=COARSE))
def e15c(spark, d):
    f = op.label_frequency(coarse_samples(spark, d))
    return op.top_reduced(op.reduction_by_label(f, f.limit(0), 10 ** 9), 10)


@query("e16_histogram", sql(f"SELECT lang, least(CAST(floor({words('query')} / 100) AS BIGINT), 49) AS bin, count(*) AS n FROM v_text WHERE {words('query')} BETWEEN 0 AND 5000 GROUP BY ALL", "v_text"))
def e16(spark, d):
    x = t.v_text(spark, d).select("lang", tx.word_count(F.col("query")).alias("w"))
    return op.histogram(x, "w", 50, 0, 5000, group="lang")


@query("e16_histogram_density", """SELECT lang, bin, n, round(n / (sum(n) OVER (PARTITION BY lang) * 20), 6) AS density FROM (
    SELECT lang, least(CAST(floor(n_chars / 20) AS BIGINT), 49) AS bin, count(*) AS n FROM documents WHERE n_chars BETWEEN 0 AND 1000 GROUP BY ALL)""")
def e16b(spark, d):
    return rounded(op.histogram(t.v_text(spark, d), "n_chars", 50, 0, 1000, group="lang", density=True))


@query("e17_exposure_stats", sql("""SELECT *, round(n_pairs / n_samples, 6) AS pairs_per_sample, round(with_hard * 100.0 / n_pairs, 6)::DOUBLE AS with_hard_pct, round(h / n_pairs, 6) AS avg_hard_negatives,
    round(63 - h / n_pairs, 6) AS in_batch_negatives FROM (SELECT (SELECT count(*) FROM v_sample) AS n_samples, CAST(sum(len(pos)) AS BIGINT) AS n_pairs,
    CAST(sum(CASE WHEN len(neg) > 0 THEN len(pos) ELSE 0 END) AS BIGINT) AS with_hard, sum(len(pos) * least(3, len(neg))) AS h FROM v_sample)""".replace("SELECT *,", "SELECT n_samples, n_pairs, with_hard,"), "v_sample"))
def e17(spark, d):
    s = t.v_sample(spark, d)
    return rounded(op.exposure_stats(pairs.training_pairs(s), s))


@query("e18_positives_per_query", sql("""SELECT count(*) AS n_queries, round(avg(n), 6) AS avg_pos, min(n) AS min_pos, max(n) AS max_pos,
    (SELECT count(*) FROM (SELECT DISTINCT unnest(list_concat(pos, neg)) FROM v_sample WHERE len(pos) > 0)) AS corpus_size
    FROM (SELECT sample_id, count(DISTINCT l) AS n FROM (SELECT sample_id, unnest(pos) AS l FROM v_sample) GROUP BY 1)""", "v_sample"))
def e18(spark, d):
    _, corpus, qrels = pairs.ir_dataset(t.v_sample(spark, d))
    return rounded(op.positives_per_query(qrels, corpus))
