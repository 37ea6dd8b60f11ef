"""D: joins between samples, label documents and groups."""
from pyspark.sql import functions as F

from ..operators import relations as op
from ..operators.similarity import cooccurring_by_group
from ..sources import tables as t
from .base import joined, query, rounded
from .samples import ENR, LISTS, LOOK, enriched
from .views import sql


@query("d1_enrich_labels", sql(LISTS.format(where=""), "v_sample", "v_skill_partial", look=LOOK, enr=ENR))
def d1(spark, d):
    return enriched(spark, d).select("sample_id", "query", joined("pos"), joined("neg"))


@query("d1_enrich_labels_drop_missing", sql(LISTS.format(where="WHERE hit OR side = 'pos'"), "v_sample", "v_skill_partial", look=LOOK, enr=ENR))
def d1b(spark, d):
    e = op.enrich_labels(t.v_sample(spark, d), t.v_skill_partial(spark, d), neg_fallback=False)
    return e.select("sample_id", "query", joined("pos"), joined("neg"))


@query("d2_enrichment_coverage", sql("""SELECT side, count(*) AS total_labels, count(DISTINCT label) AS unique_labels,
    count(*) FILTER (hit) AS enrichable_labels, count(DISTINCT label) FILTER (NOT hit) AS missing_labels FROM look GROUP BY side""", "v_sample", "v_skill_partial", look=LOOK))
def d2(spark, d):
    return op.enrichment_coverage(t.v_sample(spark, d), t.v_skill_partial(spark, d))


@query("d3_enrichment_gain", sql("""SELECT CAST(sum(length(label)) AS BIGINT) AS chars_before, CAST(sum(length(t)) AS BIGINT) AS chars_after,
    count(*) FILTER (length(t) > length(label)) AS labels_grown, round(sum(length(t)) / sum(length(label)), 6) AS expansion FROM enr""", "v_sample", "v_skill_partial", look=LOOK, enr=ENR))
def d3(spark, d):
    return rounded(op.enrichment_gain(t.v_sample(spark, d), t.v_skill_partial(spark, d)))


@query("d4_label_index", sql("SELECT DISTINCT unnest(pos) AS label, sample_id, query FROM v_sample", "v_sample"))
def d4(spark, d):
    return op.label_index(t.v_sample(spark, d)).queries


@query("d4_label_index_negatives", sql("SELECT DISTINCT label, unnest(neg) AS negative FROM (SELECT DISTINCT unnest(pos) AS label, neg FROM v_sample)", "v_sample"))
def d4b(spark, d):
    return op.label_index(t.v_sample(spark, d)).negatives


@query("d4_label_index_groups", sql("""SELECT unnest(g) AS label, sample_id, row_no, array_to_string(g, '|') AS labels FROM (
    SELECT sample_id, row_no, list_filter(pos, lambda x, i: list_position(pos, x) = i) AS g FROM v_sample)""", "v_sample"))
def d4c(spark, d):
    return op.label_index(t.v_sample(spark, d)).groups.withColumn("labels", joined("labels"))


@query("d4_label_summary", sql("""SELECT q.label, q.n AS n_samples, coalesce(m.n, 0) AS n_negatives FROM
    (SELECT label, count(*) AS n FROM (SELECT DISTINCT unnest(pos) AS label, sample_id FROM v_sample) GROUP BY 1) q LEFT JOIN
    (SELECT label, count(DISTINCT negative) AS n FROM (SELECT label, unnest(neg) AS negative FROM (SELECT DISTINCT unnest(pos) AS label, neg FROM v_sample)) GROUP BY 1) m ON q.label = m.label""", "v_sample"))
def d4d(spark, d):
    return op.label_summary(op.label_index(t.v_sample(spark, d)))


@query("d5_label_cooccurrence", sql("""SELECT a.l AS label, b.l AS other, count(*) AS n FROM (SELECT sample_id, unnest(pos) AS l FROM v_sample) a
    JOIN (SELECT sample_id, unnest(pos) AS l FROM v_sample) b ON a.sample_id = b.sample_id AND a.l <> b.l GROUP BY ALL""", "v_sample"))
def d5(spark, d):
    return op.label_cooccurrence(t.v_sample(spark, d))


def occupation_lists(spark, d):
    return t.v_skill_occ(spark, d).groupBy("label").agg(F.collect_list(F.col("occupation").cast("string")).alias("occupations"))


@query("d6_cooccurring_by_group", sql("""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY shared DESC, label) AS rank FROM n) WHERE rank <= 10""", "v_skill_occ",
    n="SELECT a.label AS target, b.label AS label, count(*) AS shared FROM v_skill_occ a JOIN v_skill_occ b ON a.occupation = b.occupation AND a.label <> b.label GROUP BY ALL"))
def d6(spark, d):
    lists = occupation_lists(spark, d)
    return cooccurring_by_group(lists, lists)


@query("d7_resolve_qrels", sql("""SELECT DISTINCT sample_id AS query_id, c.corpus_id FROM (SELECT sample_id, unnest(string_split(pos, '|')) AS l FROM lists) x
    JOIN (SELECT label AS title, row_no AS corpus_id FROM v_skill) c ON x.l = c.title OR starts_with(x.l, c.title || ': ')""", "v_sample", "v_skill", "v_skill_partial", look=LOOK, enr=ENR, lists=LISTS.format(where="")))
def d7(spark, d):
    corpus = t.v_skill(spark, d).select(F.col("label").alias("title"), F.col("row_no").alias("corpus_id"))
    return op.resolve_qrels(enriched(spark, d), corpus)


@query("d7_resolve_qrels_repeats", sql("""SELECT query_id, corpus_id, count(*) AS n FROM (SELECT sample_id AS query_id, unnest(pos) AS l FROM v_sample) x
    JOIN (SELECT label AS title, row_no AS corpus_id FROM v_skill) c ON x.l = c.title GROUP BY ALL""", "v_sample", "v_skill"))
def d7b(spark, d):
    corpus = t.v_skill(spark, d).select(F.col("label").alias("title"), F.col("row_no").alias("corpus_id"))
    q = op.resolve_qrels(t.v_sample(spark, d), corpus, prefix=False, distinct=False)
    return q.groupBy("query_id", "corpus_id").agg(F.count(F.lit(1)).alias("n"))


@query("d8_query_labels", sql("""SELECT md5(query) AS digest, string_agg(p, '|' ORDER BY dataset) AS labels FROM
    (SELECT query, lang AS dataset, arg_min(source, doc_id) AS p FROM v_text GROUP BY ALL) GROUP BY query""", "v_text"))
def d8(spark, d):
    s = t.v_text(spark, d).select(F.col("lang").alias("dataset"), "query", F.array("source").alias("pos"), F.col("doc_id").alias("row_no"))
    return op.query_labels(s).select(F.md5("query").alias("digest"), joined("labels"))


@query("d9_invert_groups", sql("SELECT occupation, count(DISTINCT label) AS n_skills, count(DISTINCT label) >= 2 AS usable FROM v_skill_occ GROUP BY 1", "v_skill_occ"))
def d9(spark, d):
    return op.invert_groups(t.v_skill_occ(spark, d))
