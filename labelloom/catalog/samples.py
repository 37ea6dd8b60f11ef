"""B and C: projections, normalisation, deduplication, coverage, provenance."""
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import stable_distinct
from ..operators import dedup, fuzzy, relations, samples as op
from ..sources import tables as t
from .base import joined, query, r6, rounded
from .views import sql, words

FLAT = "sample_id, query, array_to_string(pos,'|') AS pos, array_to_string(neg,'|') AS neg"


def _flat(df, *more):
    return df.select("sample_id", "query", joined("pos"), joined("neg"), *more)


def with_gaps(df):
    """Partly shipped orders lose their query, empty lists become null."""
    status = F.element_at(F.split("query", " "), -2)
    return df.select("sample_id", "row_no", F.when(status != "P", F.col("query")).alias("query"),
                     *[F.when(F.size(c) > 0, F.col(c)).alias(c) for c in ("pos", "neg")], F.lit("x").alias("other"))


@query("b1_normalise_samples", sql(f"SELECT {FLAT} FROM v_sample WHERE split_part(query,' ',-2) <> 'P'", "v_sample"))
def b1(spark, d):
    return _flat(op.normalise_samples(with_gaps(t.v_sample(spark, d))))


@query("b2_standardise", sql("""SELECT sample_id, CASE left(query,1) WHEN '1' THEN 'from text' ELSE query END AS query,
    CASE left(query,1) WHEN '2' THEN pos[1] ELSE array_to_string(pos,'|') END AS pos, array_to_string(neg,'|') AS neg,
    'orders' AS source, left(query,1) AS extra FROM v_sample WHERE len(pos) > 0""", "v_sample"))
def b2(spark, d):
    s = t.v_sample(spark, d)
    p = F.substring("query", 1, 1)
    rec = F.when(p == "1", F.to_json(F.struct(F.lit("from text").alias("text"), F.col("query").alias("title"), F.col("pos").alias("skills"), F.col("neg").alias("negative"), p.alias("extra"))))
    rec = rec.when(p == "2", F.to_json(F.struct("query", F.get("pos", F.lit(0)).alias("labels"), F.col("neg").alias("hard_negatives"), p.alias("extra"))))
    rec = rec.otherwise(F.to_json(F.struct("query", F.array().cast("array<string>").alias("pos"), F.col("pos").alias("competences"), "neg", p.alias("extra"))))
    out = op.standardise(s.select("sample_id", rec.alias("record")), "orders")
    return _flat(out, F.col("metadata")["source_dataset"].alias("source"), F.col("metadata")["extra"].alias("extra"))


def enriched(spark, d):
    return relations.enrich_labels(t.v_sample(spark, d), t.v_skill_partial(spark, d))


LOOK = """SELECT s.sample_id, side, i, s.l AS label, p.description AS description, p.label IS NOT NULL AS hit FROM (
    SELECT sample_id, 'pos' AS side, unnest(pos) AS l, generate_subscripts(pos, 1) AS i FROM v_sample UNION ALL
    SELECT sample_id, 'neg', unnest(neg), generate_subscripts(neg, 1) FROM v_sample) s LEFT JOIN v_skill_partial p ON s.l = p.label"""
ENR = "SELECT *, CASE WHEN hit THEN label || ': ' || description ELSE label END AS t FROM look"
LISTS = """SELECT s.sample_id, s.query, coalesce(string_agg(t, '|' ORDER BY i) FILTER (side = 'pos'), '') AS pos,
    coalesce(string_agg(t, '|' ORDER BY i) FILTER (side = 'neg'), '') AS neg FROM v_sample s LEFT JOIN (SELECT * FROM enr {where}) e ON s.sample_id = e.sample_id GROUP BY ALL"""


@query("b3_filter_labels", sql(LISTS.format(where="WHERE contains(t, ':')"), "v_sample", "v_skill_partial", look=LOOK, enr=ENR))
def b3(spark, d):
    return _flat(op.filter_labels(enriched(spark, d)))


@query("b4_drop_empty_pos", sql("SELECT * FROM (" + LISTS.format(where="WHERE contains(t, ':')") + ") WHERE pos <> ''", "v_sample", "v_skill_partial", look=LOOK, enr=ENR))
def b4(spark, d):
    return _flat(op.drop_empty_pos(op.filter_labels(enriched(spark, d))))


@query("b5_extract_names", sql("SELECT label AS name, min(p_partkey) AS row_no FROM v_item GROUP BY 1", "v_item"))
def b5(spark, d):
    return op.extract_names(t.v_item(spark, d), "label", row_no="p_partkey")


@query("b6_evaluable", sql(f"SELECT {FLAT} FROM v_sample WHERE split_part(query,' ',-2) <> 'P' AND len(pos) > 0", "v_sample"))
def b6(spark, d):
    s = with_gaps(t.v_sample(spark, d)).withColumn("neg", F.coalesce("neg", F.expr("cast(array() as array<string>)")))
    return _flat(op.evaluable(s))


SPACE = r"[\s\x0B\x{1c}-\x{1f}\x{85}\p{Z}]"


@query("b7_clean_text", f"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), 'http\\S+|www\\S+|https\\S+', '', 'g'),
    '\\S+@\\S+', '', 'g'), '{SPACE}+', ' ', 'g'), '^ | $', '', 'g')) AS digest FROM documents""")
def b7(spark, d):
    return t.v_text(spark, d).select("doc_id", F.md5(tx.clean_text(F.col("query"))).alias("digest"))


@query("b8_with_prefix", sql("SELECT sample_id, 'query: ' || query AS anchor, array_to_string(list_transform(pos, lambda x: 'passage: ' || x), '|') AS pos, query AS plain FROM v_sample", "v_sample"))
def b8(spark, d):
    return t.v_sample(spark, d).select(
        "sample_id", tx.with_prefix(F.col("query"), "query", model="multilingual-e5-base").alias("anchor"),
        joined(F.transform("pos", lambda x: tx.with_prefix(x, "passage")), "pos"), tx.with_prefix(F.col("query"), model="other").alias("plain"))


@query("b9_skill_text", sql("SELECT label, CASE WHEN size > 12 THEN label || ': ' || description ELSE label END AS t FROM v_skill", "v_skill"))
def b9(spark, d):
    return t.v_skill(spark, d).select("label", tx.skill_text(F.col("label"), F.when(F.col("size") > 12, F.col("description"))).alias("t"))


@query("b10_sample_text", sql("SELECT sample_id, query || ' ' || array_to_string(pos, ' ') AS t FROM v_sample", "v_sample"))
def b10(spark, d):
    return t.v_sample(spark, d).select("sample_id", tx.sample_text(F.col("query"), F.col("pos")).alias("t"))


@query("b11_profile_fields", sql("""SELECT 'query' AS field, 'string' AS type, count(*) AS n_rows, count(q) AS non_null, min(length(q)) AS min_size, max(length(q)) AS max_size, round(avg(length(q)), 6) AS avg_size FROM g
    UNION ALL SELECT 'pos', 'array', count(*), count(pos), min(len(pos)), max(len(pos)), round(avg(len(pos)), 6) FROM g""", "v_sample",
    g="SELECT CASE WHEN split_part(query,' ',-2) <> 'P' THEN query END AS q, CASE WHEN len(pos) > 0 THEN pos END AS pos FROM v_sample"))
def b11(spark, d):
    return rounded(op.profile_fields(with_gaps(t.v_sample(spark, d)).select("query", "pos")))


# --- C ----------------------------------------------------------------------------------------------

MERGED = """SELECT min(row_no) AS row_no, md5(query) AS digest, count(*) AS n,
    CASE WHEN count(*) > 1 THEN array_to_string(list_sort(list_distinct(flatten(list(pos)))), '|') ELSE array_to_string(any_value(pos), '|') END AS pos,
    CASE WHEN count(*) > 1 THEN array_to_string(list_sort(list_distinct(flatten(list(neg)))), '|') ELSE array_to_string(any_value(neg), '|') END AS neg
    FROM {view} GROUP BY query"""


@query("c1_merge_duplicates", sql(MERGED.format(view="v_text_sample"), "v_text_sample"))
def c1(spark, d):
    return dedup.merge_duplicates(t.v_text_sample(spark, d)).select("row_no", F.md5("query").alias("digest"), "n", joined("pos"), joined("neg"))


@query("c2_dedup_summary", sql("""SELECT count(*) AS initial, count(DISTINCT query) AS final, count(*) - count(DISTINCT query) AS merged,
    round((count(*) - count(DISTINCT query)) * 100.0 / count(*), 6)::DOUBLE AS reduction_pct FROM v_text_sample""", "v_text_sample"))
def c2(spark, d):
    s = t.v_text_sample(spark, d)
    return rounded(dedup.dedup_summary(s, dedup.merge_duplicates(s)))


@query("c3_label_pool", sql("SELECT DISTINCT unnest(list_concat(pos, neg)) AS label FROM v_sample", "v_sample"))
def c3(spark, d):
    return dedup.label_pool(t.v_sample(spark, d))


@query("c4_stable_distinct", sql("""SELECT sample_id, string_agg(coarse_label, '|' ORDER BY p) AS labels FROM (
    SELECT sample_id, coarse_label, min(pos_no) AS p FROM v_sample_label GROUP BY ALL) GROUP BY 1""", "v_sample_label"))
def c4(spark, d):
    lists = t.v_sample_label(spark, d).groupBy("sample_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos_no", "coarse_label"))), lambda x: x.coarse_label).alias("l"))
    return lists.select("sample_id", joined(stable_distinct(F.col("l")), "labels"))


@query("c5_coverage", sql("""SELECT (SELECT count(*) FROM c) AS covered, (SELECT count(*) FROM v_skill_partial) AS skills,
    (SELECT count(*) FROM v_skill_partial WHERE label NOT IN (SELECT l FROM c)) AS uncovered,
    round((SELECT count(*) FROM c) * 100.0 / (SELECT count(*) FROM v_skill_partial), 6)::DOUBLE AS coverage_pct""", "v_sample", "v_skill_partial",
    c="SELECT DISTINCT unnest(pos) AS l FROM v_sample"))
def c5(spark, d):
    return rounded(dedup.coverage(t.v_sample(spark, d), t.v_skill_partial(spark, d)))


@query("c5_uncovered_labels", sql("""SELECT label FROM v_skill WHERE label NOT IN (SELECT l FROM c)""", "v_sample", "v_skill",
    c="SELECT DISTINCT unnest(pos) AS l FROM v_sample WHERE left(query,1) = '1'"))
def c5b(spark, d):
    return dedup.uncovered_labels(t.v_sample(spark, d).where("substring(query,1,1) = '1'"), t.v_skill(spark, d))


@query("c6_annotate_exact", sql("SELECT sample_id, CASE WHEN query IN (SELECT query FROM v_real) THEN 'real' ELSE 'synthetic' END AS source FROM v_text_sample", "v_text_sample", "v_real"))
def c6(spark, d):
    return dedup.annotate_exact(t.v_text_sample(spark, d), t.v_real(spark, d)).select("sample_id", "source")


@query("c6_source_counts", sql("""SELECT count(*) AS total, count(*) FILTER (query IN (SELECT query FROM v_real)) AS n_real,
    count(*) FILTER (query NOT IN (SELECT query FROM v_real)) AS n_synthetic FROM v_text_sample""", "v_text_sample", "v_real"))
def c6b(spark, d):
    return dedup.source_counts(dedup.annotate_exact(t.v_text_sample(spark, d), t.v_real(spark, d)))


@query("c8_head_sample", sql(f"SELECT {FLAT} FROM v_sample ORDER BY row_no LIMIT 25", "v_sample"))
def c8(spark, d):
    return _flat(dedup.head_sample(t.v_sample(spark, d), 25))


@query("c7_annotate_fuzzy")
def c7(spark, d):
    return fuzzy.annotate_fuzzy(t.v_text_sample(spark, d), t.v_real(spark, d), 0.95).select("sample_id", "source")


@query("c7_annotate_fuzzy_variants", sql("""SELECT concat(md5(query), '-', variant) AS sample_id,
    CASE WHEN variant = 'same' OR variant = 'longer' AND length(query) >= 10 THEN 'real' ELSE 'synthetic' END AS source
    FROM v_real, (VALUES ('same'), ('longer'), ('other')) AS v(variant) WHERE query <> ''""", "v_real"))
def c7_variants(spark, d):
    """Every validated text as it is, with one character more (a ratio of 2n/(2n+1)), and with every character replaced."""
    real = t.v_real(spark, d).where("query <> ''")
    variants = F.array(*[F.struct(F.lit(name).alias("name"), text.alias("text")) for name, text in (
        ("same", F.col("query")), ("longer", F.concat("query", F.lit("‡"))), ("other", F.repeat(F.lit("‡"), F.length("query"))))])
    x = real.select(F.md5("query").alias("k"), F.explode(variants).alias("v"))
    rows = x.select(F.concat_ws("-", "k", "v.name").alias("sample_id"), F.lit(0).alias("row_no"), F.col("v.text").alias("query"), F.array(F.lit("a")).alias("pos"), F.array(F.lit("b")).alias("neg"))
    return fuzzy.annotate_fuzzy(rows, real, 0.95).select("sample_id", "source")
