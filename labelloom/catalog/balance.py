"""H: balancing, sampling, selection."""
from pyspark.sql import functions as F

from ..operators import balance as op, classify, stats
from ..operators.similarity import cooccurring_by_group, group_hard_negatives
from ..sources import tables as t
from .base import joined, query, rounded
from .classify import CATS, KW, TEXT_CATS, TOP2
from .relations import occupation_lists
from .similarity import SHARED
from .stats import COARSE, LIMIT, coarse_samples
from .views import sql, words

CLOSED = dict(
    f=COARSE, l="SELECT sample_id, coarse_label AS label, pos_no FROM v_sample_label WHERE NOT is_neg AND coarse_label IN (SELECT label FROM f WHERE n > %d)" % LIMIT,
    k="SELECT sample_id, count(*) AS k FROM l GROUP BY 1 HAVING count(*) > 1",
    m="SELECT sample_id, label, k, count(*) AS m, min(pos_no) AS p FROM l JOIN k USING (sample_id) GROUP BY ALL",
    b="SELECT *, coalesce(sum(m) OVER (PARTITION BY label ORDER BY k DESC, sample_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m",
    r="SELECT sample_id, string_agg(b.label, '|' ORDER BY p) AS labels FROM b JOIN f ON b.label = f.label WHERE before < n - %d GROUP BY 1" % LIMIT)


@query("h1_cap_multi_label", sql("SELECT * FROM r", "v_sample_label", **CLOSED))
def h1(spark, d):
    return op.cap_multi_label(coarse_samples(spark, d), LIMIT, order_bucket=1000).select("sample_id", joined("labels"))


def vec_label_samples(spark, d):
    """Vectors as samples of their label: at most 40 per label wanted."""
    v = t.v_vec(spark, d)
    return v.select(F.col("vec_id").alias("sample_id"), F.col("vec_id").alias("row_no"), "vector", F.array(F.col("label").cast("string")).alias("pos"))


RED = """SELECT q AS sample_id, CAST(ql AS VARCHAR) AS label, round(avg(s), 9) AS redundancy FROM (SELECT a.vec_id AS q, a.label AS ql, list_cosine_similarity(a.vector, b.vector) AS s
    FROM v_vec a JOIN v_vec b ON a.label = b.label AND a.vec_id <> b.vec_id) GROUP BY ALL"""
SURPLUS = "SELECT CAST(label AS VARCHAR) AS label, count(*) - 40 AS surplus FROM v_vec GROUP BY 1 HAVING count(*) > 40"


@query("h2_cap_label", sql("SELECT sample_id, label FROM (SELECT red.*, surplus, row_number() OVER (PARTITION BY red.label ORDER BY redundancy DESC, sample_id) AS r FROM red JOIN su ON red.label = su.label) WHERE r <= surplus",
    "v_vec", red=RED, su=SURPLUS))
def h2(spark, d):
    return op.cap_label(vec_label_samples(spark, d), 40, 64)


@query("h2_cap_label_mixed", sql("SELECT label, surplus AS n FROM su", "v_vec", su=SURPLUS))
def h2b(spark, d):
    """With a random part the number of removals per label stays the surplus."""
    return op.cap_label(vec_label_samples(spark, d), 40, 64, diversity_weight=0.5).groupBy("label").agg(F.count_distinct("sample_id").alias("n"))


@query("h3_removed_with_reason", sql("SELECT sample_id, 'Multiple overfitting labels: ' || replace(labels, '|', ', ') AS removal_reason FROM r", "v_sample_label", **CLOSED))
def h3(spark, d):
    multi = op.cap_multi_label(coarse_samples(spark, d), LIMIT)
    none = multi.limit(0).select("sample_id", F.lit("x").alias("label"))
    return op.removed_with_reason(multi, none)


@query("h3_removed_both_reasons", sql("""SELECT sample_id, 'Multiple overfitting labels: ' || replace(labels, '|', ', ') AS removal_reason FROM r
    UNION ALL SELECT sample_id, 'Overfitting label: ' || min(label) FROM l WHERE sample_id NOT IN (SELECT sample_id FROM r) AND sample_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""", "v_sample_label", **CLOSED))
def h3_both(spark, d):
    """Second step: the overfull labels of finished orders; the reason of the first step wins."""
    s = coarse_samples(spark, d)
    finished = t.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("sample_id"))
    over = stats.overfull_labels(stats.label_frequency(s), LIMIT).select("label")
    single = s.select("sample_id", F.explode("pos").alias("label")).join(over, "label", "left_semi").join(finished, "sample_id", "left_semi").distinct()
    return op.removed_with_reason(op.cap_multi_label(s, LIMIT), single)


@query("e15_multi_label_impact", sql("SELECT label, count(*) AS n FROM l WHERE sample_id IN (SELECT sample_id FROM r) GROUP BY 1", "v_sample_label", **CLOSED))
def e15_impact(spark, d):
    s = coarse_samples(spark, d)
    return stats.multi_label_impact(s, op.cap_multi_label(s, LIMIT), LIMIT)


@query("e15_top_reduced_by_walk", sql(f"""SELECT label, n AS n_before, n - coalesce(gone, 0) AS n_after, gone AS removed, n > {LIMIT} AS overfull FROM f JOIN (SELECT coarse_label AS label, count(*) AS gone FROM v_sample_label
    WHERE NOT is_neg AND sample_id IN (SELECT sample_id FROM r) GROUP BY 1) USING (label) ORDER BY removed DESC, label LIMIT 10""", "v_sample_label", **CLOSED))
def e15_walk(spark, d):
    """The labels that lost most samples through the walk over multi-label samples."""
    s = coarse_samples(spark, d)
    kept = s.join(op.cap_multi_label(s, LIMIT).select("sample_id"), "sample_id", "left_anti")
    return stats.top_reduced(stats.reduction_by_label(stats.label_frequency(s), stats.label_frequency(kept), LIMIT), 10)


def classified(spark, d):
    """(sample_id, category, bucket) of v_sample."""
    x = classify.length_bucket(t.v_sample(spark, d))
    return x.select("sample_id", F.explode(classify.classify_keywords(F.col("query"), F.col("pos"), CATS)).alias("category"), "bucket")


def classified_text(spark, d):
    x = classify.length_bucket(t.v_text_sample(spark, d))
    return x.select("sample_id", F.explode(classify.classify_keywords(F.col("query"), F.col("pos"), TEXT_CATS)).alias("category"), "bucket")


def cls(v, k):
    w = words("query")
    return dict(k=KW.format(v=v, k=k), top2=TOP2, bu=f"""SELECT sample_id, CASE WHEN {w} <= a THEN 'short' WHEN {w} <= b THEN 'medium' ELSE 'long' END AS bucket
        FROM {v}, (SELECT quantile_cont({w}, 0.25) AS a, quantile_cont({w}, 0.75) AS b FROM {v})""",
        cl=f"""SELECT sample_id, code AS category, bucket FROM (SELECT sample_id, code FROM top2 WHERE r = 1 OR (r = 2 AND s >= 0.7 * m)
        UNION ALL SELECT sample_id, 'UNCLASSIFIED' FROM {v} WHERE sample_id NOT IN (SELECT sample_id FROM k)) JOIN bu USING (sample_id)""")


SIZES = "SELECT category, count(*) AS size FROM cl GROUP BY 1"
RATIO = "SELECT category, size, greatest(5, CAST(floor(size * {r}) AS BIGINT)) AS quota FROM sz"


@query("h4_quota_ratio", sql("SELECT category, size, least(quota, 500) AS quota FROM q", "v_sample", "v_kw", **cls("v_sample", "v_kw"), sz=SIZES, q=RATIO.format(r="0.1::DOUBLE")))
def h4(spark, d):
    return op.quota_ratio(classified(spark, d), 0.1, 5, 500)


@query("h5_quota_size", sql("""SELECT category, size, want AS quota FROM rec WHERE want > 0""", "v_text_sample", "v_text_kw", **cls("v_text_sample", "v_text_kw"), sz=SIZES,
    o="SELECT *, row_number() OVER (ORDER BY size, category) AS i, sum(size) OVER () AS total FROM sz WHERE category <> 'UNCLASSIFIED'",
    rec="""WITH RECURSIVE z(i, category, size, want, remaining) AS (SELECT 0::BIGINT, '', 0::BIGINT, 0::BIGINT, 120::BIGINT UNION ALL
        SELECT o.i, o.category, o.size, w.want, z.remaining - w.want FROM z JOIN o ON o.i = z.i + 1, LATERAL (SELECT least(60::BIGINT, greatest(5::BIGINT, CASE WHEN o.size <= 50 THEN o.size // 2
        ELSE CAST(floor(120 * (o.size / o.total)) AS BIGINT) END), z.remaining) AS want) w) SELECT * FROM z WHERE i > 0"""))
def h5(spark, d):
    return op.quota_size(classified_text(spark, d), 120, 5, 60)


def pick_sql(rows, quota):
    """One category set: number per bucket first, then md5 order."""
    return f"""SELECT sample_id, category FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY CASE WHEN b <= per THEN 0 ELSE 1 END, CASE WHEN b <= per THEN o ELSE 0 END, h) AS place FROM (
        SELECT r.*, q.quota, CASE WHEN q.size >= 2 * q.quota THEN greatest(1, q.quota // nb) ELSE 0 END AS per FROM (
        SELECT *, row_number() OVER (PARTITION BY category, o ORDER BY h) AS b, count(*) FILTER (lead_row) OVER (PARTITION BY category) AS nb FROM (
        SELECT *, row_number() OVER (PARTITION BY category, o ORDER BY h) = 1 AS lead_row FROM (
        SELECT *, list_position(['short','medium','long'], bucket) AS o, md5('42|' || sample_id) AS h FROM {rows}))) r JOIN {quota} q ON q.category = r.category)) WHERE place <= quota"""


@query("h6_stratified_pick", sql(pick_sql("cl", "q"), "v_text_sample", "v_text_kw", **cls("v_text_sample", "v_text_kw"), sz=SIZES, q=RATIO.format(r="0.2::DOUBLE")))
def h6(spark, d):
    c = classified_text(spark, d)
    return op.stratified_pick(c, op.quota_ratio(c, 0.2, 5))


def split_sql(n):
    """Categories one after the other, smallest first, without what is taken; UNCLASSIFIED last and not layered."""
    ctes = dict(cls("v_text_sample", "v_text_kw"), sz=SIZES, q=RATIO.format(r="0.15::DOUBLE"),
                o="SELECT *, row_number() OVER (ORDER BY category = 'UNCLASSIFIED', size, category) AS i FROM q")
    taken = []
    for i in range(1, n + 1):
        free = "".join(f" AND sample_id NOT IN (SELECT sample_id FROM t{j})" for j in taken)
        rows = f"(SELECT cl.* FROM cl JOIN o ON o.category = cl.category WHERE i = {i} AND o.category <> 'UNCLASSIFIED'{free})"
        ctes[f"t{i}"] = pick_sql(rows, "q")
        taken.append(i)
    free = "".join(f" AND sample_id NOT IN (SELECT sample_id FROM t{j})" for j in taken)
    ctes["u"] = f"""SELECT sample_id, category FROM (SELECT cl.*, quota, row_number() OVER (ORDER BY md5('42|' || sample_id)) AS r FROM cl JOIN q USING (category)
        WHERE category = 'UNCLASSIFIED'{free}) WHERE r <= quota"""
    return sql(" UNION ALL ".join(f"SELECT * FROM t{i}" for i in taken) + " UNION ALL SELECT * FROM u", "v_text_sample", "v_text_kw", **ctes)


@query("h7_representative_split", split_sql(4))
def h7(spark, d):
    return op.representative_split(classified_text(spark, d), ratio=0.15, minimum=5)


PRIO = {"S5": 4.0, "99": 1.0, "L": 3.5}
SCORE = f"""SELECT label, category, round((CASE WHEN description <> '' THEN 2.0 ELSE 0.3 END + CASE WHEN n >= 10 THEN 2.0 WHEN n >= 6 THEN 1.5 ELSE 1.0 END
    + CASE WHEN length(description) >= 200 THEN 1.0 WHEN length(description) >= 120 THEN 0.6 WHEN length(description) >= 80 THEN 0.3 ELSE 0 END) * CASE category WHEN 'S5' THEN 4.0 WHEN 'L' THEN 3.5 ELSE 1.0 END, 9)::DOUBLE AS score
    FROM (SELECT label, description, len(occupations) AS n, CASE WHEN contains(label, 'gizmo') THEN 'S5' WHEN contains(label, 'ring') THEN 'L' ELSE '99' END AS category FROM v_doc
    WHERE len(occupations) >= 3 AND length(description) >= 50 AND label NOT IN (SELECT label FROM v_item WHERE p_size > 45))"""


def scored(spark, d, novelty=None):
    docs = t.v_doc(spark, d)
    covered = t.v_item(spark, d).where("p_size > 45").select("label").distinct()
    category = F.when(F.contains("label", F.lit("gizmo")), "S5").when(F.contains("label", F.lit("ring")), "L").otherwise("99")
    return op.score_expansion(docs, docs.select("label").join(covered, "label", "left_anti"), category, PRIO, novelty)


@query("h8_score_expansion", sql("SELECT label, category, round(score, 6) AS score FROM sc", "v_doc", "v_item", sc=SCORE))
def h8(spark, d):
    return rounded(scored(spark, d))


@query("h8_score_expansion_novelty", sql("""SELECT sc.label, category, round(score + 1.5 * coalesce(v.novelty, 0.5), 6) AS score FROM sc LEFT JOIN
    (SELECT label, max(CASE WHEN p_size > 30 THEN p_size / 50 END) AS novelty FROM v_item GROUP BY 1 HAVING max(p_size) > 20) v ON v.label = sc.label""", "v_doc", "v_item", sc=SCORE))
def h8_novelty(spark, d):
    """With a novelty for some labels, null for some and none for others."""
    novelty = t.v_item(spark, d).groupBy("label").agg(F.max(F.when(F.col("p_size") > 30, F.col("p_size") / 50)).alias("novelty"), F.max("p_size").alias("m")).where("m > 20").select("label", "novelty")
    return rounded(scored(spark, d, novelty))


SELECTED = """SELECT label, category, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY ok ORDER BY score DESC, label) AS g FROM (
    SELECT *, r <= CASE category WHEN 'S5' THEN 10 WHEN 'L' THEN 6 ELSE 4 END AS ok FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC, label) AS r FROM sc)))
    WHERE (ok AND g <= 80) OR (NOT ok AND g <= 40 - (SELECT least(80, count(*)) FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY score DESC, label) AS r FROM sc) WHERE r <= CASE category WHEN 'S5' THEN 10 WHEN 'L' THEN 6 ELSE 4 END))"""


@query("h9_select_expansion", sql("SELECT * FROM se", "v_doc", "v_item", sc=SCORE, se=SELECTED))
def h9(spark, d):
    return rounded(op.select_expansion(scored(spark, d), 40, PRIO)).select("label", "category", "score")


@query("h10_expansion_report", sql("SELECT se.label AS skill, score AS priority_score, description, array_to_string(occupations, '|') AS occupations, category FROM se JOIN v_doc ON se.label = v_doc.label", "v_doc", "v_item", sc=SCORE, se=SELECTED))
def h10(spark, d):
    rep = op.expansion_report(op.select_expansion(scored(spark, d), 40, PRIO), t.v_doc(spark, d))
    return rounded(rep.withColumn("occupations", joined("occupations")))


@query("h10_expansion_by_category", sql("SELECT category, count(*) AS n FROM se GROUP BY 1", "v_doc", "v_item", sc=SCORE, se=SELECTED))
def h10b(spark, d):
    return op.expansion_by_category(op.select_expansion(scored(spark, d), 40, PRIO))


CO = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY shared DESC, label) AS rank FROM (
    SELECT a.label AS target, b.label AS label, count(*) AS shared FROM v_skill_occ a JOIN v_skill_occ b ON a.occupation = b.occupation AND a.label <> b.label GROUP BY ALL)) WHERE rank <= 10"""
U = "((('0x' || substr(md5({k}), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"


def requests(spark, d):
    return t.v_skill(spark, d).select(F.col("label").alias("target"), F.explode(F.array(F.lit(0), F.lit(1))).alias("sample_no"))


def companions(spark, d):
    lists = occupation_lists(spark, d)
    return cooccurring_by_group(lists, lists)


COMP = f"""SELECT target, sample_no, label, pick FROM (SELECT co.target, sample_no, label, row_number() OVER (PARTITION BY co.target, sample_no ORDER BY -ln({U.format(k="'42|' || co.target || '|' || sample_no || '|' || label")}) / sqrt(shared), label) AS pick,
    greatest(1, ceil(3 - log2(8::DOUBLE - {U.format(k="'42|' || co.target || '|' || sample_no")} * 7::DOUBLE))) AS n FROM co, (SELECT unnest([0, 1]) AS sample_no)) WHERE pick <= n"""


@query("h11_weighted_companions", sql(COMP, "v_skill_occ", co=CO))
def h11(spark, d):
    return op.weighted_companions(requests(spark, d), companions(spark, d), 3)


@query("h12_vary_negatives", sql("""SELECT * FROM (SELECT target, sample_no, label, row_number() OVER (PARTITION BY target, sample_no ORDER BY md5('42|' || target || '|' || sample_no || '|' || label), label) AS pick
    FROM co, (SELECT unnest([0, 1]) AS sample_no)) WHERE pick <= 2""", "v_skill_occ", co=CO))
def h12(spark, d):
    return op.vary_negatives(requests(spark, d), companions(spark, d), 2)


POOL = """SELECT target, label FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, label) AS rank FROM (
    SELECT target, label, round(2 * o + CASE WHEN 1 - w / m >= 0.63 THEN least(5 * (1 - w / m), 3) ELSE 0 END + CASE WHEN w <= 1 THEN 1 ELSE 0 END + CASE WHEN label < 'm' THEN 0.5 ELSE 0 END, 9) AS score FROM n WHERE w <= 2)) WHERE rank <= 10"""


@query("h12_vary_negatives_pool", sql("""SELECT * FROM (SELECT target, sample_no, label, row_number() OVER (PARTITION BY target, sample_no ORDER BY md5('42|' || target || '|' || sample_no || '|' || label), label) AS pick
    FROM po, (SELECT unnest([0, 1]) AS sample_no)) WHERE pick <= 2""", "v_skill_occ", n=SHARED, po=POOL))
def h12_pool(spark, d):
    """Drawn from the hard negatives of each target."""
    lists = occupation_lists(spark, d)
    targets = lists.select(F.col("label").alias("target_id"), F.array("label").alias("positives"))
    pool = group_hard_negatives(targets, lists, lists.where("label < 'm'"), op.negative_pool_size(2))
    return op.vary_negatives(requests(spark, d), pool.withColumnRenamed("target_id", "target"), 2)


LIST = "[" + ", ".join(f"'{s}'" for s in op.SCENARIOS) + "]"


@query("h13_assign_scenarios", sql(f"""SELECT label, sample_no, scenario FROM (SELECT label, sample_no, s AS scenario, row_number() OVER (PARTITION BY label, sample_no ORDER BY md5('42|' || label || '|' || (sample_no // 9) || '|' || s)) AS r
    FROM v_skill, (SELECT unnest([0, 4, 8, 11]) AS sample_no), (SELECT unnest({LIST}) AS s)) WHERE r = sample_no % 9 + 1""", "v_skill"))
def h13(spark, d):
    x = t.v_skill(spark, d).select("label", F.explode(F.array(*[F.lit(i) for i in (0, 4, 8, 11)])).alias("sample_no"))
    return x.select("label", "sample_no", op.assign_scenario(F.col("label"), F.col("sample_no")).alias("scenario"))


@query("h14_shuffle", sql("SELECT sample_id, row_number() OVER (ORDER BY md5('42|' || sample_id), sample_id) AS place FROM v_sample", "v_sample"))
def h14(spark, d):
    """The place is attached by the ranks of the md5 order, so that the order itself is compared."""
    from ..functions.hashing import hash_order
    from ..functions.ranking import running_before
    x = op.shuffle(t.v_sample(spark, d).select("sample_id"))
    h = x.withColumn("h", hash_order(42, F.col("sample_id")))
    placed = running_before(h, [], F.conv(F.substring("h", 1, 2), 16, 10).cast("int"), [F.col("h"), F.col("sample_id")], {"place": F.lit(1).cast("long")})
    return placed.select("sample_id", (F.col("place") + 1).alias("place"))
