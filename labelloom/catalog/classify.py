"""F: classification and bucketing."""
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import classify as op
from ..sources import tables as t
from .base import joined, query, rounded
from .views import sql, words

CATS = op.categories(t.KEYWORDS)
TEXT_CATS = op.categories(t.TEXT_KEYWORDS)
NAMED = [op.Category(1, "src1", description="First source: the web"), op.Category(2, "src2", description="Second source")]


@query("f1_category_name", "SELECT doc_id, CASE source WHEN 'src1' THEN 'First source' WHEN 'src2' THEN 'Second source' ELSE source END AS name FROM documents")
def f1(spark, d):
    return t.v_text(spark, d).select("doc_id", op.category_name(F.col("source"), NAMED).alias("name"))


KW = """SELECT sample_id, code, ord, sum(CASE WHEN contains(lower(query), kw) THEN 2 ELSE 0 END + CASE WHEN contains(lower(array_to_string(pos, ' ')), kw) THEN 3 ELSE 0 END) AS s
    FROM {v}, {k} GROUP BY ALL HAVING s > 0"""
TOP2 = "SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY s DESC, ord) AS r, max(s) OVER (PARTITION BY sample_id) AS m FROM k"


@query("f2_classify_keywords", sql("""SELECT sample_id, code FROM top2 WHERE r = 1 OR (r = 2 AND s >= 0.7 * m)
    UNION ALL SELECT sample_id, 'UNCLASSIFIED' FROM v_sample WHERE sample_id NOT IN (SELECT sample_id FROM k)""", "v_sample", "v_kw", k=KW.format(v="v_sample", k="v_kw"), top2=TOP2))
def f2(spark, d):
    return t.v_sample(spark, d).select("sample_id", F.explode(op.classify_keywords(F.col("query"), F.col("pos"), CATS)).alias("code"))


@query("f2_classify_keywords_text", sql("""SELECT sample_id, code FROM top2 WHERE r = 1 OR (r = 2 AND s >= 0.7 * m)
    UNION ALL SELECT sample_id, 'UNCLASSIFIED' FROM v_text_sample WHERE sample_id NOT IN (SELECT sample_id FROM k)""", "v_text_sample", "v_text_kw", k=KW.format(v="v_text_sample", k="v_text_kw"), top2=TOP2))
def f2b(spark, d):
    return t.v_text_sample(spark, d).select("sample_id", F.explode(op.classify_keywords(F.col("query"), F.col("pos"), TEXT_CATS)).alias("code"))


def category_vectors(spark, d):
    """Mean vector of each label as a taxonomy of ten categories (a short list, read once)."""
    from ..functions.vectors import normalised
    dim = 64
    m = t.v_vec(spark, d).groupBy("label").agg(F.array(*[F.avg(F.col("vector")[i].cast("double")) for i in range(dim)]).alias("v"))
    rows = m.select("label", F.transform(normalised(F.col("v")), lambda x: F.round(x, 6)).alias("v")).orderBy("label").collect()
    return [op.Category(r.label, str(r.label), vector=list(r.v)) for r in rows]


CENTRES = """SELECT label AS code, list(v ORDER BY i) AS c FROM (SELECT label, i, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 6) AS v FROM (
    SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(vector) AS x, generate_subscripts(vector, 1) AS i FROM v_vec) GROUP BY ALL)) GROUP BY 1"""
SIMS = "SELECT vec_id, code, round(list_inner_product(vector, c), 9) AS s, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_inner_product(vector, c), 9) DESC, code) AS r FROM v_vec, centres"


@query("f3_classify_semantic", sql("""SELECT vec_id, CAST(code AS VARCHAR) AS code FROM (SELECT *, max(s) OVER (PARTITION BY vec_id) AS m FROM sims WHERE s >= 0.2) WHERE r = 1 OR (r = 2 AND s >= 0.85 * m)
    UNION ALL SELECT vec_id, 'UNCLASSIFIED' FROM sims WHERE r = 1 AND s < 0.2""", "v_vec", centres=CENTRES, sims=SIMS))
def f3(spark, d):
    codes = op.classify_semantic(F.col("vector"), category_vectors(spark, d), threshold=0.2)
    return t.v_vec(spark, d).select("vec_id", F.explode(codes).alias("code"))


@query("f4_classify_argmax", sql("SELECT vec_id, CASE WHEN s >= 0.15 THEN CAST(code AS VARCHAR) ELSE '99' END AS code FROM sims WHERE r = 1", "v_vec", centres=CENTRES, sims=SIMS))
def f4(spark, d):
    return t.v_vec(spark, d).select("vec_id", op.classify_argmax(F.col("vector"), category_vectors(spark, d)).alias("code"))


def _rule_sql(text):
    cases = " ".join("WHEN " + " OR ".join(f"contains({text}, '{k}')" for k in ks) + f" THEN '{c}'" for c, ks in op.RULES)
    return f"CASE {cases} ELSE '99' END"


@query("f5_classify_rules", "SELECT doc_id, " + _rule_sql("lower(source || ' ' || text)") + " AS code FROM documents")
def f5(spark, d):
    return t.v_text(spark, d).select("doc_id", op.classify_rules(F.col("source"), F.col("query")).alias("code"))


WEIGHT = "CASE left(code, 1) WHEN 'T' THEN 1.5 WHEN 'S' THEN 2.0 WHEN 'K' THEN 2.5 WHEN 'L' THEN 3.0 ELSE 1.0 END"
CUT = "CASE left(code, 1) WHEN 'T' THEN 0.03 WHEN 'S' THEN 0.05 WHEN 'K' THEN 0.08 WHEN 'L' THEN 0.10 ELSE 0.05 END"


def weighted(text, view, kw, source):
    return f"""SELECT sample_id, '{source}' AS src, code, ord, s FROM (SELECT sample_id, code, ord, CAST(sum({WEIGHT}) AS DOUBLE) / any_value(w) AS s FROM
        (SELECT sample_id, lower({text}) AS x, {words(text)} AS w FROM {view}) q, {kw} WHERE w > 0 AND contains(x, kw) GROUP BY ALL) WHERE s >= {CUT}"""


def _scores(df, col):
    return df.select("sample_id", F.explode(col).alias("e")).select("sample_id", "e.code", F.round("e.score", 6).alias("score"))


@query("f6_score_keywords_weighted", sql(f"SELECT sample_id, code, round(s, 6) AS score FROM ({weighted('query', 'v_text_sample', 'v_text_kw', 'query')})", "v_text_sample", "v_text_kw"))
def f6(spark, d):
    return _scores(t.v_text_sample(spark, d), op.score_keywords_weighted(F.col("query"), TEXT_CATS))


BOTH = weighted("query", "v_sample", "v_kw", "query") + " UNION ALL " + weighted("array_to_string(pos, ' ')", "v_sample", "v_kw", "labels")
COMBINED = "SELECT sample_id, code, ord, sum(CASE src WHEN 'query' THEN s ELSE 3 * s END) AS t, string_agg(src, '+' ORDER BY src DESC) AS sources FROM b GROUP BY ALL"


def combined(spark, d):
    return t.v_sample(spark, d).select("sample_id", op.combine_scores(F.col("query"), F.array_join("pos", " "), CATS).alias("scores"))


@query("f7_combine_scores", sql("SELECT sample_id, code, round(t, 6) AS score, sources, row_number() OVER (PARTITION BY sample_id ORDER BY t DESC, ord) AS place FROM c", "v_sample", "v_kw", b=BOTH, c=COMBINED))
def f7(spark, d):
    x = combined(spark, d).select("sample_id", F.posexplode("scores").alias("i", "e"))
    return x.select("sample_id", "e.code", F.round("e.score", 6).alias("score"), "e.sources", (F.col("i") + 1).alias("place"))


DIST = """SELECT code, count(*) AS n, list(sample_id ORDER BY sample_id)[1] AS example_1, list(sample_id ORDER BY sample_id)[2] AS example_2, left(code, 1) AS type FROM c GROUP BY code"""


@query("f8_category_distribution", sql("SELECT *, round(n * 100.0 / sum(n) OVER (PARTITION BY type), 6)::DOUBLE AS type_pct FROM dist", "v_sample", "v_kw", b=BOTH, c=COMBINED, dist=DIST))
def f8(spark, d):
    return rounded(op.category_distribution(combined(spark, d)))


@query("f8_classified_share", sql("""SELECT n, k AS classified, n - k AS unclassified, round(k * 100.0 / n, 6)::DOUBLE AS classified_pct FROM
    (SELECT (SELECT count(*) FROM v_text_sample) AS n, count(DISTINCT sample_id) AS k FROM b)""", "v_text_sample", "v_text_kw", b=weighted("query", "v_text_sample", "v_text_kw", "query")))
def f8b(spark, d):
    x = t.v_text_sample(spark, d).select("sample_id", op.score_keywords_weighted(F.col("query"), TEXT_CATS).alias("scores"))
    return rounded(op.classified_share(x))


MORE = CATS + [op.Category(6, "K9"), op.Category(7, "T9")]


@query("f9_underrepresented", sql("""SELECT code, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'none' ELSE 'few' END AS coverage FROM
    (SELECT code, ord FROM v_kw UNION SELECT * FROM (VALUES ('K9', 6), ('T9', 7))) LEFT JOIN dist USING (code) ORDER BY coalesce(n, 0), ord LIMIT 4""", "v_sample", "v_kw", b=BOTH, c=COMBINED, dist=DIST))
def f9(spark, d):
    return op.underrepresented(op.category_distribution(combined(spark, d)), op.taxonomy_table(spark, MORE), 4)


@query("f10_type_balance", sql("""SELECT type, n_type, round(n_type * 100.0 / (SELECT sum(n) FROM dist), 6)::DOUBLE AS pct, (SELECT code FROM dist ORDER BY n DESC, code DESC LIMIT 1) AS most_common,
    type = (SELECT type FROM ty ORDER BY n_type DESC, type DESC LIMIT 1) AS dominant, type = (SELECT type FROM ty ORDER BY n_type, type LIMIT 1) AS weakest FROM ty""", "v_sample", "v_kw", b=BOTH, c=COMBINED, dist=DIST,
    ty="SELECT type, CAST(sum(n) AS BIGINT) AS n_type FROM dist GROUP BY 1"))
def f10(spark, d):
    return rounded(op.type_balance(op.category_distribution(combined(spark, d))))


@query("f11_dominant_category", sql("""SELECT v_sample.sample_id, code FROM v_sample LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, p) AS r FROM
    (SELECT sample_id, string_split(coarse_label, ' ')[2] AS code, count(*) AS n, min(pos_no) AS p FROM v_sample_label WHERE NOT is_neg GROUP BY ALL)) x ON x.sample_id = v_sample.sample_id AND r = 1""", "v_sample", "v_sample_label"))
def f11(spark, d):
    codes = F.transform("pos", lambda l: F.element_at(F.split(l, " "), 2))
    return t.v_sample(spark, d).select("sample_id", op.dominant_category(codes).alias("code"))


W = words("text")
LONG = r"len(regexp_extract_all(text, '[^\s\x0B\x{1c}-\x{1f}\x{85}\p{Z}]{9,}'))"


@query("f12_query_traits", f"""SELECT doc_id, length(text) AS char_length, {W} AS word_count,
    CASE WHEN length(text) < 100 THEN 'Short (50-100 chars)' WHEN length(text) < 200 THEN 'Medium (100-200 chars)' WHEN length(text) < 400 THEN 'Long (200-400 chars)' ELSE 'Very Long (> 400 chars)' END AS length_category,
    CASE WHEN {W} < 10 THEN 'Few Words (5-10)' WHEN {W} < 20 THEN 'Moderate Words (10-20)' WHEN {W} < 40 THEN 'Many Words (20-40)' ELSE 'Very Many Words (> 40)' END AS word_category,
    CASE WHEN {LONG} / greatest({W}, 1) < 0.1 THEN 'Simple' WHEN {LONG} / greatest({W}, 1) < 0.3 THEN 'Moderate' ELSE 'Complex' END AS complexity_level,
    regexp_matches(text, '[.!?;:]') AS has_punctuation, regexp_matches(text, '\\p{{Nd}}') AS has_numbers,
    regexp_matches(text, '[^\\p{{L}}\\p{{N}}_\\s\\x0B\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}.!?;:,\\-]') AS has_special_chars, round({LONG} / greatest({W}, 1), 6) AS complexity_ratio FROM documents""")
def f12(spark, d):
    return rounded(t.v_text(spark, d).select("doc_id", *[c.alias(n) for n, c in tx.query_traits(F.col("query")).items()]))


@query("f13_positive_count_bucket", sql("""SELECT sample_id, CASE WHEN len(pos) = 1 THEN 'Single (1)' WHEN len(pos) <= 3 THEN 'Few (2-3)' WHEN len(pos) <= 5 THEN 'Several (4-5)' ELSE 'Many (6-10)' END AS bucket
    FROM v_sample""", "v_sample"))
def f13(spark, d):
    return t.v_sample(spark, d).select("sample_id", tx.positive_count_bucket(F.size("pos")).alias("bucket"))


@query("f14_length_bucket", f"""SELECT doc_id, CASE WHEN {W} <= a THEN 'short' WHEN {W} <= b THEN 'medium' ELSE 'long' END AS bucket
    FROM documents, (SELECT quantile_cont({W}, 0.25) AS a, quantile_cont({W}, 0.75) AS b FROM documents)""")
def f14(spark, d):
    return op.length_bucket(t.v_text(spark, d)).select("doc_id", "bucket")


def _any_sql(text, terms):
    return "(" + " OR ".join(f"contains({text}, '{k}')" for k in terms) + ")"


@query("f15_domain_flags", "SELECT doc_id, " + ", ".join(f"{_any_sql('lower(source || chr(32) || text)', k)} AS {n}" for n, k in
       (("is_circus", op.CIRCUS), ("is_religious", op.RELIGION), ("is_military", op.MILITARY))) + " FROM documents")
def f15(spark, d):
    return t.v_text(spark, d).select("doc_id", *[c.alias(n) for n, c in op.domain_flags(F.col("source"), F.col("query")).items()])
