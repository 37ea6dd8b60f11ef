"""A: sources and sinks, over files that Spark writes from the tables."""
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import readers, tables as t, writers
from ..functions.payloads import parse_occupations
from .base import joined, query, rounded
from .views import sql

FLAT = "SELECT query, array_to_string(pos,'|') AS pos, array_to_string(neg,'|') AS neg FROM v_sample"


def _flat(df):
    return df.select("query", joined("pos"), joined("neg"))


@query("a1_read_samples", sql(FLAT, "v_sample"))
def a1(spark, d):
    path = scratch_dir(spark)
    t.v_sample(spark, d).select("query", "pos", "neg").write.json(path)
    return _flat(readers.read_samples(spark, path).rows)


@query("a2_read_jsonl", sql(FLAT + " WHERE split_part(query, ' ', -2) <> 'P'", "v_sample"))
def a2(spark, d):
    """Lines of partly shipped orders are cut off in the middle and followed by a blank line."""
    path = scratch_dir(spark)
    s = t.v_sample(spark, d).select(F.to_json(F.struct("query", "pos", "neg")).alias("j"), "query")
    broken = F.element_at(F.split("query", " "), -2) == "P"
    s.select(F.when(broken, F.concat(F.expr("substring(j, 1, 20)"), F.lit("\n   "))).otherwise(F.col("j"))).write.text(path)
    return _flat(readers.read_jsonl(spark, path).rows)


CASES = """CASE split_part(query,' ',-2) WHEN 'P' THEN 'pos is not a list of strings'
    ELSE CASE left(query,1) WHEN '1' THEN 'query is not a string' WHEN '2' THEN 'neg is not a list of strings'
    WHEN '3' THEN 'meta is not an object' WHEN '4' THEN 'not json' ELSE 'valid' END END"""


def odd_records(spark, d):
    """JSON texts of the samples, broken in a way that depends on status and priority."""
    s = t.v_sample(spark, d)
    status, first = F.element_at(F.split("query", " "), -2), F.substring("query", 1, 1)
    q, p, n = (F.to_json(c) if i else F.concat(F.lit('"'), F.col("query"), F.lit('"')) for i, c in enumerate(("query", "pos", "neg")))
    q = F.when((status != "P") & (first == "1"), "17").otherwise(q)
    p = F.when(status == "P", '"single"').otherwise(p)
    n = F.when((status != "P") & (first == "2"), '[1, "a"]').otherwise(n)
    m = F.when((status != "P") & (first == "3"), "[]").otherwise('{"source": "x", "k": 1}')
    end = F.when((status != "P") & (first == "4"), "").otherwise("}")
    return s.select("sample_id", F.concat(F.lit('{"query": '), q, F.lit(', "pos": '), p, F.lit(', "neg": '), n,
                                          F.lit(', "meta": '), m, end).alias("record"))


@query("a3_validate_samples", sql(f"SELECT {CASES} AS reason, count(*) AS n FROM v_sample GROUP BY 1", "v_sample"))
def a3(spark, d):
    valid, rejected = readers.validate_samples(odd_records(spark, d))
    both = valid.select(F.lit("valid").alias("reason")).unionAll(rejected.select("reject_reason"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("a4_read_directories", sql(FLAT + " WHERE split_part(query, ' ', -2) <> 'P'", "v_sample"))
def a4(spark, d):
    root = scratch_dir(spark)
    s = t.v_sample(spark, d).select("query", "pos", "neg", F.element_at(F.split("query", " "), -2).alias("status"))
    s.write.partitionBy("status").json(root)
    return _flat(readers.read_directories(spark, [f"{root}/status=F", f"{root}/status=O"]).rows)


def skill_rows(spark, d):
    cell = F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit('[{"title": " '), F.col("p_brand"), F.lit(' "}, {"x": 1}]')))
    cell = cell.when(F.col("p_type") == "SMALL", F.concat(F.lit('["'), F.col("p_brand"), F.lit('", " ", "b"]')))
    cell = cell.when(F.col("p_type") == "LARGE", F.concat(F.col("p_brand"), F.lit(" | z ||"))).when(F.col("p_type") == "PROMO", '{"title": "no"}')
    return t.table(spark, d, "part").select(
        F.col("p_partkey").alias("row_no"), F.when(F.col("p_type") != "PROMO", F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("preferredLabel"),
        F.when(F.col("p_size") > 3, F.col("p_name")).alias("title"), F.when(F.col("p_size") > 9, F.concat("p_type", F.lit(" "))).otherwise(" ").alias("description"),
        cell.alias("isEssentialForOccupations"), F.lit('["b", "c"]').alias("isOptionalForOccupations"), F.col("p_brand").alias("skillType"))


CELL = """CASE p_type WHEN 'ECONOMY' THEN [p_brand] WHEN 'SMALL' THEN [p_brand, 'b'] WHEN 'LARGE' THEN [p_brand, 'z'] ELSE CAST([] AS VARCHAR[]) END"""


@query("a5_read_skills_csv", f"""WITH r AS (SELECT p_partkey AS row_no, coalesce(CASE WHEN p_type <> 'PROMO' THEN p_name END, CASE WHEN p_size > 3 THEN p_name END) AS label,
    CASE WHEN p_size > 9 THEN p_type END AS description, {CELL} AS c, p_brand AS skill_type FROM part),
    last AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_no DESC) AS k FROM r WHERE label IS NOT NULL)
    SELECT label, description, array_to_string(list_concat(c, list_filter(['b','c'], lambda x: NOT list_contains(c, x))), '|') AS occupations, skill_type FROM last WHERE k = 1""")
def a5(spark, d):
    return readers.label_documents(skill_rows(spark, d)).select("label", "description", joined("occupations"), "skill_type")


@query("a6_parse_occupations", f"SELECT p_partkey, array_to_string({CELL}, '|') AS occupations FROM part")
def a6(spark, d):
    return skill_rows(spark, d).select(F.col("row_no").alias("p_partkey"), joined(parse_occupations(F.col("isEssentialForOccupations")), "occupations"))


@query("a7_competence_corpus", """SELECT p_brand AS title, p_brand || ',/nKompetenzanforderungen: ' || nullif(p_type,'PROMO') AS page_content FROM part""")
def a7(spark, d):
    p = t.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("Kompetenzfacette"), F.expr("nullif(p_type,'PROMO')").alias("Kompetenzanforderungen"))
    return readers.competence_corpus(p)


@query("a8_skill_corpus", sql("SELECT label AS title, label || ': ' || coalesce(nullif(description,'PROMO'),'') AS page_content FROM v_skill", "v_skill"))
def a8(spark, d):
    s = t.v_skill(spark, d).select(F.col("label").alias("preferredLabel"), F.expr("nullif(description,'PROMO')").alias("description"))
    return readers.skill_corpus(s).select("title", "page_content")


@query("a9_read_target_labels", sql("""SELECT i.label, p.label IS NOT NULL AS known, count(*) AS n FROM v_item i LEFT JOIN v_skill_partial p ON i.label = p.label GROUP BY ALL""", "v_item", "v_skill_partial"))
def a9(spark, d):
    items = t.v_item(spark, d).withColumn("brand", F.element_at(F.split("label", " "), -1))
    lists = items.groupBy("brand").agg(F.collect_list("label").alias("l"))
    files = lists.select(F.when(F.col("brand") > "Brand#2", F.to_json(F.struct(F.col("l").alias("skills")))).otherwise(F.to_json("l")).alias("value"))
    wanted, known = readers.target_labels(files), t.v_skill_partial(spark, d).select("label")
    found = wanted.join(known, "label", "left_semi").withColumn("known", F.lit(True))
    missing = wanted.join(known, "label", "left_anti").withColumn("known", F.lit(False))
    return found.unionAll(missing).groupBy("label", "known").agg(F.count(F.lit(1)).alias("n"))


META_SQL = """SELECT query, array_to_string(pos,'|') AS pos, array_to_string(neg,'|') AS neg, 'grün' AS source, CAST(len(neg) AS BIGINT) AS total_negatives FROM v_sample"""


def with_meta(df):
    from .. import schemas as S
    from pyspark.sql import types as T
    values = {"source": F.lit("grün"), "total_negatives": F.size("neg").cast("long")}
    fields = [values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in S.META_FIELDS]
    return df.withColumn("meta", F.struct(*fields, F.lit(None).cast(T.MapType(T.StringType(), T.StringType())).alias("extra")))


@query("a10_write_samples", sql(META_SQL, "v_sample"))
def a10(spark, d):
    path = scratch_dir(spark)
    writers.write_samples(with_meta(t.v_sample(spark, d)), path)
    back = readers.read_samples(spark, path, fmt="jsonl").rows
    return back.select("query", joined("pos"), joined("neg"), "meta.source", "meta.total_negatives")


@query("a11_convert_to_jsonl", sql(FLAT, "v_sample"))
def a11(spark, d):
    source, target = scratch_dir(spark), scratch_dir(spark)
    t.v_sample(spark, d).select("query", "pos", "neg").write.json(source)
    writers.convert_to_jsonl(spark, source, target)
    return _flat(readers.read_jsonl(spark, target).rows)


@query("a12_write_split", sql("""SELECT CASE WHEN left(query,1) = '1' THEN 'eval' ELSE 'train' END AS split, count(*) AS n, CAST(sum(len(pos)) AS BIGINT) AS n_pos FROM v_sample GROUP BY 1""", "v_sample"))
def a12(spark, d):
    s = t.v_sample(spark, d)
    urgent = F.col("query").startswith("1")
    stats = s.groupBy(urgent.alias("urgent")).agg(F.count(F.lit(1)).alias("n"))
    paths = writers.write_split(s.where(urgent), s.where(~urgent), stats, scratch_dir(spark))
    parts = [readers.read_jsonl(spark, paths[k]).rows.select(F.lit(k).alias("split"), "pos") for k in ("eval", "train")]
    return parts[0].unionAll(parts[1]).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("pos")).alias("n_pos"))


@query("a13_upsert_results", """WITH m AS (SELECT l_returnflag AS model, 'avg_quantity' AS metric, avg(l_quantity) AS value FROM lineitem GROUP BY 1),
    n AS (SELECT l_returnflag AS model, 'avg_tax' AS metric, avg(l_tax) AS value FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
    SELECT model, metric, round(value, 6) AS value FROM (SELECT * FROM n UNION ALL SELECT * FROM m WHERE model NOT IN (SELECT model FROM n))""")
def a13(spark, d):
    l = t.table(spark, d, "lineitem")
    store = l.groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("l_quantity").alias("value")).withColumn("metric", F.lit("avg_quantity"))
    new = l.where("l_returnflag <> 'N'").groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("l_tax").alias("value")).withColumn("metric", F.lit("avg_tax"))
    return rounded(writers.upsert_results(store, new))


# --- the same through files ---------------------------------------------------------------------

@query("a1_read_samples_array", sql(FLAT, "v_sample"))
def a1_array(spark, d):
    """Top-level arrays, read by byte ranges."""
    path = scratch_dir(spark)
    writers.write_samples(t.v_sample(spark, d), path, fmt="array")
    return _flat(readers.read_samples(spark, path).rows)


@query("a5_read_skills_csv_file", f"""WITH r AS (SELECT p_partkey AS row_no, coalesce(CASE WHEN p_type <> 'PROMO' THEN p_name END, CASE WHEN p_size > 3 THEN p_name END) AS label,
    CASE WHEN p_size > 9 THEN p_type || chr(10) || chr(10) || '"' || p_brand || '", ' || p_size END AS description, {CELL} AS c, p_brand AS skill_type FROM part),
    last AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY row_no DESC) AS k FROM r WHERE label IS NOT NULL)
    SELECT label, description, array_to_string(list_concat(c, list_filter(['b','c'], lambda x: NOT list_contains(c, x))), '|') AS occupations, skill_type FROM last WHERE k = 1""")
def a5_file(spark, d):
    """A CSV in part order with quotes and line breaks inside its cells; the last row of a label wins."""
    path = scratch_dir(spark)
    text = F.concat("p_type", F.lit('\n\n"'), "p_brand", F.lit('", '), F.col("p_size").cast("string"))
    part = t.table(spark, d, "part").select(F.col("p_partkey").alias("row_no"), F.when(F.col("p_size") > 9, text).alias("text"))
    rows = skill_rows(spark, d).join(part, "row_no").orderBy("row_no").drop("row_no", "description").withColumnRenamed("text", "description")
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_skills_csv(spark, path).select("label", "description", joined("occupations"), "skill_type")


@query("a7_read_competence_csv", """SELECT p_brand AS title, p_brand || ',/nKompetenzanforderungen: ' || nullif(p_type,'PROMO') || ';' || chr(10) || p_size AS page_content FROM part""")
def a7_file(spark, d):
    path = scratch_dir(spark)
    need = F.concat(F.expr("nullif(p_type,'PROMO')"), F.lit(";\n"), F.col("p_size").cast("string"))
    t.table(spark, d, "part").select(F.col("p_brand").alias("Kompetenzfacette"), need.alias("Kompetenzanforderungen")).write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    return readers.read_competence_csv(spark, path)


@query("a9_read_target_labels_file", sql("""SELECT i.label, p.label IS NOT NULL AS known, count(*) AS n FROM v_item i LEFT JOIN v_skill_partial p ON i.label = p.label GROUP BY ALL""", "v_item", "v_skill_partial"))
def a9_file(spark, d):
    """Files with a list or an object of labels, one for each brand."""
    path = scratch_dir(spark)
    items = t.v_item(spark, d).withColumn("brand", F.element_at(F.split("label", " "), -1))
    lists = items.groupBy("brand").agg(F.collect_list("label").alias("l"))
    lists.select("brand", F.when(F.col("brand") > "Brand#2", F.to_json(F.struct(F.col("l").alias("skills")))).otherwise(F.to_json("l")).alias("value")).write.partitionBy("brand").text(path)
    known, missing = readers.read_target_labels(spark, path, t.v_skill_partial(spark, d))
    both = known.withColumn("known", F.lit(True)).unionAll(missing.withColumn("known", F.lit(False)))
    return both.groupBy("label", "known").agg(F.count(F.lit(1)).alias("n"))


@query("a12_write_split_stats", sql("""SELECT left(query,1) = '1' AS urgent, count(*) AS n FROM v_sample GROUP BY 1""", "v_sample"))
def a12_stats(spark, d):
    s = t.v_sample(spark, d)
    urgent = F.col("query").startswith("1")
    paths = writers.write_split(s.where(urgent), s.where(~urgent), s.groupBy(urgent.alias("urgent")).agg(F.count(F.lit(1)).alias("n")), scratch_dir(spark))
    return spark.read.schema("urgent boolean, n long").json(paths["stats"])


@query("a13_write_results", """WITH m AS (SELECT l_returnflag AS model, 'avg_quantity' AS metric, avg(l_quantity) AS value FROM lineitem GROUP BY 1),
    n AS (SELECT l_returnflag AS model, 'avg_tax' AS metric, avg(l_tax) AS value FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
    SELECT 1 AS version, model, metric, round(value, 6) AS value FROM m UNION ALL SELECT 2, model, metric, round(value, 6) FROM (SELECT * FROM n UNION ALL SELECT * FROM m WHERE model NOT IN (SELECT model FROM n))""")
def a13_versions(spark, d):
    """Two stored versions, read back."""
    l, root = t.table(spark, d, "lineitem"), scratch_dir(spark)
    first = l.groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("l_quantity").alias("value")).select("model", F.lit("avg_quantity").alias("metric"), "value")
    second = l.where("l_returnflag <> 'N'").groupBy(F.col("l_returnflag").alias("model")).agg(F.avg("l_tax").alias("value")).select("model", F.lit("avg_tax").alias("metric"), "value")
    paths = [writers.write_results(spark, root, rows, version) for version, rows in ((1, first), (2, second))]
    parts = [spark.read.parquet(path).select(F.lit(i).cast("long").alias("version"), "model", "metric", "value") for i, path in enumerate(paths, 1)]
    return rounded(parts[0].unionByName(parts[1]))
