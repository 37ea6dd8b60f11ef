"""Views over the given tables: samples, label documents, texts and vectors (see FIXTURES.md)."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def v_item(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("label"),
        F.col("p_name").alias("coarse_label"), "p_type", "p_size")


def v_sample_label(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return (lines.join(v_item(spark, d), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("sample_id"), "label", "coarse_label",
                    F.row_number().over(w).cast("long").alias("pos_no"),
                    (F.col("l_returnflag") == "R").alias("is_neg")))


def v_sample(spark, d):
    def pick(a, negative):
        keep = (lambda x: x.is_neg) if negative else (lambda x: ~x.is_neg)
        return F.transform(F.filter(a, keep), lambda x: x.label)

    grouped = v_sample_label(spark, d).groupBy("sample_id").agg(
        F.array_sort(F.collect_list(F.struct("pos_no", "label", "is_neg"))).alias("a"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return (grouped.join(orders, F.col("sample_id") == F.col("o_orderkey"))
            .select("sample_id", F.col("sample_id").alias("row_no"),
                    F.concat_ws(" ", "o_orderpriority", "o_orderstatus", "o_orderkey").alias("query"),
                    pick(F.col("a"), False).alias("pos"), pick(F.col("a"), True).alias("neg")))


def v_skill(spark, d):
    return v_item(spark, d).groupBy("label").agg(
        F.max_by("p_type", "p_partkey").alias("description"), F.max("p_partkey").alias("row_no"),
        F.max_by("p_size", "p_partkey").alias("size"))


def v_skill_occ(spark, d):
    lines = table(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    return (lines.join(v_item(spark, d), F.col("l_partkey") == F.col("p_partkey"))
            .select("label", F.col("l_suppkey").alias("occupation")).distinct())


def v_skill_partial(spark, d):
    """Label documents of large parts only, so that some labels are not found."""
    return v_skill(spark, d).where("size > 12")


def v_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("text").alias("query"), "lang", "source", "n_chars")


def v_text_sample(spark, d):
    return v_text(spark, d).select(
        F.col("doc_id").alias("sample_id"), F.col("doc_id").alias("row_no"), "query",
        F.array("source").alias("pos"), F.array("lang").alias("neg"))


def v_real(spark, d):
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return v_text(spark, d).join(good, "doc_id").select("query").distinct()


def v_vec(spark, d):
    return table(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "vec_id", F.col("embedding").alias("vector"), "label")


def v_response(spark, d):
    return table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", "text")


# --- fixed values: keyword taxonomies over the words that occur in the given tables ---------------
KEYWORDS = [  # (ord, code, keywords) for the labels of v_sample
    (1, "S1", ["ring", "gear"]), (2, "S2", ["bolt", "rod"]), (3, "K1", ["plate", "anvil"]),
    (4, "T1", ["widget", "gizmo"]), (5, "L1", ["red", "blue"])]
TEXT_KEYWORDS = [  # the same for v_text
    (1, "T2", ["that", "was"]), (2, "S3", ["des", "les"]), (3, "K2", ["der", "die", "und"]),
    (4, "L2", ["los", "del", "que"])]
# --------------------------------------------------------------------------------------------------


def v_doc(spark, d):
    """Label documents with a description that lists the kinds of parts of the label, and suppliers as occupations."""
    parts = v_item(spark, d).groupBy("label").agg(F.array_join(F.array_sort(F.collect_set(
        F.concat("p_type", F.lit(" part of size "), F.col("p_size").cast("string")))), ", ").alias("description"))
    occ = v_skill_occ(spark, d).groupBy("label").agg(
        F.array_sort(F.collect_list(F.col("occupation").cast("string"))).alias("occupations"))
    return parts.join(occ, "label", "left").select(
        "label", "description", F.coalesce("occupations", F.expr("cast(array() as array<string>)")).alias("occupations"))
