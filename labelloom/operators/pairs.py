"""Training pairs and in-training evaluation sets."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import or_empty
from ..functions.hashing import hash_order
from ..functions.text import strip, with_prefix


def training_pairs(samples: DataFrame, n_neg: int = 3, prefixes: bool = True, seed: int = 42) -> DataFrame:
    """(sample_id, pos_no, anchor, positive, negatives): one row per positive.

    The drawn negatives are shared by all positives of a sample. Draw and expansion stay inside the row: no shuffle.
    """
    drawn = F.slice(F.array_sort(F.transform(or_empty(F.col("neg")), lambda x, i: F.struct(
        hash_order(seed, F.col("sample_id"), x).alias("k"), i.alias("i"), x.alias("l")))), 1, n_neg)
    negatives = F.filter(F.transform(drawn, lambda t: strip(t.l)), lambda x: x != "")
    negatives = F.transform(negatives, lambda x: with_prefix(x, "passage", prefixes))
    x = samples.select("sample_id", strip(F.col("query")).alias("q"), "pos", negatives.alias("negatives"))
    x = x.select("sample_id", "q", F.posexplode("pos").alias("pos_no", "p"), "negatives")
    x = x.withColumn("p", strip(F.col("p"))).where("q <> '' and p <> ''")
    return x.select("sample_id", "pos_no", with_prefix(F.col("q"), "query", prefixes).alias("anchor"),
                    with_prefix(F.col("p"), "passage", prefixes).alias("positive"), "negatives")


def ir_dataset(samples: DataFrame, prefixes: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, corpus, qrels): ids are ``q_<sample id>`` and a hash of the label text, not positions."""
    x = samples.where((strip(F.col("query")) != "") & (F.size(or_empty(F.col("pos"))) > 0))
    qid = F.concat(F.lit("q_"), F.col("sample_id").cast("string"))
    queries = x.select(qid.alias("query_id"), with_prefix(strip(F.col("query")), "query", prefixes).alias("text"))
    labels = (x.select(F.explode(F.concat(or_empty(F.col("pos")), or_empty(F.col("neg")))).alias("l"))
              .select(strip(F.col("l")).alias("l")).where("l <> ''").distinct())
    corpus = labels.select(F.md5("l").alias("corpus_id"), with_prefix(F.col("l"), "passage", prefixes).alias("text"))
    qrels = (x.select(qid.alias("query_id"), F.explode("pos").alias("l")).select("query_id", strip(F.col("l")).alias("l"))
             .where("l <> ''").select("query_id", F.md5("l").alias("corpus_id")).distinct())
    return queries, corpus, qrels
