"""Retrieval evaluation: metrics of ranked predictions, best-rank metrics, breakdowns, model comparison."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

# --- fixed values -----------------------------------------------------------------------------
CUTS = (1, 3, 5, 10)
METRICS = ([f"accuracy@{k}" for k in CUTS] + [f"precision@{k}" for k in CUTS] + [f"recall@{k}" for k in CUTS]
           + ["ndcg@10", "mrr@10", "map@100", "avg_time_per_query"])
COMPUTING = ("S5", "06")
# ----------------------------------------------------------------------------------------------


def evaluable_queries(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    return queries.join(qrels.select("query_id").distinct(), "query_id", "left_semi")


def per_query_metrics(preds: DataFrame, qrels: DataFrame, queries: DataFrame | None = None, cuts=CUTS,
                      ndcg_k: int = 10, mrr_k: int = 10, map_k: int = 100) -> DataFrame:
    """One row per evaluable query; queries without predictions get zeros.

    ``preds``: query_id, corpus_id, rank. Only hits are aggregated; the running hit number is a window over
    the few hits of one query.
    """
    top = max(*cuts, ndcg_k, mrr_k, map_k)
    rel = qrels.select("query_id", "corpus_id").distinct()
    n_rel = rel.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))
    if queries is not None:
        n_rel = n_rel.join(queries.select("query_id").distinct(), "query_id", "left_semi")
    hits = preds.where(F.col("rank") <= top).select("query_id", "corpus_id", "rank").join(rel, ["query_id", "corpus_id"])
    return metrics_of_hits(hits.select("query_id", "rank"), n_rel, cuts, ndcg_k, mrr_k, map_k)


def metrics_of_hits(hits: DataFrame, n_rel: DataFrame, cuts=CUTS, ndcg_k: int = 10, mrr_k: int = 10, map_k: int = 100) -> DataFrame:
    """The same from (query_id, rank) of the relevant predictions and (query_id, n_rel): no table of relevant pairs is needed where relevance is a rule."""
    w = Window.partitionBy("query_id").orderBy("rank")
    hits = hits.withColumn("hit_no", F.row_number().over(w))
    aggs = [F.count_if(F.col("rank") <= k).alias(f"h{k}") for k in cuts]
    aggs += [F.min("rank").alias("first"),
             F.sum(F.when(F.col("rank") <= ndcg_k, 1 / F.log2(F.col("rank") + 1))).alias("dcg"),
             F.sum(F.when(F.col("rank") <= map_k, F.col("hit_no") / F.col("rank"))).alias("ap")]
    x = n_rel.join(hits.groupBy("query_id").agg(*aggs), "query_id", "left")
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n_rel"), F.lit(ndcg_k)).cast("int")), F.lit(0.0),
                        lambda s, i: s + 1 / F.log2(i + 1))
    zero = F.lit(0.0)
    cols = {}
    for k in cuts:
        h = F.coalesce(F.col(f"h{k}"), F.lit(0))
        cols[f"accuracy@{k}"] = (h > 0).cast("double")
        cols[f"precision@{k}"] = h / F.lit(k)
        cols[f"recall@{k}"] = h / F.col("n_rel")
    cols[f"ndcg@{ndcg_k}"] = F.coalesce(F.col("dcg") / ideal, zero)
    cols[f"mrr@{mrr_k}"] = F.when(F.col("first") <= mrr_k, 1 / F.col("first")).otherwise(zero)
    cols[f"map@{map_k}"] = F.coalesce(F.col("ap") / F.least(F.col("n_rel"), F.lit(map_k)), zero)
    return x.select("query_id", *[c.alias(n) for n, c in cols.items()])


def metric_table(per_query: DataFrame, model: str, total_time: float | None = None, chars: int | None = None) -> DataFrame:
    """(model, metric, value): mean of each per-query metric, plus timings where measured."""
    names = [c for c in per_query.columns if c != "query_id"]
    a = per_query.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.avg(F.col(f"`{n}`")), F.lit(0.0)).alias(n) for n in names])
    rows = [F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").alias("value")) for n in names]
    if total_time is not None:
        rows.append(F.struct(F.lit("total_time").alias("metric"), F.lit(float(total_time)).alias("value")))
        rows.append(F.struct(F.lit("avg_time_per_query").alias("metric"), (F.lit(float(total_time)) / F.col("n")).alias("value")))
        if chars:
            rows.append(F.struct(F.lit("avg_time_per_1000_chars").alias("metric"), F.lit(total_time / chars * 1000).alias("value")))
    return a.select(F.lit(model).alias("model"), F.inline(F.array(*rows)))


def evaluate(preds: DataFrame, qrels: DataFrame, model: str, **kw) -> DataFrame:
    return metric_table(per_query_metrics(preds, qrels, **kw), model)


# --- best rank ------------------------------------------------------------------------------------

def rank_aggregates(rank: Column) -> list[Column]:
    """count, MRR, hits, simplified NDCG and the distribution of the best rank; a rank of 0 or less is a miss."""
    def at(k):
        return (rank > 0) & (rank <= k)
    out = [F.count(F.lit(1)).alias("count"), F.avg(F.when(rank > 0, 1 / rank).otherwise(0.0)).alias("mrr")]
    out += [F.avg(F.when(at(k), 1.0).otherwise(0.0)).alias(f"recall_at_{k}") for k in (1, 5, 10, 20)]
    out += [F.avg(F.when(at(k), 1 / F.log2(rank + 1)).otherwise(0.0)).alias(f"ndcg_at_{k}") for k in (5, 10)]
    out += [F.avg(rank).alias("average_rank"), F.percentile(rank, F.lit(0.5)).alias("median_rank"), F.stddev_pop(rank).alias("std_rank"),
            F.min(rank).alias("min_rank"), F.max(rank).alias("max_rank"),
            F.percentile(rank, F.lit(0.25)).alias("percentile_25"), F.percentile(rank, F.lit(0.75)).alias("percentile_75")]
    return out


def best_rank_metrics(ranks: DataFrame, rank: str = "best_rank") -> DataFrame:
    return ranks.agg(*rank_aggregates(F.col(rank)))


def breakdowns(ranks: DataFrame, dimensions: list[str], rank: str = "best_rank") -> DataFrame:
    """(dimension, bucket, metrics...): all groupings in one pass over the ranks."""
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("bucket")) for d in dimensions])
    x = ranks.select(F.col(rank).alias("_r"), F.explode(cells).alias("c"))
    return x.groupBy("c.dimension", "c.bucket").agg(*rank_aggregates(F.col("_r")))


def insights(b: DataFrame) -> DataFrame:
    """(topic, finding): best and worst bucket per dimension, and the comparisons between groups of buckets.

    ``b``: dimension, bucket, mrr; a few dozen rows.
    """
    m = F.col("mrr")
    mrr_of = (lambda d, cond: F.avg(F.when((F.col("dimension") == d) & cond, m)))
    ends = b.where(F.col("dimension").isin("length_category", "topic")).groupBy("dimension").agg(
        F.max_by("bucket", F.struct(m, F.col("bucket"))).alias("best"), F.min_by("bucket", F.struct(m, F.col("bucket"))).alias("worst"),
        F.count(F.lit(1)).alias("n")).where((F.col("dimension") != "topic") | (F.col("n") > 1))
    best_worst = ends.select(F.col("dimension").alias("topic"), F.explode(F.array(
        F.concat(F.lit("best: "), "best"), F.concat(F.lit("worst: "), "worst"))).alias("finding"))
    bucket = F.col("bucket")
    a = b.agg(
        mrr_of("topic", bucket.isin(*COMPUTING)).alias("it"), mrr_of("topic", F.lit(True)).alias("all"),
        mrr_of("topic", bucket.startswith("T")).alias("t"), mrr_of("topic", bucket.startswith("S")).alias("s"),
        mrr_of("positive_count", bucket == "Single (1)").alias("single"), mrr_of("positive_count", bucket == "Many (6-10)").alias("many"),
        mrr_of("complexity_level", bucket == "Simple").alias("simple"), mrr_of("complexity_level", bucket == "Complex").alias("complex"))

    def line(topic, cond, text):
        return F.when(cond, F.struct(F.lit(topic).alias("topic"), F.lit(text).alias("finding")))

    c = F.col
    rules = F.array(
        line("positive_count", c("single") < c("many"), "more positive labels perform better"),
        line("positive_count", c("single") >= c("many"), "single positive label performs well"),
        line("topic", c("it") > c("all") * 1.2, "computing categories above average"),
        line("topic", c("it") < c("all") * 0.8, "computing categories below average"),
        line("topic", c("t") > c("s") * 1.1, "transversal better than specific"),
        line("topic", c("s") > c("t") * 1.1, "specific better than transversal"),
        line("complexity_level", c("simple") > c("complex") * 1.2, "struggles with complex queries"),
        line("complexity_level", c("complex") > c("simple") * 1.2, "handles complex queries well"))
    return best_worst.unionByName(a.select(F.inline(F.filter(rules, lambda r: r.isNotNull()))))


def evaluation_report(ranks: DataFrame, dimensions: list[str], details: int = 100, key: str = "sample_id") -> dict[str, DataFrame]:
    """overall, breakdowns, first sample details by id, categories found. The ranks are worked out once for all four."""
    ranks = cut_lineage(ranks)
    return {"overall": best_rank_metrics(ranks), "breakdowns": breakdowns(ranks, dimensions),
            "details": ranks.orderBy(key).limit(details), "categories": ranks.select("topic").distinct()}


# --- models ---------------------------------------------------------------------------------------

def compare_models(metrics: DataFrame, names=METRICS) -> DataFrame:
    """One row per model, one column per metric."""
    return metrics.groupBy("model").pivot("metric", list(names)).agg(F.first("value"))


def grade_models(metrics: DataFrame) -> DataFrame:
    """Rank of each model per metric (times: lower is better) and a flag for the best."""
    key = F.when(F.contains("metric", F.lit("time")), F.col("value")).otherwise(-F.col("value"))
    x = metrics.withColumn("grade", F.rank().over(Window.partitionBy("metric").orderBy(key)))
    return x.withColumn("is_best", F.col("grade") == 1)


def restrict_to_corpus(preds: DataFrame, corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, corpus_id, score, rank): predictions with a known title, mapped to the smallest id of the title.

    A query without any such prediction stays as one row of nulls, i.e. a miss.
    """
    ids = corpus.groupBy("title").agg(F.min("corpus_id").alias("corpus_id"))
    known = preds.join(ids, "title").select("query_id", "corpus_id", "score")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return queries.select("query_id").distinct().join(known.withColumn("rank", F.row_number().over(w)), "query_id", "left")
