"""Long queries: keep, split by label groups, or compress; one answer of the backend for each new text."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import chunk_sequential, or_empty
from ..functions.prompts import cluster_prompt, compress_prompt, group_prompt
from ..functions.text import route, strip, token_count
from ..operators import generation
from ..operators.similarity import chunk_by_similarity
from ..session import cut_lineage


def label_groups(samples: DataFrame, n: int, pool: DataFrame | None = None, threshold: float = 0.88, cluster_backend=None) -> tuple[DataFrame, str]:
    """(samples + groups, strategy). Groups come from the backend's answers (null where one is unusable), else from label vectors
    (``pool``: label, vector), else they are consecutive."""
    if cluster_backend is not None:
        asked = samples.select("sample_id", "pos", cluster_prompt(F.col("pos"), n).alias("prompt"))
        answers = cut_lineage(generation.generate(asked, cluster_backend).select("sample_id", F.col("text").alias("_answer")))
        return samples.join(answers, "sample_id").withColumn("groups", generation.reconcile_groups(F.col("pos"), F.col("_answer"), n)).drop("_answer"), "llm_label_group"
    if pool is not None:
        return samples.join(chunk_by_similarity(samples, pool, n, threshold).withColumnRenamed("chunks", "groups"), "sample_id", "left"), "label_group"
    return samples.withColumn("groups", chunk_sequential(F.col("pos"), n)), "label_group"


def compress_or_split(samples: DataFrame, limit: int = 320, n: int = 5, pool: DataFrame | None = None, threshold: float = 0.88,
                      cluster_backend=None, backend=None, tokenizer=None) -> tuple[DataFrame, DataFrame]:
    """(new samples, failed requests). ``samples``: sample_id (unique), query, pos, neg.

    Queries up to ``limit`` tokens stay. Many labels: one text for each group of at most ``n``, with the labels of the other groups as negatives. The
    others, and those whose groups cannot be used, are compressed. Every text is one request; an empty or failed answer is a row of the second
    result with its error, and costs no other text. Without ``backend`` it is a dry run. Answers are checkpointed, so none is asked for twice.
    """
    text = samples.select("sample_id", F.coalesce("query", F.lit("")).alias("query"), or_empty(F.col("pos")).alias("pos"), or_empty(F.col("neg")).alias("neg"))
    x = text.withColumn("original_tokens", token_count(F.col("query"), tokenizer))
    x = x.withColumn("_route", route(F.col("original_tokens"), F.size("pos"), limit, always_split_over=n))
    none = F.lit(None).cast("long")

    def shaped(df: DataFrame, strategy: Column, *index: Column) -> DataFrame:
        names = ("group_index", "group_size", "total_groups")
        return df.select("sample_id", "query", "pos", "neg", *[c for c in ["avoid"] if c in df.columns], strategy.alias("strategy"),
                         *[c.alias(k) for c, k in zip(index or (none,) * 3, names)], "original_tokens")

    kept = shaped(x.where("_route = 'keep'"), F.lit("keep")).withColumn("tokens", F.col("original_tokens"))
    grouped, name = label_groups(x.where("_route = 'split'"), n, pool, threshold, cluster_backend)
    usable = F.size(or_empty(F.flatten("groups"))) > 0
    parts = generation.split_by_group(grouped.where(usable), strategy=name, keep=("sample_id", "original_tokens"))
    whole = x.where("_route = 'compress'").drop("_route").unionByName(grouped.where(~usable).select("sample_id", "query", "pos", "neg", "original_tokens"))
    split_requests = shaped(parts, F.col("augmentation"), *[F.col(k) for k in ("group_index", "group_size", "total_groups")]).withColumn(
        "dry", generation.dry_run_compress(F.col("pos"), "split"))
    split_requests = split_requests.withColumn("prompt", group_prompt(F.col("query"), F.col("pos"), F.col("avoid"))).drop("avoid")
    compress_requests = shaped(whole, F.lit("compress")).withColumn("dry", generation.dry_run_compress(F.col("pos"))).withColumn("prompt", compress_prompt(F.col("query"), F.col("pos")))
    requests = split_requests.unionByName(compress_requests)
    answers = cut_lineage(generation.generate(requests, backend, F.col("dry")).drop("prompt", "dry"))
    ok = (F.col("status") == "ok") & (F.coalesce(strip(F.col("text")), F.lit("")) != "")
    made = answers.where(ok).withColumn("query", strip(F.col("text"))).withColumn("tokens", token_count(F.col("query"), tokenizer)).drop("text", "status", "error")
    reason = F.concat(F.lit("no answer"), F.coalesce(F.concat(F.lit(": "), "error"), F.lit("")))
    failed = answers.where(~ok).withColumn("error", F.when(F.col("status") == "ok", "empty answer").otherwise(reason)).drop("text", "status")
    return kept.unionByName(made), failed
