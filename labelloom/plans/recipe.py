"""Data preparation in its documented order: cap, compress or split, fill rare labels, enrich, split off an evaluation set."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import route, token_count
from ..operators import balance, classify, generation
from ..operators.relations import enrich_labels


def routed(samples: DataFrame, limit: int = 320, tokenizer=None) -> DataFrame:
    """Samples with token count and the decision to keep, split or compress."""
    x = samples.withColumn("tokens", token_count(F.col("query"), tokenizer))
    return x.withColumn("route", route(F.col("tokens"), F.size("pos"), limit))


def evaluation_split(samples: DataFrame, cats: list[classify.Category], ratio: float = 0.1, seed: int = 42):
    """(evaluation, train): classify, stratify by length, pick per category."""
    x = classify.length_bucket(samples)
    codes = classify.classify_keywords(F.col("query"), F.col("pos"), cats)
    rows = x.select("sample_id", F.explode(codes).alias("category"), "bucket")
    return balance.split_train(samples, balance.representative_split(rows, ratio=ratio, seed=seed))


def rare_labels(samples: DataFrame, skills: DataFrame, minimum: int = 5, backend=None, **kw) -> tuple[DataFrame, DataFrame]:
    """(generated and enriched samples, labels still below the minimum)."""
    filled = generation.fill_deficits(samples, skills, minimum, backend, **kw)
    generated = filled.samples.withColumn("sample_id", F.md5(F.concat_ws("|", "label", "query")))
    return enrich_labels(generated, skills), filled.leftover
