"""Retrieval evaluation: search, optionally re-rank, judge."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.evaluation import metric_table, per_query_metrics
from ..operators.similarity import rerank, topk_similar


def evaluate_retrieval(queries: DataFrame, corpus: DataFrame, qrels: DataFrame, model: str, k: int = 100, scorer=None) -> DataFrame:
    """(model, metric, value). ``k``: at least the largest cut of the metrics. ``queries``: query_id, query, vector; ``corpus``: corpus_id, title, vector."""
    preds = topk_similar(queries, corpus, k)
    if scorer is not None:
        texts = preds.join(queries.select("query_id", "query"), "query_id").join(corpus.select("corpus_id", "title"), "corpus_id")
        preds = rerank(texts.drop("rank"), scorer)
    return metric_table(per_query_metrics(preds, qrels, queries), model)
