"""Samples for labels that have none: requests with companions and negatives, answers, acceptance, records."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import generation
from ..session import cut_lineage


def new_label_samples(targets: DataFrame, skills: DataFrame, per_label: int = 3, companions: DataFrame | None = None, negatives: DataFrame | None = None,
                      backend=None, max_chars: int = 400, log_path: str | None = None, **kw) -> tuple[DataFrame, DataFrame]:
    """(records: label, sample_no, query, pos, neg, source, scenario; refused: target, sample_no, reject_reason).

    ``targets``: label; ``skills``: label, description, occupations; ``companions`` and ``negatives`` as in ``new_label_requests``. One answer per
    request. New labels have no texts yet, so an answer is only held against its own request: blank, too long or with a forbidden term. Answers are checkpointed.
    """
    requests = generation.new_label_requests(targets, skills, per_label, companions, negatives, max_chars=max_chars, **kw)
    if log_path:
        requests = cut_lineage(requests)
        generation.prompt_log(requests, log_path)
    answers = cut_lineage(generation.generate(requests, backend, generation.dry_run_text(F.col("hint"), F.col("sample_no") + 1)).drop("prompt", "description", "occupations"))
    judged = generation.accept(answers.where("status = 'ok'").select("request_id", F.lit(1).alias("cand_no"), "text", F.col("negatives").alias("forbidden")), max_chars)
    x = answers.join(judged.select("request_id", "accepted", "reject_reason"), "request_id", "left")
    records = x.where("accepted is not null").select(
        F.col("target").alias("label"), "sample_no", F.col("accepted").alias("query"), F.col("focus").alias("pos"), F.col("negatives").alias("neg"), "source", "scenario")
    return records, x.where("accepted is null").select("target", "sample_no", F.coalesce("reject_reason", F.lit("no answer")).alias("reject_reason"))
