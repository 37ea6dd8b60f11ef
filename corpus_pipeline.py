"""A training corpus from documents: five stages, each over all that the one before has kept."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm import op3_decontaminate, op7_bpe, op8_simhash, op9_language, op10_pii
from labelloom.llm.queries import table, vocabulary_path
from labelloom.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay."""
    return op9_language.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    return op8_simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages stay."""
    return op3_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data is masked."""
    return op10_pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, with digests of ids and decoded text."""
    return op7_bpe.encode_documents(docs.select("doc_id", "text"), vocabulary_path(), ids="ids").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("encoding", encoding)]
#: Trained trees, hash classes and BPE are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, place = table(spark, sf_dir, "documents"), scratch_dir(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
