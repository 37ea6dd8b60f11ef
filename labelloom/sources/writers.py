"""Sinks: JSON Lines or arrays in many part files, versioned result tables."""
from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas as S
from .readers import read_samples

def sample_objects(df: DataFrame) -> DataFrame:
    """The stored fields of a sample; null fields of meta are not written."""
    columns = [c for c in ("query", "pos", "neg", "meta") if c in df.columns]
    out = df.select(*columns)
    if "meta" in columns:
        known = F.struct(*[F.col("meta")[n].alias(n) for n in S.META_KNOWN], F.col("meta")["extra"].alias("extra"))
        out = out.withColumn("meta", F.when(F.col("meta").isNotNull(), known))
    return out


def write_samples(df: DataFrame, path: str, fmt: str = "jsonl", mode: str = "errorifexists") -> None:
    """JSON Lines or, with ``fmt='array'``, one valid array in each part file; both through the executors."""
    if fmt == "jsonl":
        sample_objects(df).write.mode(mode).option("ignoreNullFields", True).json(path)
        return

    def bracketed(batches):
        lead = "["
        for batch in batches:
            lines = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([("," if i else lead) + line for i, line in enumerate(lines)], pa.string())], names=["value"])
            lead = "," if lines else lead
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"], pa.string())], names=["value"])

    sample_objects(df).select(F.to_json(F.struct("*")).alias("j")).mapInArrow(bracketed, "value string").write.mode(mode).text(path)


def convert_to_jsonl(spark: SparkSession, source, target: str) -> None:
    """Format change only."""
    write_samples(read_samples(spark, source).rows, target)


def write_split(evaluation: DataFrame, train: DataFrame, stats: DataFrame, prefix: str) -> dict[str, str]:
    """Three outputs under one prefix."""
    paths = {name: os.path.join(prefix, name) for name in ("eval", "train", "stats")}
    write_samples(evaluation, paths["eval"])
    write_samples(train, paths["train"])
    stats.write.json(paths["stats"])
    return paths


def upsert_results(store: DataFrame, new: DataFrame, key: str = "model") -> DataFrame:
    """Rows of models in the new run replace the stored ones; other models stay."""
    return store.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def write_results(spark: SparkSession, root: str, new: DataFrame, version: int) -> str:
    """Store ``version`` = version-1 with the new run merged in; older versions stay readable."""
    target = os.path.join(root, f"v={version}")
    merged = new
    if version > 1:
        merged = upsert_results(spark.read.parquet(os.path.join(root, f"v={version - 1}")), new)
    merged.write.mode("errorifexists").parquet(target)
    return target
