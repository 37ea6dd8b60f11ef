"""Explicit schemas of the data model."""
from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()
STRINGS = T.ArrayType(_S)
VECTOR = T.ArrayType(T.FloatType())

META_FIELDS = [
    T.StructField("source", _S),
    T.StructField("label", _S),
    T.StructField("scenario", _S),
    T.StructField("enriched", T.BooleanType()),
    T.StructField("pos_fallback", T.BooleanType()),
    T.StructField("neg_fallback", T.BooleanType()),
    T.StructField("hard_negatives_added", _L),
    T.StructField("total_negatives", _L),
    T.StructField("excluded_by_positive_similarity", _L),
    T.StructField("augmentation", _S),
    T.StructField("group_index", _L),
    T.StructField("group_size", _L),
    T.StructField("total_groups", _L),
]
META_KNOWN = [f.name for f in META_FIELDS]
META = T.StructType(META_FIELDS + [T.StructField("extra", T.MapType(_S, _S))])

# Position of a row inside its source: comparable, and independent of how files are split into tasks.
ROW_NO = T.StructType([
    T.StructField("file", _S), T.StructField("block", _L), T.StructField("seq", _L)])

RAW_SAMPLE = T.StructType([
    T.StructField("query", _S), T.StructField("pos", STRINGS), T.StructField("neg", STRINGS),
    T.StructField("meta", _S)])
SAMPLE = T.StructType([
    T.StructField("sample_id", _S), T.StructField("query", _S), T.StructField("pos", STRINGS),
    T.StructField("neg", STRINGS), T.StructField("meta", META)])
SKILL = T.StructType([
    T.StructField("label", _S), T.StructField("description", _S),
    T.StructField("occupations", STRINGS), T.StructField("skill_type", _S)])
EMBEDDING = T.StructType([
    T.StructField("model_id", _S), T.StructField("text_id", _S), T.StructField("text", _S),
    T.StructField("vector", VECTOR)])
TOPK = T.StructType([
    T.StructField("query_id", _S), T.StructField("corpus_id", _S), T.StructField("score", T.DoubleType())])
