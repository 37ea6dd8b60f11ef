"""Projections, filters and schema normalisation of samples."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import empty_strings, keep_marked, let, or_empty
from ..functions.text import strip

# --- fixed values: accepted field names, in order of preference ---
QUERY_ALIASES = ("query", "text", "description", "title", "course_description")
POS_ALIASES = ("pos", "positive", "labels", "skills", "competences")
NEG_ALIASES = ("neg", "negative", "hard_negatives")
# -------------------------------------------------------------------


def normalise_samples(df: DataFrame, keys=("sample_id", "row_no")) -> DataFrame:
    """Only query/pos/neg (and the row keys); rows without query dropped, missing lists -> []."""
    keep = [k for k in keys if k in df.columns]
    return df.where(F.col("query").isNotNull()).select(
        *keep, "query", or_empty(F.col("pos")).alias("pos"), or_empty(F.col("neg")).alias("neg"))


def standardise(df: DataFrame, source: str, record: str = "record", keys=("sample_id", "row_no")) -> DataFrame:
    """JSON texts with varying field names -> query, positives, negatives, metadata map.

    The first PRESENT query alias wins, the first NON-EMPTY list alias wins, scalars become one-element
    lists, everything else goes to ``metadata``; rows without query or positives are dropped.
    """
    v = F.col("_v")
    raw = F.from_json(F.col(record), "map<string,string>")

    def strings(name) -> Column:
        def as_list(x):
            return F.when(F.schema_of_variant(x).startswith("ARRAY"), F.filter(
                F.try_variant_get(x, "$", "array<string>"), lambda y: y.isNotNull())).when(
                F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("")) != "", F.array(F.try_variant_get(x, "$", "string")))
        return let(F.try_variant_get(v, f"$.{name}", "variant"), as_list)

    def first_filled(names) -> Column:
        return F.coalesce(F.get(F.filter(F.array(*[strings(n) for n in names]), lambda x: F.size(x) > 0), F.lit(0)), empty_strings())

    names = QUERY_ALIASES + POS_ALIASES + NEG_ALIASES
    query = F.lit(None).cast("string")
    for name in reversed(QUERY_ALIASES):
        query = F.when(F.map_contains_key(F.col("_raw"), name), F.try_variant_get(v, f"$.{name}", "string")).otherwise(query)
    leftovers = F.map_filter(F.col("_raw"), lambda k, _: ~k.isin(*names))
    keep = [k for k in keys if k in df.columns]
    row = F.struct(
        query.alias("query"), first_filled(POS_ALIASES).alias("pos"), first_filled(NEG_ALIASES).alias("neg"),
        F.map_concat(leftovers, F.create_map(F.lit("source_dataset"), F.lit(source))).alias("metadata"))
    # filtered inside the row: a condition above this projection would be pushed below it and parse again
    good = F.filter(F.array("_row"), lambda r: (F.coalesce(r.query, F.lit("")) != "") & (F.size(r.pos) > 0))
    parsed = df.withColumn("_raw", raw).withColumn("_v", F.try_parse_json(record)).select(*keep, row.alias("_row"))
    return parsed.select(*keep, F.inline(good))


def filter_labels(df: DataFrame, marker: str = ":") -> DataFrame:
    """Keep only labels that contain the marker; a missing list stays missing."""
    return df.withColumns({c: keep_marked(F.col(c), marker) for c in ("pos", "neg")})


def drop_empty_pos(df: DataFrame, keep: bool = False) -> DataFrame:
    return df if keep else df.where(F.size(or_empty(F.col("pos"))) > 0)


def extract_names(df: DataFrame, name: str = "skill", unique: bool = True, row_no: str = "row_no") -> DataFrame:
    """Non-empty names in source order; with ``unique`` each once, at its first appearance."""
    rows = df.where(F.coalesce(name, F.lit("")) != "").select(F.col(name).alias("name"), F.col(row_no).alias("row_no"))
    return rows.groupBy("name").agg(F.min("row_no").alias("row_no")) if unique else rows


def is_evaluable(query: Column, pos: Column) -> Column:
    return (F.length(strip(F.coalesce(query, F.lit("")))) > 0) & (F.size(or_empty(pos)) > 0)


def evaluable(df: DataFrame) -> DataFrame:
    """Rows with a query and positives (``positive_labels`` is accepted for ``pos``)."""
    if "pos" not in df.columns and "positive_labels" in df.columns:
        df = df.withColumnRenamed("positive_labels", "pos")
    return df.where(is_evaluable(F.col("query"), F.col("pos")))


def profile_fields(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null count, min/avg/max length of texts and arrays; a single pass."""
    measures, rows = [F.count(F.lit(1)).alias("n_rows")], []
    for i, f in enumerate(df.schema.fields):
        kind = f.dataType.typeName()
        size = (F.length(f.name) if kind == "string" else F.size(f.name) if kind == "array" else F.lit(None).cast("int"))
        size = F.when(F.col(f.name).isNotNull(), size)
        measures += [F.count(f.name).alias(f"n{i}"), F.min(size).cast("long").alias(f"lo{i}"),
                     F.max(size).cast("long").alias(f"hi{i}"), F.avg(size).alias(f"av{i}")]
        rows.append(F.struct(F.lit(f.name).alias("field"), F.lit(kind).alias("type"), F.col("n_rows").alias("n_rows"),
                             F.col(f"n{i}").alias("non_null"), F.col(f"lo{i}").alias("min_size"),
                             F.col(f"hi{i}").alias("max_size"), F.col(f"av{i}").alias("avg_size")))
    return df.agg(*measures).select(F.inline(F.array(*rows)))
