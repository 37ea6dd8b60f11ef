"""Joins between samples, label documents and groups."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import or_empty, stable_distinct
from ..functions.text import skill_text, strip


def _both_sides(samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """(sample, side, i, label): one row per label occurrence."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), or_empty(F.col(s)).alias("labels")) for s in ("pos", "neg")])
    return (samples.select(key, F.explode(sides).alias("s"))
            .select(key, "s.side", F.posexplode("s.labels").alias("i", "label")))


def lookup_labels(samples: DataFrame, skills: DataFrame, key: str = "sample_id") -> DataFrame:
    """Label occurrences with ``hit`` and ``enriched`` text.

    An equi-join on the trimmed label: Spark broadcasts the label table when it is small enough, and
    otherwise splits a hot label over several tasks (adaptive skew join; the right side is unique).
    """
    docs = skills.select(F.col("label").alias("_l"), skill_text(F.col("label"), F.col("description")).alias("enriched"))
    rows = _both_sides(samples, key).withColumn("_l", strip(F.col("label")))
    return rows.join(docs, "_l", "left").withColumn("hit", F.col("enriched").isNotNull()).withColumnRenamed("_l", "trimmed")


def enrich_labels(samples: DataFrame, skills: DataFrame, pos_fallback: bool = True, neg_fallback: bool = True,
                  key: str = "sample_id") -> DataFrame:
    """Replace labels by ``label: description``; a label that is not found stays as it was or is dropped."""
    keep = {"pos": pos_fallback, "neg": neg_fallback}
    found = lookup_labels(samples, skills, key)
    wanted = found.where(F.col("hit") | F.when(F.col("side") == "pos", F.lit(pos_fallback)).otherwise(F.lit(neg_fallback)))
    item = F.struct("i", F.coalesce("enriched", "label").alias("t"))
    lists = wanted.groupBy(key).agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, item))), lambda x: x.t).alias(f"_{s}")
        for s in keep])
    out = samples.join(lists, key, "left").withColumns({s: or_empty(F.col(f"_{s}")) for s in keep}).drop("_pos", "_neg")
    marks = {"enriched": F.lit(True), "pos_fallback": F.lit(pos_fallback), "neg_fallback": F.lit(neg_fallback)}
    if "meta" not in samples.columns:
        return out.withColumns(marks)
    meta = F.col("meta")
    for name, value in marks.items():
        meta = meta.withField(name, value)
    return out.withColumn("meta", meta)


def enrichment_coverage(samples: DataFrame, skills: DataFrame, key: str = "sample_id") -> DataFrame:
    """Per side: label occurrences, distinct labels, occurrences found, distinct labels not found.

    Two steps, so that the distinct counts run over (side, label) counts and not over every occurrence.
    """
    docs = skills.select(F.col("label").alias("trimmed"), F.lit(True).alias("hit")).distinct()
    counts = (_both_sides(samples, key).select("side", strip(F.col("label")).alias("trimmed"))
              .groupBy("side", "trimmed").agg(F.count(F.lit(1)).alias("n")))
    return counts.join(docs, "trimmed", "left").groupBy("side").agg(
        F.sum("n").alias("total_labels"), F.count(F.lit(1)).alias("unique_labels"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("enrichable_labels"),
        F.count_if(F.col("hit").isNull()).alias("missing_labels"))


def enrichment_gain(samples: DataFrame, skills: DataFrame, pos_fallback: bool = True, neg_fallback: bool = True,
                    key: str = "sample_id") -> DataFrame:
    """Label characters before and after, their ratio, labels that grew (counted in the join)."""
    x = lookup_labels(samples, skills, key)
    kept = F.col("hit") | F.when(F.col("side") == "pos", F.lit(pos_fallback)).otherwise(F.lit(neg_fallback))
    new = F.coalesce("enriched", "label")
    agg = x.agg(F.coalesce(F.sum(F.length("label")), F.lit(0)).alias("chars_before"),
                F.coalesce(F.sum(F.when(kept, F.length(new))), F.lit(0)).alias("chars_after"),
                F.count_if(kept & (F.length(new) > F.length("label"))).alias("labels_grown"))
    return agg.withColumn("expansion", F.when(F.col("chars_before") > 0, F.col("chars_after") / F.col("chars_before")).otherwise(0.0))


@dataclass
class LabelIndex:
    """Long tables: no label ever becomes one row holding all of its samples."""
    queries: DataFrame    # (label, sample_id, query), distinct
    negatives: DataFrame  # (label, negative), distinct
    groups: DataFrame     # (label, sample_id, row_no, labels): the distinct positives of each sample of the label


def label_index(samples: DataFrame) -> LabelIndex:
    ok = samples.where(F.col("query").isNotNull() & (F.size(or_empty(F.col("pos"))) > 0)).select(
        "sample_id", "row_no", "query", stable_distinct(F.col("pos")).alias("labels"), or_empty(F.col("neg")).alias("neg"))
    per = ok.select("sample_id", "row_no", "query", "labels", F.explode("labels").alias("label"))
    negatives = (ok.select(F.explode("labels").alias("label"), stable_distinct(F.col("neg")).alias("neg"))
                 .select("label", F.explode("neg").alias("negative")).distinct())
    return LabelIndex(per.select("label", "sample_id", "query"), negatives,
                      per.select("label", "sample_id", "row_no", "labels"))


def label_summary(index: LabelIndex) -> DataFrame:
    """label, number of samples, number of distinct negatives."""
    q = index.queries.groupBy("label").agg(F.count(F.lit(1)).alias("n_samples"))
    n = index.negatives.groupBy("label").agg(F.count(F.lit(1)).alias("n_negatives"))
    return q.join(n, "label", "left").select("label", "n_samples", F.coalesce("n_negatives", F.lit(0)).alias("n_negatives"))


def label_cooccurrence(samples: DataFrame) -> DataFrame:
    """(label, other, n): other positives seen with a label, per occurrence.

    Repeats inside a sample are first folded into counts, pairs are formed inside the row and added up
    on the map side before the shuffle. Counting per occurrence: each occurrence of a label meets each
    occurrence of another one.
    """
    def counted(c: Column) -> Column:
        return F.transform(F.array_distinct(c), lambda l: F.struct(
            l.alias("l"), F.size(F.filter(c, lambda y: y == l)).cast("long").alias("n")))

    a = samples.where(F.size(or_empty(F.col("pos"))) > 1).select(counted(F.col("pos")).alias("c"))
    left = a.select("c", F.explode("c").alias("x"))
    pairs = left.select(F.col("x.l").alias("label"), F.col("x.n").alias("n1"), F.explode("c").alias("y"))
    return (pairs.where(F.col("y.l") != F.col("label"))
            .groupBy("label", F.col("y.l").alias("other")).agg(F.sum(F.col("n1") * F.col("y.n")).alias("n")))


def resolve_qrels(samples: DataFrame, corpus: DataFrame, prefix: bool = True, distinct: bool = True,
                  key: str = "sample_id") -> DataFrame:
    """(query_id, corpus_id): a positive equals a title, or starts with ``title: `` when enriched.

    Every prefix of the label that ends before ': ' is a possible title, so this is an equi-join.
    """
    labels = samples.select(F.col(key).alias("query_id"), F.explode("pos").alias("label"))
    if prefix:
        parts = F.split("label", ": ")
        titles = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ": "))
        labels = labels.select("query_id", F.explode(titles).alias("title"))
    else:
        labels = labels.select("query_id", F.col("label").alias("title"))
    hits = labels.join(corpus.select("title", "corpus_id"), "title").select("query_id", "corpus_id")
    return hits.distinct() if distinct else hits


def query_labels(samples: DataFrame, dataset: str = "dataset") -> DataFrame:
    """(query, labels): positives of the first sample per dataset with that text, datasets in name order."""
    first = samples.groupBy(dataset, F.md5("query").alias("_k")).agg(
        F.min_by(F.struct("query", "pos"), "row_no").alias("f"))
    per = first.groupBy("_k").agg(
        F.first("f.query").alias("query"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(dataset).alias("d"), F.col("f.pos").alias("p")))),
                              lambda x: x.p)).alias("labels"))
    return per.select("query", "labels")


def invert_groups(occupations: DataFrame, group: str = "occupation") -> DataFrame:
    """Size of each group and whether it has members enough to form pairs. Input: (label, group) rows."""
    return occupations.groupBy(group).agg(F.count_distinct("label").alias("n_skills")).withColumn(
        "usable", F.col("n_skills") >= 2)


def explode_occupations(skills: DataFrame) -> DataFrame:
    """Label documents -> distinct (label, occupation) rows."""
    return skills.select("label", F.explode("occupations").alias("occupation")).distinct()
