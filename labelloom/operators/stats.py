"""Counts, length statistics, before/after statistics and histograms.

Percentiles are exact and linear. They are taken over integers (word, token and label counts, ranks), where
Spark keeps one counter per distinct value; the counters are first added up on the map side.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import or_empty
from ..functions.scalars import one_row
from ..functions.text import TOKENS_PER_WORD, word_count


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def label_frequency(samples: DataFrame, side: str = "pos") -> DataFrame:
    return samples.select(F.explode(side).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def overfull_labels(freq: DataFrame, limit: int) -> DataFrame:
    return freq.where(F.col("n") > limit)


def multi_overfull_samples(samples: DataFrame, labels: DataFrame) -> DataFrame:
    """Samples with more than one occurrence of an overfull label, and which ones in order."""
    rows = samples.select("sample_id", F.posexplode("pos").alias("i", "label"))
    hit = rows.join(labels.select("label"), "label", "left_semi")
    return hit.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_overfull"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", "label"))), lambda x: x.label).alias("labels"),
    ).where("n_overfull > 1")


def rare_labels(freq: DataFrame, minimum: int) -> DataFrame:
    """Labels below the minimum with the number of samples they lack."""
    return freq.where(F.col("n") < minimum).withColumn("deficit", F.lit(minimum) - F.col("n"))


def total_deficit(rare: DataFrame) -> DataFrame:
    return rare.agg(F.count(F.lit(1)).alias("n_labels"), F.coalesce(F.sum("deficit"), F.lit(0)).alias("total_deficit"))


def top_labels(freq: DataFrame, n: int = 20) -> DataFrame:
    """Most frequent labels; ties by label. A sort with limit, no full sort."""
    return freq.orderBy(F.desc("n"), "label").limit(n)


def frequency_totals(freq: DataFrame) -> DataFrame:
    return freq.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_labels"))


def frequency_histogram(freq: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary: min, max, median; bins: number of labels per count)."""
    summary = freq.agg(F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.median("n").alias("median_n"))
    return summary, freq.groupBy("n").agg(F.count(F.lit(1)).alias("n_labels"))


def texts_of(samples: DataFrame) -> DataFrame:
    """(kind, text) for queries, positives and negatives in one pass."""
    kinds = F.array(
        F.struct(F.lit("query").alias("kind"), F.array("query").alias("t")),
        F.struct(F.lit("pos").alias("kind"), or_empty(F.col("pos")).alias("t")),
        F.struct(F.lit("neg").alias("kind"), or_empty(F.col("neg")).alias("t")))
    return samples.select(F.explode(kinds).alias("k")).select("k.kind", F.explode("k.t").alias("text"))


def length_stats(texts: DataFrame, col: str = "text", group: str | None = None) -> DataFrame:
    """Words and characters: min, max, mean, median, population std; word percentiles 25/75/90/95/99."""
    x = texts.select(*([group] if group else []), word_count(F.col(col)).alias("w"), F.length(col).cast("long").alias("c"))
    g = x.groupBy(group) if group else x.groupBy()
    out = g.agg(
        F.count(F.lit(1)).alias("count"),
        F.min("w").alias("words_min"), F.max("w").alias("words_max"), F.avg("w").alias("words_mean"),
        F.stddev_pop("w").alias("words_std"),
        F.percentile("w", F.array(*[F.lit(p) for p in (0.5, 0.25, 0.75, 0.9, 0.95, 0.99)])).alias("p"),
        F.min("c").alias("chars_min"), F.max("c").alias("chars_max"), F.avg("c").alias("chars_mean"),
        F.percentile("c", F.lit(0.5)).alias("chars_median"), F.stddev_pop("c").alias("chars_std"))
    names = ("words_median", "words_p25", "words_p75", "words_p90", "words_p95", "words_p99")
    return out.select("*", *[F.col("p")[i].alias(n) for i, n in enumerate(names)]).drop("p")


def context_budget(samples: DataFrame) -> DataFrame:
    """Word cut-offs and token estimates for 90/95/99 % coverage; class and recommended length."""
    labels = F.aggregate("pos", F.lit(0).cast("long"), lambda s, x: s + word_count(x))
    x = samples.select(word_count(F.col("query")).alias("w"), labels.alias("lw"), F.size("pos").alias("ln"))
    a = x.agg(F.percentile("w", F.array(*[F.lit(p) for p in (0.9, 0.95, 0.99)])).alias("p"),
              F.sum("lw").alias("lw"), F.sum("ln").alias("ln"))
    factor = F.lit(TOKENS_PER_WORD)
    label_tokens = _share(F.col("lw"), F.col("ln")) * factor
    rows = F.array(*[F.struct(F.lit(c).alias("coverage"), F.col("p")[i].alias("cutoff_words"),
                              (F.col("p")[i] * factor).alias("query_tokens"),
                              (F.col("p")[i] * factor + label_tokens).alias("pair_tokens"))
                     for i, c in enumerate((90, 95, 99))])
    top = F.col("p")[2] * factor
    return a.select(
        F.explode(rows).alias("r"),
        F.when(top <= 256, "short").when(top <= 512, "medium").otherwise("long").alias("context_class"),
        F.floor(F.col("p")[1] * factor).cast("long").alias("recommended_length"),
    ).select("r.*", "context_class", "recommended_length")


def length_outliers(samples: DataFrame) -> DataFrame:
    """Queries above the 99th percentile or below 5 words, labels above 10 words, with shares and flags.

    The texts are read once: word counts are folded to one row per count, and the percentile, the outlier
    counts and the totals all come from those counts.
    """
    counts = (texts_of(samples).where("kind <> 'neg'").groupBy("kind", word_count(F.col("text")).alias("w"))
              .agg(F.count(F.lit(1)).alias("n")))
    p = counts.where("kind = 'query'").agg(F.percentile("w", F.lit(0.99), F.col("n")).alias("p99"))
    agg = counts.withColumn("p99", one_row(p).p99).agg(
        F.first("p99").alias("p99"),
        F.coalesce(F.sum(F.when(F.col("kind") == "query", F.col("n"))), F.lit(0)).alias("n_queries"),
        F.coalesce(F.sum(F.when(F.col("kind") == "pos", F.col("n"))), F.lit(0)).alias("n_labels"),
        F.coalesce(F.sum(F.when((F.col("kind") == "query") & (F.col("w") > F.col("p99")), F.col("n"))), F.lit(0)).alias("very_long_queries"),
        F.coalesce(F.sum(F.when((F.col("kind") == "query") & (F.col("w") < 5), F.col("n"))), F.lit(0)).alias("very_short_queries"),
        F.coalesce(F.sum(F.when((F.col("kind") == "pos") & (F.col("w") > 10), F.col("n"))), F.lit(0)).alias("very_long_labels"))
    return agg.select(
        "*", (_share(F.col("very_long_queries"), F.col("n_queries")) * 100).alias("long_pct"),
        (_share(F.col("very_short_queries"), F.col("n_queries")) * 100).alias("short_pct"),
        (_share(F.col("very_long_labels"), F.col("n_labels")) * 100).alias("long_label_pct"),
        (F.col("very_long_queries") > F.col("n_queries") * 0.05).alias("needs_chunking"),
        (F.col("very_short_queries") > F.col("n_queries") * 0.1).alias("needs_minimum_length"))


def lengths_by_dataset(samples: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Per dataset: mean, sample std and max of query words, mean of the average positive length; one decimal."""
    label_words = F.aggregate("pos", F.lit(0).cast("long"), lambda s, x: s + word_count(x))
    avg_pos = F.when(F.size("pos") > 0, label_words / F.size("pos")).otherwise(0.0)
    return samples.groupBy(dataset).agg(
        F.round(F.avg(word_count(F.col("query"))), 1).alias("words_mean"),
        F.round(F.stddev_samp(word_count(F.col("query"))), 1).alias("words_std"),
        F.max(word_count(F.col("query"))).alias("words_max"),
        F.round(F.avg(avg_pos), 1).alias("pos_words_mean"))


def length_asymmetry(samples: DataFrame) -> DataFrame:
    """Ratio of mean query words to mean label words, its class, and the variance flag."""
    label_words = F.aggregate("pos", F.lit(0).cast("long"), lambda s, x: s + word_count(x))
    a = samples.select(word_count(F.col("query")).alias("w"), label_words.alias("lw"), F.size("pos").alias("ln")).agg(
        F.avg("w").alias("query_words"), F.stddev_pop("w").alias("query_words_std"),
        F.sum("lw").alias("lw"), F.sum("ln").alias("ln"))
    b = a.select("query_words", "query_words_std", _share(F.col("lw"), F.col("ln")).alias("label_words"))
    ratio = F.when(F.col("label_words") > 0, F.col("query_words") / F.col("label_words")).otherwise(0.0)
    return b.withColumn("ratio", ratio).select(
        "*", F.when(F.col("ratio") > 10, "very asymmetric").when(F.col("ratio") > 5, "moderate").otherwise("similar").alias("asymmetry"),
        (F.col("query_words_std") > F.col("query_words") * 0.5).alias("high_variance"))


def split_stats(assigned: DataFrame, split: str = "split") -> DataFrame:
    """Sizes, query words, positives and negatives for both sides of a split, in one aggregate."""
    x = assigned.select(F.col(split).alias("split"), word_count(F.col("query")).alias("w"),
                        F.size(or_empty(F.col("pos"))).alias("p"), F.size(or_empty(F.col("neg"))).alias("m"))
    out = [F.count(F.lit(1)).alias("n"), F.min("w").alias("words_min"), F.max("w").alias("words_max")]
    for c, name in (("w", "words"), ("p", "pos"), ("m", "neg")):
        out += [F.avg(c).alias(f"{name}_mean"), F.stddev_pop(c).alias(f"{name}_std"), F.median(c).alias(f"{name}_median")]
    g = x.groupBy("split").agg(*out)
    total = x.agg(F.count(F.lit(1)).alias("_t"))
    return g.withColumn("pct", F.col("n") * 100.0 / one_row(total)["_t"])


def category_stats(classified: DataFrame, chosen: DataFrame) -> DataFrame:
    """Per category: available, selected, %. Input: (sample_id, category) rows and chosen (sample_id, category)."""
    a = classified.groupBy("category").agg(F.count(F.lit(1)).alias("total_available"))
    s = chosen.groupBy("category").agg(F.count(F.lit(1)).alias("selected"))
    n = F.coalesce("selected", F.lit(0))
    return a.join(s, "category", "left").select("category", "total_available", n.alias("selected"),
                                               (n * 100.0 / F.col("total_available")).alias("percentage"))


def compression_stats(before: DataFrame, after: DataFrame, limit: int = 320) -> DataFrame:
    """Token statistics before (tokens, route, n_pos) and after (tokens, strategy), in one row."""
    need = F.col("route") != "keep"
    b = before.agg(F.count(F.lit(1)).alias("n_before"), F.avg("tokens").alias("avg_before"), F.max("tokens").alias("max_before"),
                   F.min("tokens").alias("min_before"), F.count_if(need).alias("need_compress"),
                   F.count_if(F.col("route") == "split").alias("need_split"), F.sum("n_pos").alias("n_pos"))
    a = after.agg(F.count(F.lit(1)).alias("n_after"), F.avg("tokens").alias("avg_after"), F.max("tokens").alias("max_after"),
                  F.min("tokens").alias("min_after"), F.count_if(F.col("tokens") > limit).alias("still_too_long"),
                  *[F.count_if(F.col("strategy") == s).alias(f"n_{s}") for s in ("keep", "split", "compress")])
    both = b.withColumn("_a", one_row(a)).select("*", "_a.*").drop("_a")
    n = F.col("n_before")
    return both.select("*", (_share(F.col("need_compress"), n) * 100).alias("need_compress_pct"),
                       (_share(F.col("need_split"), n) * 100).alias("need_split_pct"),
                       _share(F.col("n_after"), n).alias("expansion_ratio"))


def mining_stats(mined: DataFrame) -> DataFrame:
    """Means of negatives before/after, additions, and candidate totals of a mined table."""
    return mined.agg(
        F.avg("n_before").alias("avg_before"), F.avg("total_negatives").alias("avg_after"),
        F.avg("hard_negatives_added").alias("avg_added"), F.count_if(F.col("hard_negatives_added") > 0).alias("with_additions"),
        F.sum("candidates").alias("candidates"), F.sum("excluded_used").alias("excluded_used"),
        F.sum("excluded_by_positive_similarity").alias("excluded_similar"), F.sum("hard_negatives_added").alias("added"))


def reduction_by_label(before: DataFrame, after: DataFrame, limit: int) -> DataFrame:
    """Per label: count before and after, removed, and whether it was overfull. Inputs: two frequency tables."""
    b = before.select("label", F.col("n").alias("n_before"))
    a = after.select("label", F.col("n").alias("n_after"))
    return b.join(a, "label", "full").select(
        "label", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"),
        (F.coalesce("n_before", F.lit(0)) - F.coalesce("n_after", F.lit(0))).alias("removed"),
        (F.coalesce("n_before", F.lit(0)) > limit).alias("overfull"))


def top_reduced(by_label: DataFrame, n: int = 10) -> DataFrame:
    return by_label.where("removed > 0").orderBy(F.desc("removed"), "label").limit(n)


def multi_label_impact(samples: DataFrame, removed: DataFrame, limit: int) -> DataFrame:
    """(label, n): how often each overfull label stands in the samples that were removed for having several; ``removed``: sample_id."""
    over = overfull_labels(label_frequency(samples), limit).select("label")
    gone = samples.join(removed.select("sample_id").distinct(), "sample_id", "left_semi")
    return gone.select(F.explode("pos").alias("label")).join(over, "label", "left_semi").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def reduction_stats(before: DataFrame, after: DataFrame, by_label: DataFrame) -> DataFrame:
    """original / final / removed samples and the number of overfull labels."""
    sizes = before.select(F.lit(1).alias("b"), F.lit(0).alias("a"), F.lit(0).alias("o")).unionAll(
        after.select(F.lit(0), F.lit(1), F.lit(0))).unionAll(
        by_label.select(F.lit(0), F.lit(0), F.col("overfull").cast("int")))
    return sizes.agg(F.sum("b").alias("original"), F.sum("a").alias("final"),
                     (F.sum("b") - F.sum("a")).alias("removed"), F.sum("o").alias("overfull_labels"))


def histogram(df: DataFrame, col: str, bins: int, low: float, high: float, group: str | None = None,
              density: bool = False) -> DataFrame:
    """(group, bin 0.., n[, density]) with equal bins on [low, high]; the upper edge belongs to the last bin."""
    width = (high - low) / bins
    b = F.least(F.floor((F.col(col) - low) / width), F.lit(bins - 1)).cast("long")
    keys = ([group] if group else []) + ["bin"]
    out = (df.where(F.col(col).between(low, high)).withColumn("bin", b).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    if density:
        from pyspark.sql import Window
        # the window runs over at most ``bins`` rows per group
        total = F.sum("n").over(Window.partitionBy(group) if group else Window.partitionBy(F.lit(1)))
        out = out.withColumn("density", F.col("n") / (total * width))
    return out


def exposure_stats(pairs: DataFrame, n_samples: DataFrame, batch_size: int = 32, accumulation: int = 2) -> DataFrame:
    """Pairs per sample, share and mean of hard negatives, in-batch negatives estimate."""
    a = pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.size("negatives") > 0).alias("with_hard"),
                  F.coalesce(F.sum(F.size("negatives")), F.lit(0)).alias("hard"))
    s = n_samples.agg(F.count(F.lit(1)).alias("n_samples"))
    x = a.withColumn("n_samples", one_row(s).n_samples)
    mean_hard = _share(F.col("hard"), F.col("n_pairs"))
    return x.select("n_samples", "n_pairs", _share(F.col("n_pairs"), F.col("n_samples")).alias("pairs_per_sample"),
                    "with_hard", (_share(F.col("with_hard"), F.col("n_pairs")) * 100).alias("with_hard_pct"),
                    mean_hard.alias("avg_hard_negatives"), (F.lit(batch_size * accumulation - 1) - mean_hard).alias("in_batch_negatives"))


def positives_per_query(qrels: DataFrame, corpus: DataFrame) -> DataFrame:
    """count, avg/min/max positives per query, corpus size."""
    per = qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    a = per.agg(F.count(F.lit(1)).alias("n_queries"), F.avg("n").alias("avg_pos"), F.min("n").alias("min_pos"), F.max("n").alias("max_pos"))
    return a.withColumn("corpus_size", one_row(corpus.agg(F.count(F.lit(1)).alias("n"))).n)
