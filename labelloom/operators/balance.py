"""Balancing, stratified selection and expansion planning.

Random choices follow md5(seed|id). Ranks that may cover a third of all rows are running counts over buckets
(functions.ranking), never one sorted partition.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import hash_order, hash_uniform
from ..functions.ranking import running_before
from ..functions.scalars import one_row
from ..session import cut_lineage
from .classify import UNCLASSIFIED
from .similarity import in_group_redundancy
from .stats import label_frequency

# --- fixed values -----------------------------------------------------------------------------
SCENARIOS = ["Weiterbildungskursbeschreibung", "Kursinhalte", "Lernzielbeschreibung", "Lernergebnis",
             "Jobprofil-Zusammenfassung", "CV-Kompetenzenabschnitt", "Weiterbildungsberatung",
             "Suchanfrage für Fortbildungen", "Praxiserfahrung/Lehren aus beruflicher Erfahrung"]
PRIORITIES = {"00": 5.0, "T5": 4.5, "01": 4.0, "04": 4.0, "S5": 4.0, "02": 3.5, "10": 3.5, "T2": 3.5, "05": 3.0,
              "T6": 3.5, "S2": 3.0, "S4": 2.5, "L": 1.5, "08": 1.0, "T3": 1.0, "09": 1.0, "S7": 2.0, "S1": 2.0,
              "S3": 2.0, "S6": 2.0, "S8": 2.0, "T4": 2.0, "03": 2.0, "06": 2.0, "07": 2.0, "99": 1.0}
BUCKETS = ["short", "medium", "long"]
# ----------------------------------------------------------------------------------------------


def _hash_bucket(key: Column) -> Column:
    """Leading 12 bits of an md5 text: grows with it."""
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


# --- capping frequent labels ----------------------------------------------------------------------

def cap_multi_label(samples: DataFrame, limit: int, order_bucket: int = 100_000) -> DataFrame:
    """(sample_id, row_no, labels): samples with several overfull labels that the greedy walk removes.

    The walk visits such samples by number of overfull labels (descending, then row order) and removes one
    if any of its labels is above the limit at that moment, lowering ALL its labels. Every visited sample of
    a label is removed until that label's excess is used up, so the walk has a closed form: a sample goes
    exactly when, for one of its labels, the occurrences before it are fewer than the excess. That is one
    running sum per label, and no loop. ``labels`` are those that were above the limit.

    ``row_no`` is numeric; ``order_bucket`` rows of it share a bucket of the running sum.
    """
    freq = label_frequency(samples).where(F.col("n") > limit).select("label", (F.col("n") - limit).alias("excess"))
    rows = (samples.select("sample_id", "row_no", F.posexplode("pos").alias("i", "label")).join(freq, "label")
            .groupBy("sample_id", "row_no", "label", "excess").agg(F.count(F.lit(1)).alias("m"), F.min("i").alias("i")))
    size = rows.groupBy("sample_id").agg(F.sum("m").alias("k")).where("k > 1")
    multi = rows.join(size, "sample_id")
    bucket = F.struct((-F.col("k")).alias("k"), F.floor(F.col("row_no") / order_bucket).alias("b"))
    walked = running_before(multi, ["label"], bucket, [F.desc("k"), F.col("row_no")], {"before": F.col("m")})
    over = walked.where(F.col("before") < F.col("excess"))
    return over.groupBy("sample_id", "row_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "label"))), lambda x: x.label).alias("labels"))


def cap_label(samples: DataFrame, limit: int, dim: int, diversity_weight: float = 1.0, seed: int = 42) -> DataFrame:
    """(sample_id, label): for each label still above the limit, its surplus samples.

    A share of ``diversity_weight`` are the most redundant of the label's samples, the others random. Input
    carries ``vector``; all labels are treated at once on the counts of the input.
    """
    freq = label_frequency(samples).where(F.col("n") > limit).select("label", (F.col("n") - limit).alias("surplus"))
    members = (samples.select("sample_id", "vector", F.explode(F.array_distinct("pos")).alias("label")).join(freq, "label"))
    size = members.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    members = members.join(size.where(F.col("size") > limit), "label")
    red = in_group_redundancy(members, dim, key="sample_id", group="label").select(
        F.col("id").alias("sample_id"), F.col("group").alias("label"), F.round("redundancy", 9).alias("redundancy"))
    x = red.join(members.select("sample_id", "label", "surplus"), ["sample_id", "label"])
    share = F.floor(F.col("surplus") * diversity_weight + (hash_uniform(seed, F.col("label")) if diversity_weight < 1 else F.lit(0.0)))
    x = x.withColumn("by_redundancy", F.least(share, F.col("surplus")))
    x = running_before(x, ["label"], -F.floor(F.col("redundancy") * 1000), [F.desc("redundancy"), F.col("sample_id")],
                       {"r": F.lit(1).cast("long")})
    near = x.where(F.col("r") < F.col("by_redundancy")).select("sample_id", "label")
    if diversity_weight >= 1:
        return near
    key = hash_order(seed, F.col("label"), F.col("sample_id"))
    rest = x.where(F.col("r") >= F.col("by_redundancy")).drop("r").withColumn("_h", key)
    rest = running_before(rest, ["label"], _hash_bucket(F.col("_h")), [F.col("_h"), F.col("sample_id")], {"r": F.lit(1).cast("long")})
    return near.unionByName(rest.where(F.col("r") < F.col("surplus") - F.col("by_redundancy")).select("sample_id", "label"))


def removed_with_reason(multi: DataFrame, single: DataFrame) -> DataFrame:
    """(sample_id, removal_reason); the reason of the first step wins."""
    a = multi.select("sample_id", F.concat(F.lit("Multiple overfitting labels: "), F.array_join("labels", ", ")).alias("removal_reason"))
    b = single.groupBy("sample_id").agg(F.concat(F.lit("Overfitting label: "), F.min("label")).alias("removal_reason"))
    return a.unionByName(b.join(a.select("sample_id"), "sample_id", "left_anti"))


def reduce_overfull(samples: DataFrame, limit: int, dim: int, diversity_weight: float = 1.0, seed: int = 42):
    """(kept, removed with reason): first multi-label samples, then the surplus of single labels."""
    first = cap_multi_label(samples, limit)
    left = samples.join(first.select("sample_id"), "sample_id", "left_anti")
    second = cap_label(left, limit, dim, diversity_weight, seed)
    reasons = removed_with_reason(first, second)
    return samples.join(reasons.select("sample_id"), "sample_id", "left_anti"), samples.join(reasons, "sample_id")


# --- evaluation split -----------------------------------------------------------------------------

def quota_ratio(classified: DataFrame, ratio: float, minimum: int, maximum: int | None = None) -> DataFrame:
    """(category, size, quota) with quota = max(minimum, int(size x ratio)), at most ``maximum``."""
    q = F.greatest(F.lit(minimum).cast("long"), F.floor(F.col("size") * F.lit(ratio)).cast("long"))
    if maximum is not None:
        q = F.least(q, F.lit(maximum).cast("long"))
    return classified.groupBy("category").agg(F.count(F.lit(1)).alias("size")).withColumn("quota", q)


def quota_size(classified: DataFrame, eval_size: int, minimum: int, maximum: int | None = None) -> DataFrame:
    """(category, size, quota): smallest category first, each limited by the slots that are left.

    The walk runs over one array of category sizes, which the taxonomy bounds.
    """
    sizes = classified.where(F.col("category") != UNCLASSIFIED).groupBy("category").agg(F.count(F.lit(1)).alias("size"))
    walk = sizes.agg(F.array_sort(F.collect_list(F.struct("size", "category"))).alias("c"), F.sum("size").alias("total"))
    cap = F.lit(maximum if maximum is not None else 2 ** 62).cast("long")

    def step(state, c):
        share = F.when(c.size <= 50, F.floor(c.size / 2)).otherwise(F.floor(F.lit(eval_size) * (c.size / F.col("total"))))
        want = F.least(cap, F.greatest(F.lit(minimum).cast("long"), share.cast("long")), state.left)
        return F.struct((state.left - want).alias("left"),
                        F.concat(state.out, F.array(F.struct(c.category.alias("category"), c.size.alias("size"), want.alias("quota")))).alias("out"))

    start = F.struct(F.lit(eval_size).cast("long").alias("left"),
                     F.expr("cast(array() as array<struct<category:string,size:bigint,quota:bigint>>)").alias("out"))
    return walk.select(F.inline(F.aggregate("c", start, step).out)).where("quota > 0")


def stratified_pick(rows: DataFrame, quotas: DataFrame, seed: int = 42, stratify: bool = True) -> DataFrame:
    """(sample_id, category): at most ``quota`` rows per category, first the same number from each bucket.

    ``rows``: sample_id, category, bucket; ``quotas``: category, size, quota. Buckets are used when the
    category has at least twice its quota; what they leave open is filled in md5 order.
    """
    x = rows.join(quotas, "category").withColumn("_h", hash_order(seed, F.col("sample_id")))
    ordinal = F.coalesce(F.array_position(F.array(*[F.lit(b) for b in BUCKETS]), F.col("bucket")), F.lit(0))
    x = x.withColumn("_o", ordinal)
    one = {"r": F.lit(1).cast("long")}
    x = running_before(x, ["category", "_o"], _hash_bucket(F.col("_h")), [F.col("_h"), F.col("sample_id")], one)
    # a handful of rows: categories x buckets
    counts = rows.withColumn("_o", ordinal).groupBy("category", "_o").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("category")
    before = w.orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    c = counts.join(quotas, "category").withColumn("_per", F.when(
        F.lit(stratify) & (F.col("size") >= 2 * F.col("quota")),
        F.greatest(F.lit(1).cast("long"), F.floor(F.col("quota") / F.count(F.lit(1)).over(w)))).otherwise(F.lit(0).cast("long")))
    c = c.withColumn("_take", F.least("_per", "_n"))
    c = (c.withColumn("_start", F.coalesce(F.sum("_take").over(before), F.lit(0)))
         .withColumn("_pre", F.least(F.sum("_take").over(w), F.col("quota"))).select("category", "_o", "_take", "_start", "_pre"))
    x = x.join(c, ["category", "_o"])
    x = x.withColumn("_first", F.col("r") < F.col("_take"))
    pre = x.where(F.col("_first") & (F.col("_start") + F.col("r") < F.col("quota")))
    rest = running_before(x.where(~F.col("_first")).drop("r"), ["category"], _hash_bucket(F.col("_h")),
                          [F.col("_h"), F.col("sample_id")], one)
    top_up = rest.where(F.col("r") < F.col("quota") - F.col("_pre"))
    return pre.select("sample_id", "category").unionByName(top_up.select("sample_id", "category"))


def representative_split(classified: DataFrame, ratio: float | None = 0.1, eval_size: int | None = None, minimum: int = 5,
                         maximum: int | None = None, stratify: bool = True, seed: int = 42) -> DataFrame:
    """(sample_id, category) of the evaluation set; the training set is the rest (left_anti).

    ``classified``: sample_id, category, bucket, one row per category of a sample. Categories go smallest
    first, so a sample of two categories is taken once, and UNCLASSIFIED goes last. The driver loops over
    the categories only (a taxonomy has a few dozen); each step is checkpointed.
    """
    sizes = {r.category: r["size"] for r in classified.groupBy("category").agg(F.count(F.lit(1)).alias("size")).collect()}
    order = sorted((c for c in sizes if c != UNCLASSIFIED), key=lambda c: (sizes[c], c))
    total, left = sum(sizes[c] for c in order), eval_size
    rows = cut_lineage(classified.select("sample_id", "category", "bucket"))
    spark, chosen = classified.sparkSession, None

    def take(category, quota, layered):
        nonlocal chosen
        mine = rows.where(F.col("category") == category)
        if chosen is not None:
            mine = mine.join(chosen.select("sample_id"), "sample_id", "left_anti")
        q = spark.createDataFrame([(category, sizes[category], int(quota))], "category string, size bigint, quota bigint")
        step = cut_lineage(stratified_pick(mine, q, seed, layered))
        chosen = step if chosen is None else chosen.unionByName(step)
        return step

    for c in order:
        if ratio is not None:
            quota = max(minimum, int(sizes[c] * ratio))
            quota = quota if maximum is None else min(quota, maximum)
        else:
            if left <= 0:
                break
            quota = max(minimum, sizes[c] // 2 if sizes[c] <= 50 else int(eval_size * (sizes[c] / total)))
            quota = min(quota if maximum is None else min(quota, maximum), left)
        step = take(c, quota, stratify)
        if ratio is None:
            left -= step.count()
    if UNCLASSIFIED in sizes:
        if ratio is not None:
            quota = max(minimum, int(sizes[UNCLASSIFIED] * ratio))
            quota = quota if maximum is None else min(quota, maximum)
        else:
            quota = max(left, 0)
        if quota:
            take(UNCLASSIFIED, quota, False)
    return chosen if chosen is not None else rows.limit(0).select("sample_id", "category")


def split_train(samples: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(evaluation, train)."""
    ids = chosen.select("sample_id").distinct()
    return samples.join(ids, "sample_id", "left_semi"), samples.join(ids, "sample_id", "left_anti")


# --- expansion ------------------------------------------------------------------------------------

def expansion_score(description: Column, n_occupations: Column, flags: dict[str, Column], priority: Column, novelty: Column | None = None) -> Column:
    text = F.coalesce(description, F.lit(""))
    size = F.length(text)
    base = (F.when(text != "", 2.0).otherwise(0.3)
            + F.when(n_occupations >= 10, 2.0).when(n_occupations >= 6, 1.5).when(n_occupations >= 3, 1.0).otherwise(0.0)
            + F.when(size >= 200, 1.0).when(size >= 120, 0.6).when(size >= 80, 0.3).otherwise(0.0))
    factor = (F.when(flags["is_circus"], 0.3).when(flags["is_religious"], 0.4).when(flags["is_military"], 0.5).otherwise(1.0))
    score = base * factor * priority
    return score if novelty is None else score + 1.5 * novelty


def priority_of(category: Column, priorities: dict[str, float] | None = None, default: float = 1.0) -> Column:
    out = F.lit(default)
    for code, value in (PRIORITIES if priorities is None else priorities).items():
        out = F.when(category == code, F.lit(float(value))).otherwise(out)
    return out


def score_expansion(skills: DataFrame, uncovered: DataFrame, category: Column, priorities: dict[str, float] | None = None,
                    novelty: DataFrame | None = None) -> DataFrame:
    """(label, score, category) of uncovered labels with 3+ occupations and 50+ description characters.

    ``skills``: label, description, occupations; ``category`` is an expression over them.
    """
    from .classify import domain_flags
    x = skills.join(uncovered.select("label"), "label", "left_semi").where(
        (F.size("occupations") >= 3) & (F.length(F.coalesce("description", F.lit(""))) >= 50)).withColumn("category", category)
    extra = None
    if novelty is not None:
        x, extra = x.join(novelty, "label", "left"), F.coalesce(F.col("novelty"), F.lit(0.5))
    score = expansion_score(F.col("description"), F.size("occupations"), domain_flags(F.col("label"), F.col("description")),
                            priority_of(F.col("category"), priorities), extra)
    return x.select("label", F.round(score, 9).alias("score"), "category")


def expansion_target(covered: int, uncovered: int, ratio: float) -> int:
    return int(covered * ratio) or max(10, uncovered // 20)


def select_expansion(scored: DataFrame, target: int, priorities: dict[str, float] | None = None) -> DataFrame:
    """(label, score, category, rank): best first, limited per category, up to 2 x target; filled up to target."""
    p = PRIORITIES if priorities is None else priorities
    caps = {code: max(5, target // 4) if value >= 4 else max(3, target // 6) if value >= 3 else max(2, target // 10) for code, value in p.items()}
    limit = F.lit(3)
    for code, cap in caps.items():
        limit = F.when(F.col("category") == code, cap).otherwise(limit)
    best = [F.desc("score"), F.col("label")]
    nth = F.row_number().over(Window.partitionBy("category").orderBy(*best))
    # no more of a category can be chosen or fill up, so the rest goes before the shuffle (group limit)
    most = max(3, *caps.values()) + target
    x = scored.withColumn("category", F.coalesce("category", F.lit(""))).withColumn("_r", nth).where(F.col("_r") <= most)
    x = cut_lineage(x.withColumn("_in", F.col("_r") <= limit))

    def first(rows: DataFrame, n: int) -> DataFrame:
        """The best n rows, numbered."""
        return rows.orderBy(*best).limit(n).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*best)).cast("long"))

    chosen = first(x.where("_in"), 2 * target)
    n = one_row(x.agg(F.least(F.count_if("_in"), F.lit(2 * target)).alias("n"))).n
    # when the limits leave the list short, everything within the limits is already chosen
    fill = first(x.where("not _in"), target).where(F.col("rank") <= F.lit(target) - n).withColumn("rank", n + F.col("rank"))
    return chosen.unionByName(fill).select("label", "score", "category", "rank")


def expansion_report(selected: DataFrame, skills: DataFrame) -> DataFrame:
    """skill, priority_score, description, occupations."""
    return selected.join(skills.select("label", "description", "occupations"), "label").select(
        F.col("label").alias("skill"), F.col("score").alias("priority_score"), "description", "occupations", "category")


def expansion_by_category(selected: DataFrame) -> DataFrame:
    return selected.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


# --- per-request choices --------------------------------------------------------------------------

def draw_count(u: Column, most: int) -> Column:
    """1..most with probability proportional to 2^(most - i), from a number in (0, 1)."""
    m = min(most, 5)
    return F.greatest(F.lit(1), F.ceil(m - F.log2(F.lit(float(2 ** m)) - u * float(2 ** m - 1)))).cast("int")


def weighted_companions(requests: DataFrame, candidates: DataFrame, most: int = 3, seed: int = 42) -> DataFrame:
    """(target, sample_no, label, pick): labels drawn without replacement with weight sqrt(shared).

    ``requests``: target, sample_no; ``candidates``: target, label, shared (top k per target). The smallest
    keys -ln(u)/weight are the draw.
    """
    n = draw_count(hash_uniform(seed, F.col("target"), F.col("sample_no")), most)
    x = requests.withColumn("_n", n).join(candidates, "target")
    key = -F.log(hash_uniform(seed, F.col("target"), F.col("sample_no"), F.col("label"))) / F.sqrt("shared")
    w = Window.partitionBy("target", "sample_no").orderBy(F.col("_k"), "label")
    return (x.withColumn("_k", key).withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= F.col("_n"))
            .select("target", "sample_no", "label", "pick"))


def vary_negatives(requests: DataFrame, pool: DataFrame, n: int = 2, seed: int = 42) -> DataFrame:
    """(target, sample_no, label, pick): n of the pool per request; ``pool``: target, label (top max(10, 4n))."""
    key = hash_order(seed, F.col("target"), F.col("sample_no"), F.col("label"))
    w = Window.partitionBy("target", "sample_no").orderBy(key, "label")
    x = requests.join(pool.select("target", "label"), "target")
    return x.withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= n).select("target", "sample_no", "label", "pick")


def negative_pool_size(n: int, multiplier: int = 4) -> int:
    return max(10, n * multiplier)


def assign_scenario(label: Column, sample_no: Column, scenarios=SCENARIOS, seed: int = 42) -> Column:
    """Scenario of the label's sample 0, 1, ...: a new md5 permutation whenever all have been used."""
    n = len(scenarios)
    cycle = F.floor(sample_no / n).cast("long")
    shuffled = F.array_sort(F.transform(F.array(*[F.lit(s) for s in scenarios]), lambda s: F.struct(
        hash_order(seed, label, cycle, s).alias("k"), s.alias("s"))))
    return F.get(shuffled, F.pmod(sample_no, F.lit(n)).cast("int")).s


def shuffle(df: DataFrame, seed: int = 42, key: str = "sample_id") -> DataFrame:
    """Random row order: a range-partitioned sort by md5."""
    return df.orderBy(hash_order(seed, F.col(key)), key)
