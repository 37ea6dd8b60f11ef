"""Classification against a taxonomy, and bucketing.

A taxonomy is a short list that its author writes by hand, so it is a parameter and becomes part of the
expression: classification is a narrow projection without join or shuffle.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arrays import let
from ..functions.scalars import one_row
from ..functions.text import word_count
from ..functions.vectors import constant_vector, dot

UNCLASSIFIED = "UNCLASSIFIED"

# --- fixed values -----------------------------------------------------------------------------
TYPE_WEIGHTS = {"T": 1.5, "S": 2.0, "K": 2.5, "L": 3.0}
TYPE_THRESHOLDS = {"T": 0.03, "S": 0.05, "K": 0.08, "L": 0.10}
OTHER_WEIGHT, OTHER_THRESHOLD = 1.0, 0.05
RULES = [
    ("S5", ["computer", "software", "programming", "digital", "it"]),
    ("S4", ["management", "führung", "leitung", "projektmanagement"]),
    ("L", ["kommunikation", "sprache", "language"]),
    ("09", ["gesundheit", "medizin", "pflege"]),
    ("05", ["mathematik", "physik", "chemie", "wissenschaft"]),
    ("02", ["kunst", "design", "kreativ"]),
    ("01", ["bildung", "unterricht", "lehre"]),
    ("04", ["wirtschaft", "recht", "verwaltung"]),
]
RULES_ELSE = "99"
CIRCUS = ["zirkus", "circus", "akrobat", "akrobatik", "artist", "varieté", "manege", "dompteur", "clown",
          "jongleur", "jonglieren", "seiltanz", "trapez"]
RELIGION = ["kirche", "religion", "religiös", "geistlich", "pastor", "pfarrer", "priester", "imam", "rabbi",
            "mönch", "nonne", "kloster", "gottesdienst", "predigt", "seelsorge", "liturgie", "sakrament",
            "bibel", "koran", "torah", "spirituell"]
MILITARY = ["militär", "armee", "soldat", "bundeswehr", "offizier", "marine", "luftwaffe", "heer", "kaserne",
            "waffe", "kampf", "krieg", "verteidigung", "strategie militär", "einsatz militär", "truppe",
            "regiment", "bataillon", "kommando"]
# ----------------------------------------------------------------------------------------------


@dataclass
class Category:
    """One taxonomy entry; ``ord`` decides ties."""
    ord: int
    code: str
    keywords: list[str] = field(default_factory=list)
    name: str = ""
    description: str = ""
    vector: list[float] | None = None

    @property
    def text(self) -> str:
        return self.description or " ".join([self.name, *self.keywords])


def categories(rows) -> list[Category]:
    return [Category(*r) for r in rows]


def category_name(code: Column, cats: list[Category]) -> Column:
    """Text before the first colon of the description; an unknown code names itself."""
    out = code
    for c in cats:
        out = F.when(code == c.code, F.substring_index(F.lit(c.description), ":", 1)).otherwise(out)
    return out


def any_of(text: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _best_two(scores: list[Column], cats: list[Category], positive: Column, ratio: float) -> Column:
    """Codes of the best category, plus the second when close; scores are compared as rounded numbers."""
    entries = F.array(*[F.struct((-s).alias("k"), F.lit(c.ord).alias("ord"), F.lit(c.code).alias("code"))
                        for s, c in zip(scores, cats)])
    def choose(kept):
        first, second = F.get(kept, F.lit(0)), F.get(kept, F.lit(1))
        return (F.when(F.size(kept) == 0, F.array(F.lit(UNCLASSIFIED)))
                .when((F.size(kept) > 1) & (-second.k >= -first.k * ratio), F.array(first.code, second.code))
                .otherwise(F.array(first.code)))
    return let(F.array_sort(F.filter(entries, lambda e: positive(-e.k))), choose)


def classify_keywords(query: Column, labels: Column, cats: list[Category]) -> Column:
    """1 or 2 codes: a keyword in the query counts 2, in the joined labels 3; second best from 70 %."""
    def best(t):
        scores = [_sum([F.when(F.contains(t.q, F.lit(k.lower())), 2).otherwise(0)
                        + F.when(F.contains(t.l, F.lit(k.lower())), 3).otherwise(0) for k in c.keywords]) for c in cats]
        return _best_two(scores, cats, lambda s: s > 0, 0.7)
    return let(F.struct(F.lower(query).alias("q"), F.lower(F.array_join(labels, " ")).alias("l")), best)


def classify_semantic(vector: Column, cats: list[Category], threshold: float = 0.3, ratio: float = 0.85) -> Column:
    """1 or 2 codes by dot product with the category vectors."""
    scores = [F.round(dot(vector, constant_vector(c.vector)), 9) for c in cats]
    return _best_two(scores, cats, lambda s: s >= threshold, ratio)


def classify_argmax(vector: Column, cats: list[Category], threshold: float = 0.15, unknown: str = "99") -> Column:
    """Code of the highest dot product; below the threshold ``unknown``."""
    best = F.array_min(F.array(*[F.struct((-F.round(dot(vector, constant_vector(c.vector)), 9)).alias("k"),
                                          F.lit(c.ord).alias("ord"), F.lit(c.code).alias("code")) for c in cats]))
    return F.when(-best.k >= threshold, best.code).otherwise(unknown)


def classify_rules(label: Column, description: Column) -> Column:
    """First rule with a matching substring."""
    text = F.lower(F.concat_ws(" ", label, F.coalesce(description, F.lit(""))))
    out = F.lit(RULES_ELSE)
    for code, terms in reversed(RULES):
        out = F.when(any_of(text, terms), code).otherwise(out)
    return out


def _weighted(low: Column, n: Column, c: Category) -> Column:
    """Score of one category, null below its threshold. ``low``: lower-cased text, ``n``: its words."""
    weight = TYPE_WEIGHTS.get(c.code[:1], OTHER_WEIGHT)
    raw = _sum([F.when(F.contains(low, F.lit(k)), len(k.split()) * weight).otherwise(0.0) for k in c.keywords]) if c.keywords else F.lit(0.0)
    limit = TYPE_THRESHOLDS.get(c.code[:1], OTHER_THRESHOLD)
    return F.when((n > 0) & (raw > 0) & (raw / n >= limit), raw / n)


def score_keywords_weighted(text: Column, cats: list[Category]) -> Column:
    """Array of (code, ord, score), best first: hits x words x type weight / words of the text."""
    def rank(t):
        entries = F.array(*[F.struct((-_weighted(t.low, t.n, c)).alias("k"), F.lit(c.ord).alias("ord"), F.lit(c.code).alias("code")) for c in cats])
        kept = F.array_sort(F.filter(entries, lambda e: e.k.isNotNull()))
        return F.transform(kept, lambda e: F.struct(e.code.alias("code"), e.ord.alias("ord"), (-e.k).alias("score")))
    return let(F.struct(F.lower(text).alias("low"), word_count(text).alias("n")), rank)


def combine_scores(query: Column, label_text: Column, cats: list[Category]) -> Column:
    """Query score + 3 x label score per category, best first, with the contributing sources."""
    def entry(t, c):
        def total(x):
            score = F.coalesce(x.a, F.lit(0.0)) + 3 * F.coalesce(x.b, F.lit(0.0))
            return F.struct(F.when(x.a.isNotNull() | x.b.isNotNull(), -score).alias("k"), F.lit(c.ord).alias("ord"), F.lit(c.code).alias("code"),
                            F.concat_ws("+", F.when(x.a.isNotNull(), "query"), F.when(x.b.isNotNull(), "labels")).alias("sources"))
        return let(F.struct(_weighted(t.q, t.qn, c).alias("a"), _weighted(t.l, t.ln, c).alias("b")), total)

    def rank(t):
        kept = F.array_sort(F.filter(F.array(*[entry(t, c) for c in cats]), lambda e: e.k.isNotNull()))
        return F.transform(kept, lambda e: F.struct(e.code.alias("code"), e.ord.alias("ord"), (-e.k).alias("score"), e.sources.alias("sources")))

    return let(F.struct(F.lower(query).alias("q"), word_count(query).alias("qn"), F.lower(label_text).alias("l"), word_count(label_text).alias("ln")), rank)


def category_distribution(scored: DataFrame, scores: str = "scores", key: str = "sample_id") -> DataFrame:
    """Assignments per category (all of a sample's categories), share within its type, first two samples.

    The two examples come from nested minima, which combine on the map side, not from a collected list.
    """
    rows = scored.select(F.col(key).alias("_id"), F.explode(scores).alias("e")).select("_id", "e.code")
    first = rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("example_1"))
    second = rows.join(first.select("code", "example_1"), "code").where(F.col("_id") > F.col("example_1")).groupBy("code").agg(
        F.min("_id").alias("example_2"))
    w = Window.partitionBy("type")
    return (first.join(second, "code", "left").withColumn("type", F.substring("code", 1, 1))
            .withColumn("type_pct", F.col("n") * 100.0 / F.sum("n").over(w)))


def classified_share(scored: DataFrame, scores: str = "scores") -> DataFrame:
    a = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size(scores) > 0).alias("classified"))
    return a.select("n", "classified", (F.col("n") - F.col("classified")).alias("unclassified"),
                    F.when(F.col("n") > 0, F.col("classified") * 100.0 / F.col("n")).otherwise(0.0).alias("classified_pct"))


def taxonomy_table(spark, cats: list[Category]) -> DataFrame:
    return spark.createDataFrame([(c.ord, c.code, c.name) for c in cats], "ord int, code string, name string")


def underrepresented(dist: DataFrame, taxonomy: DataFrame, n: int = 12) -> DataFrame:
    """The n least covered categories, also those without any sample; ``coverage`` = none or few."""
    x = taxonomy.join(dist.select("code", "n"), "code", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return (x.orderBy("n", "ord").limit(n)
            .select("code", "n", F.when(F.col("n") == 0, "none").otherwise("few").alias("coverage")))


def type_balance(dist: DataFrame) -> DataFrame:
    """Share per type with the dominant and the weakest type and the most common category."""
    t = dist.groupBy("type").agg(F.sum("n").alias("n_type"))
    one = dist.agg(F.max_by("code", F.struct(F.col("n"), F.col("code"))).alias("most_common"), F.sum("n").alias("_all"))
    x = (t.withColumn("_one", one_row(one)).select("*", "_one.*").drop("_one")
         .withColumn("pct", F.col("n_type") * 100.0 / F.col("_all")))
    ends = t.agg(F.max_by("type", F.struct(F.col("n_type"), F.col("type"))).alias("_hi"),
                 F.min_by("type", F.struct(F.col("n_type"), F.col("type"))).alias("_lo"))
    return x.withColumn("_ends", one_row(ends)).select("*", "_ends.*").select(
        "type", "n_type", "pct", "most_common", (F.col("type") == F.col("_hi")).alias("dominant"),
        (F.col("type") == F.col("_lo")).alias("weakest"))


def dominant_category(codes: Column) -> Column:
    """Most frequent code of a sample's positives, first seen on a tie. Input: array of codes in order."""
    entries = F.transform(F.array_distinct(codes), lambda c: F.struct(
        (-F.size(F.filter(codes, lambda x: x == c))).alias("k"), F.array_position(codes, c).alias("p"), c.alias("code")))
    return F.array_min(entries).code


def length_bucket(df: DataFrame, col: str = "query") -> DataFrame:
    """short up to p25, medium up to p75, long above, of the word counts over the whole dataset."""
    x = df.withColumn("words", word_count(F.col(col)))
    p = df.select(word_count(F.col(col)).alias("w")).agg(F.percentile("w", F.array(F.lit(0.25), F.lit(0.75))).alias("_p"))
    return x.withColumn("_p", one_row(p)["_p"]).withColumn(
        "bucket", F.when(F.col("words") <= F.col("_p")[0], "short").when(F.col("words") <= F.col("_p")[1], "medium")
        .otherwise("long")).drop("_p")


def domain_flags(label: Column, description: Column) -> dict[str, Column]:
    text = F.lower(F.concat(label, F.lit(" "), F.coalesce(description, F.lit(""))))
    return {"is_circus": any_of(text, CIRCUS), "is_religious": any_of(text, RELIGION), "is_military": any_of(text, MILITARY)}
