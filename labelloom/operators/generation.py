"""Requests for generated texts, acceptance of the answers, splitting and compressing, rounds for rare labels."""
from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arrays import chunk_sequential, let, negatives_for, or_empty
from ..functions.hashing import hash_order, hash_uniform
from ..functions.payloads import response_groups
from ..functions.prompts import rare_prompt, new_skill_prompt
from ..functions.text import contains_any, cut_to_length, strip, strip_lead_in
from ..session import cut_lineage
from .balance import SCENARIOS, assign_scenario, vary_negatives, weighted_companions
from .relations import label_index
from .stats import label_frequency, rare_labels

# --- fixed values -----------------------------------------------------------------------------
SOURCE_RARE, SOURCE_NEW, SOURCE_NEW_MULTI = "llm", "llm_new_skill", "llm_new_skill_multi"
DRY_TEXT, DRY_COMPRESS, DRY_GROUP = "[DryRun] Beispieltext ", "[DryRun] komprimiert: ", "[DryRun] Kurztext für "
# ----------------------------------------------------------------------------------------------


def _empty(kind: str = "array<string>") -> Column:
    return F.expr(f"cast(array() as {kind})")


# --- asking ---------------------------------------------------------------------------------------

def dry_run_text(hint: Column, number: Column | int = 1) -> Column:
    n = F.lit(number) if isinstance(number, int) else number
    return F.concat(F.lit(DRY_TEXT), n.cast("string"), F.lit(" zu "), F.coalesce(hint, F.lit("Kompetenz")))


def dry_run_compress(labels: Column, strategy: str = "compress") -> Column:
    head = DRY_GROUP if strategy in ("split", "label_group") else DRY_COMPRESS
    return F.concat(F.lit(head), F.array_join(labels, ", "))


def generate(requests: DataFrame, backend: Callable[[], Callable[[str], str]] | None = None, dry_text: Column | None = None,
             tries: int = 4, delay: float = 2.0, factor: float = 1.5, prompt: str = "prompt", in_flight: int = 8) -> DataFrame:
    """Requests + (text, status, error). ``backend()`` opens one client per Python worker and returns prompt -> text; it must bear ``in_flight`` calls at a time.

    A partition keeps that many calls in flight: rows are taken up only as calls come back, and answers are handed on in their order, so neither requests nor
    answers pile up. Without a backend it is a dry run: a column expression. A request that fails ``tries`` times is marked
    'failed' with the reason of the last try and does not stop the job. Write the answers before using them twice: a backend need not repeat itself
    (``generate_stored`` does).
    """
    if backend is None:
        return requests.withColumns({"text": dry_text, "status": F.lit("ok"), "error": F.lit(None).cast("string")})
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields] + ["text string", "status string", "error string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client: list = []

        def call(text: str) -> tuple[str | None, str, str | None]:
            wait, reason = delay, None
            for attempt in range(tries):
                try:
                    return client[0](text), "ok", None
                except Exception as e:
                    reason = f"{type(e).__name__}: {e}"
                    if attempt + 1 < tries:
                        time.sleep(wait)
                        wait *= factor
            return None, "failed", reason

        with ThreadPoolExecutor(max(1, in_flight)) as pool:
            for batch in batches:
                if not len(batch):
                    continue
                if not client:
                    client.append(backend())
                answers, waiting = [], deque()
                for text in batch.column(batch.schema.get_field_index(prompt)).to_pylist():
                    if len(waiting) >= in_flight:
                        answers.append(waiting.popleft().result())
                    waiting.append(pool.submit(call, text))
                answers += [f.result() for f in waiting]
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.string()) for c in zip(*answers)]], names=[*batch.schema.names, "text", "status", "error"])

    spread = requests.repartition(F.xxhash64(F.col(prompt)))  # small rows would else be read, and asked for, by a single task
    return spread.mapInArrow(run, schema)


def generate_stored(requests: DataFrame, backend: Callable[[], Callable[[str], str]], path: str, key: str = "request_id", rounds: int = 10, **options) -> DataFrame:
    """``generate`` through a store of answers at ``path`` (Parquet, shared): requests whose key has an answer there are not asked again.

    Requests are asked in ``rounds`` parts by hash of the key, and each part is appended by Spark's commit protocol when it is complete: a lost executor asks again for its
    own tasks only, and a job that was ended goes on where it was. Failed requests are not stored, so the next call asks them again. Keys are unique.
    """
    spark = requests.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    kind = f"`{key}` {requests.schema[key].dataType.simpleString()}, text string, status string, error string"

    def stored() -> DataFrame:
        return spark.read.schema(kind).parquet(path) if fs.exists(hadoop) else spark.createDataFrame([], kind)

    failed = None
    for i in range(rounds):
        part = requests.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == i).join(stored().select(key), key, "left_anti")
        if part.isEmpty():
            continue
        answers = cut_lineage(generate(part, backend, **options).select(key, "text", "status", "error"))
        answers.where("status = 'ok'").write.mode("append").parquet(path)
        bad = answers.where("status <> 'ok'")
        failed = bad if failed is None else failed.unionByName(bad)
    answers = stored() if failed is None else stored().unionByName(failed)
    return requests.join(answers, key, "left")


def prompt_log(requests: DataFrame, path: str) -> None:
    """Append the request rows (label, scenario, attempt, focus, avoid, prompt) with their time."""
    requests.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


# --- splitting and compressing --------------------------------------------------------------------

def reconcile_groups(labels: Column, response: Column, n: int) -> Column:
    """Answer with groups -> groups of own labels, each once; null when the answer is unusable.

    Forgotten labels join the last group when they fit, otherwise they form new groups of n. Few labels are
    one group without asking. All arrays are those of one sample.
    """
    clean = F.filter(labels, lambda x: strip(x) != "")

    def finish(clean, once, rest):
        fits = (F.size(once) > 0) & (F.size(F.element_at(once, -1)) + F.size(rest) <= n)
        joined = F.concat(F.slice(once, F.lit(1), F.size(once) - 1), F.array(F.concat(F.element_at(once, -1), rest)))
        out = F.when(F.size(rest) == 0, once).when(fits, joined).otherwise(F.concat(once, chunk_sequential(rest, n)))
        return F.when(F.size(once) + F.size(rest) > 0, out)

    def first_time(own):
        kept = F.transform(own, lambda g, i: F.array_except(g, F.flatten(F.slice(own, F.lit(1), i))))
        return F.filter(kept, lambda g: F.size(g) > 0)

    def asked(clean, groups):
        own = F.transform(groups, lambda g: F.array_distinct(F.filter(F.transform(g, strip), lambda x: F.array_contains(clean, x))))
        return let(own, lambda own: let(first_time(own), lambda once: let(
            F.filter(clean, lambda x: ~F.array_contains(F.flatten(once), x)), lambda rest: finish(clean, once, rest))))

    return let(clean, lambda clean: F.when(F.size(clean) <= n, F.array(clean)).otherwise(
        let(response_groups(response), lambda groups: F.when(groups.isNotNull(), asked(clean, groups)))))


def split_by_group(samples: DataFrame, groups: str = "groups", strategy: str = "label_group", keep=("sample_id",)) -> DataFrame:
    """One row per non-empty group: pos = the group, neg = sorted distinct(old negatives + labels of other groups)."""
    # the outer form: for the plain one Spark infers a filter that works the groups out again below
    x = samples.select(*keep, "query", or_empty(F.col("neg")).alias("_neg"), F.col(groups).alias("_all"), F.posexplode_outer(groups).alias("group_index", "_g"))
    focus = F.array_distinct("_g")
    avoid = F.filter(F.flatten("_all"), lambda l: ~F.array_contains(F.col("_g"), l))
    return x.where(F.size("_g") > 0).select(
        *keep, "query", focus.alias("pos"), F.array_sort(F.array_distinct(F.concat("_neg", avoid))).alias("neg"),
        F.array_distinct(avoid).alias("avoid"), F.lit(strategy).alias("augmentation"), F.col("group_index").cast("long").alias("group_index"),
        F.size(focus).cast("long").alias("group_size"), F.size("_all").cast("long").alias("total_groups"))


def compress_result(samples: DataFrame, answers: DataFrame, key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """(compressed, failed): the query is replaced; an empty or missing answer is an error row."""
    x = samples.join(answers.select(key, strip(F.col("text")).alias("_t")), key, "left")
    ok = F.coalesce(F.col("_t"), F.lit("")) != ""
    good = x.where(ok).withColumn("query", F.col("_t")).withColumn("augmentation", F.lit("compress")).drop("_t")
    return good, x.where(~ok).drop("_t").withColumn("error", F.lit("empty answer"))


def forbidden_mentions(text: Column, labels: Column) -> Column:
    """Warning flag: the text mentions a label of another group."""
    return contains_any(text, labels)


# --- acceptance -----------------------------------------------------------------------------------

def accept(candidates: DataFrame, limit: int, existing: DataFrame | None = None) -> DataFrame:
    """Candidates + (accepted, reject_reason, first_survivor).

    ``candidates``: request_id, cand_no, text, forbidden and optionally focus (labels); ``existing``: text, with request_id if each
    request has its own known texts. Repeats are compared by lower case, inside a request: the first stays. Between requests only the
    first survivors count, and only where two requests share a focus label: the smaller request_id keeps the text, the other goes on to
    its next candidate. Texts are joined by digest, only those that are good so far; minima combine on the map side.
    """
    base = strip_lead_in(strip(F.col("text")))
    keys = ["request_id", "cand_no"]
    x = candidates.withColumn("_base", base).withColumn("_cut", cut_to_length(base, limit))
    first = (F.when(F.col("_base") == "", "blank").when(F.col("_cut").isNull(), "too long")
             .when(contains_any(F.col("_cut"), or_empty(F.col("forbidden"))), "forbidden term"))
    # texts are judged once; from here on only digests move
    judged = cut_lineage(x.select(*keys, first.alias("_r1"), F.md5(F.lower("_cut")).alias("_key"), *[c for c in ["focus"] if c in candidates.columns]))
    good = judged.where(F.col("_r1").isNull()).drop("_r1")
    once = good.groupBy("request_id", "_key").agg(F.min("cand_no").alias("_w"))
    if existing is not None:
        on = [c for c in ["request_id"] if c in existing.columns] + ["_key"]
        known = existing.withColumn("_key", F.md5(F.lower("text"))).select(*on).distinct().withColumn("_known", F.lit(True))
        once = once.join(known, on, "left")
    else:
        once = once.withColumn("_known", F.lit(None).cast("boolean"))
    good = good.join(once, ["request_id", "_key"]).withColumn(
        "_r2", F.when(F.col("_known"), "existing text").when(F.col("cand_no") > F.col("_w"), "repeated text")).drop("_known", "_w")
    good = _settle_requests(good) if "focus" in candidates.columns else cut_lineage(good)
    best = good.where(F.col("_r2").isNull()).groupBy("request_id").agg(F.min("cand_no").alias("_first"))
    verdict = judged.select(*keys, "_r1").join(good.select(*keys, "_r2"), keys, "left").join(best, "request_id", "left")
    reason = F.coalesce("_r1", "_r2")
    return candidates.join(verdict, keys, "left").select(
        *candidates.columns, F.when(reason.isNull(), cut_to_length(base, limit)).alias("accepted"), reason.alias("reject_reason"),
        (reason.isNull() & F.coalesce(F.col("cand_no") == F.col("_first"), F.lit(False))).alias("first_survivor"))


def _settle_requests(good: DataFrame) -> DataFrame:
    """Rejects first survivors that a smaller request with a common focus label has already, until none is left. A round only decides
    against requests that are not in dispute themselves."""
    good = cut_lineage(good)
    while True:
        alive = good.where(F.col("_r2").isNull())
        best = alive.groupBy("request_id").agg(F.min_by(F.struct("cand_no", "_key", "focus"), "cand_no").alias("s"))
        each = best.select("request_id", "s.cand_no", "s._key", F.explode("s.focus").alias("label"))
        owner = each.groupBy("label", "_key").agg(F.min("request_id").alias("_owner"))
        lost = cut_lineage(each.join(owner, ["label", "_key"]).where("request_id > _owner").groupBy("request_id", "cand_no").agg(F.min("_owner").alias("_owner")))
        if lost.isEmpty():
            return good
        decided = lost.join(lost.select(F.col("request_id").alias("_owner")).distinct(), "_owner", "left_anti").select("request_id", "cand_no", F.lit("repeated text").alias("_r3"))
        good = cut_lineage(good.join(decided, ["request_id", "cand_no"], "left").withColumn("_r2", F.coalesce("_r2", "_r3")).drop("_r3"))


# --- rare labels ----------------------------------------------------------------------------------

def focus_labels(samples: DataFrame, deficits: DataFrame, max_group: int = 3, seed: int = 42) -> DataFrame:
    """(label, sample_id, group_labels, neg, focus) for each label with a deficit.

    Source sample = most other deficit labels, then most labels, then first; focus = the label plus
    1..max-1 of the sample's other deficit labels in md5 order. Only rows of deficit labels are formed.
    """
    s = samples.select("sample_id", "row_no", F.array_distinct("pos").alias("group_labels"), "neg")
    lacking = (s.select("sample_id", F.posexplode("group_labels").alias("i", "label")).join(deficits.select("label"), "label", "left_semi")
               .groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "label"))), lambda x: x.label).alias("lacking")))
    rows = s.join(lacking, "sample_id").withColumn("label", F.explode("lacking"))
    first = F.struct((-F.size("lacking")).alias("a"), (-F.size("group_labels")).alias("b"), F.col("row_no").alias("r"))
    best = rows.groupBy("label").agg(F.min_by(F.struct("sample_id", "group_labels", or_empty(F.col("neg")).alias("neg"), "lacking"), first).alias("s"))
    x = deficits.select("label").join(best, "label", "left").select(
        "label", "s.sample_id", F.coalesce("s.group_labels", F.array("label")).alias("group_labels"),
        or_empty(F.col("s.neg")).alias("neg"), or_empty(F.col("s.lacking")).alias("lacking"))
    others = F.transform(F.array_sort(F.transform(F.filter("lacking", lambda l: l != F.col("label")), lambda l: F.struct(
        hash_order(seed, F.col("label"), l).alias("k"), l.alias("l")))), lambda t: t.l)
    x = x.withColumn("_o", others)
    most = F.least(F.size("_o"), F.lit(max(1, max_group) - 1))
    extra = F.when(most > 1, 1 + F.floor(hash_uniform(seed, F.col("label")) * most)).otherwise(most).cast("int")
    return x.select("label", "sample_id", "group_labels", "neg", F.concat(F.array("label"), F.slice("_o", F.lit(1), extra)).alias("focus"))


def label_context(requests: DataFrame, samples: DataFrame, skills: DataFrame, named: bool = False) -> tuple[DataFrame, DataFrame]:
    """(context per request, queries per request) of the focus labels.

    Context: descriptions in focus order (joined by a blank, or ``label: description`` by ' | '), distinct
    occupations in order. The queries stay a long table (request_id, query).
    """
    f = requests.select("request_id", F.posexplode("focus").alias("i", "label"))
    d = f.join(skills.select("label", "description", "occupations"), "label", "left")
    text = F.nullif(strip(F.col("description")), F.lit(""))
    text = F.when(text.isNotNull(), F.concat_ws(": ", "label", text)) if named else text
    item = F.struct("i", text.alias("t"), or_empty(F.col("occupations")).alias("o"))
    g = d.groupBy("request_id").agg(F.array_sort(F.collect_list(item)).alias("x"))
    descriptions = F.filter(F.transform("x", lambda e: e.t), lambda t: t.isNotNull())
    occupations = F.filter(F.transform(F.flatten(F.transform("x", lambda e: e.o)), strip), lambda o: o != "")
    context = g.select("request_id", F.when(F.size(descriptions) > 0, F.array_join(descriptions, " | " if named else " ")).alias("description"),
                       F.array_distinct(occupations).alias("occupations"))
    queries = (f.join(label_index(samples).queries, "label").select("request_id", "query").distinct())
    return context, queries


def synthetic_record(query: Column, pos: Column, neg: Column, source: Column, label: Column, scenario: Column) -> Column:
    return F.struct(query.alias("query"), pos.alias("pos"), neg.alias("neg"),
                    F.struct(source.alias("source"), label.alias("label"), scenario.alias("scenario")).alias("meta"))


def rare_requests(samples: DataFrame, deficits: DataFrame, skills: DataFrame, attempt: int = 0, max_group: int = 3,
                  max_negatives: int = 8, max_chars: int = 400, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(requests, queries): one request per label with a deficit, with focus, avoid list, scenario and prompt."""
    f = focus_labels(samples, deficits, max_group, seed + attempt)
    unused = F.array_except("group_labels", "focus")
    r = f.select(F.concat_ws("#", F.lit(attempt), "label").alias("request_id"), "label", "focus",
                 negatives_for(unused, F.col("neg"), F.col("focus"), max_negatives).alias("avoid"),
                 assign_scenario(F.col("label"), F.lit(attempt), SCENARIOS, seed).alias("scenario"), F.lit(attempt).alias("attempt"))
    context, queries = label_context(r, samples, skills)
    prompt = rare_prompt(F.col("description"), or_empty(F.col("occupations")), F.col("focus"), F.col("scenario"), F.col("avoid"),
                         max_chars, F.col("request_id"))
    return r.join(context, "request_id", "left").withColumn("prompt", prompt), queries


@dataclass
class Filled:
    samples: DataFrame   # query, pos, neg, label, scenario
    leftover: DataFrame  # label, deficit still open
    rounds: int


def fill_deficits(samples: DataFrame, skills: DataFrame, minimum: int, backend=None, attempts: int = 4, max_group: int = 3,
                  max_negatives: int = 8, max_chars: int = 400, seed: int = 42, log_path: str | None = None) -> Filled:
    """Generate for rare labels until none is below the minimum.

    A round asks for open labels at once: of the requests, in md5 order, those whose focus labels would not get more texts than they
    lack. It accepts and recounts. Each label gets one text of its own at most in a round, so there are as many rounds as the largest
    deficit, times ``attempts`` for answers that are refused; what is then still open is ``leftover``. Answers
    are checkpointed, so a lost executor does not ask again for what later rounds already use.
    """
    open_labels = cut_lineage(rare_labels(label_frequency(samples), minimum).select("label", "deficit"))
    most = open_labels.agg(F.max("deficit")).first()[0] or 0
    made, rounds = None, 0
    current = samples.select("sample_id", "row_no", "query", "pos", "neg")
    while rounds < attempts * most and not open_labels.isEmpty():
        requests, queries = rare_requests(current, open_labels, skills, rounds, max_group, max_negatives, max_chars, seed)
        requests = cut_lineage(within_deficits(requests, open_labels, seed + rounds))
        if log_path:
            prompt_log(requests, log_path)
        answers = cut_lineage(generate(requests, backend, dry_run_text(F.array_join("focus", " "), rounds + 1)))
        taken = queries.join(requests.select("request_id"), "request_id", "left_semi").select("request_id", F.col("query").alias("text"))
        if made is not None:
            own = requests.select("request_id", F.explode("focus").alias("label"))
            taken = taken.unionByName(own.join(made.select(F.explode("pos").alias("label"), F.col("query").alias("text")), "label").select("request_id", "text"))
        cand = answers.where("status = 'ok'").select("request_id", F.lit(1).alias("cand_no"), "text", F.col("avoid").alias("forbidden"), "focus")
        good = accept(cand, max_chars, taken).where("first_survivor").select("request_id", F.col("accepted").alias("query"))
        new = cut_lineage(answers.join(good, "request_id").select(
            "query", F.col("focus").alias("pos"), F.col("avoid").alias("neg"), "label", "scenario", F.lit(SOURCE_RARE).alias("source")))
        made = new if made is None else made.unionByName(new)
        gained = new.select(F.explode("pos").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("g"))
        open_labels = cut_lineage(open_labels.join(gained, "label", "left").select(
            "label", (F.col("deficit") - F.coalesce("g", F.lit(0))).alias("deficit")).where("deficit > 0"))
        rounds += 1
    if made is None:
        made = samples.sparkSession.createDataFrame([], "query string, pos array<string>, neg array<string>, label string, scenario string, source string")
    return Filled(made, open_labels, rounds)


def within_deficits(requests: DataFrame, deficits: DataFrame, seed: int) -> DataFrame:
    """The requests of which, for every focus label, no more come before them in md5 order than the label lacks. At least one stays."""
    order = hash_order(seed, F.col("request_id"))
    each = requests.select("request_id", F.explode("focus").alias("label")).withColumn("_k", order)
    nth = F.row_number().over(Window.partitionBy("label").orderBy("_k", "request_id"))
    over = each.withColumn("_n", nth).join(deficits.select("label", "deficit"), "label").where("_n > deficit")
    return requests.join(over.select("request_id").distinct(), "request_id", "left_anti")


# --- new labels -----------------------------------------------------------------------------------

def new_label_requests(targets: DataFrame, skills: DataFrame, per_label: int = 3, companions: DataFrame | None = None,
                       negatives: DataFrame | None = None, most: int = 3, n_neg: int = 2, max_chars: int = 400, seed: int = 42) -> DataFrame:
    """One request per (target, sample_no): scenario, positives, negatives, merged context, prompt, source.

    ``companions``: target, label, shared (omit for the single-label mode); ``negatives``: target, label, the pool
    of group_hard_negatives with ``negative_pool_size(n_neg)`` entries.
    """
    r = targets.select(F.col("label").alias("target"), F.explode(F.sequence(F.lit(0), F.lit(per_label - 1))).alias("sample_no"))
    r = r.withColumn("scenario", assign_scenario(F.col("target"), F.col("sample_no"), SCENARIOS, seed))
    keys = ["target", "sample_no"]

    def listed(rows, name):
        return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pick", "label"))), lambda x: x.label).alias(name))

    if companions is not None:
        r = r.join(listed(weighted_companions(r.select(*keys), companions, most, seed), "_c"), keys, "left")
    else:
        r = r.withColumn("_c", _empty())
    if negatives is not None:
        r = r.join(listed(vary_negatives(r.select(*keys), negatives, n_neg, seed), "_n"), keys, "left")
    else:
        r = r.withColumn("_n", _empty())
    r = r.select("target", "sample_no", "scenario", F.concat(F.array("target"), or_empty(F.col("_c"))).alias("focus"),
                 or_empty(F.col("_n")).alias("negatives"), F.concat_ws("#", "target", "sample_no").alias("request_id"))
    d = r.select("request_id", F.posexplode("focus").alias("i", "label")).join(skills.select("label", "description", "occupations"), "label", "left")
    item = F.struct("i", F.when(F.coalesce("description", F.lit("")) != "", F.concat_ws(": ", "label", "description")).alias("t"),
                    or_empty(F.col("occupations")).alias("o"))
    g = d.groupBy("request_id").agg(F.array_sort(F.collect_list(item)).alias("x"))
    parts = F.filter(F.transform("x", lambda e: e.t), lambda t: t.isNotNull())
    context = g.select("request_id", F.when(F.size(parts) > 0, F.array_join(parts, " | ")).alias("description"),
                       F.array_distinct(F.flatten(F.transform("x", lambda e: e.o))).alias("occupations"))
    out = r.join(context, "request_id")
    many = F.size("focus") > 1
    return out.select("*", F.when(many, SOURCE_NEW_MULTI).otherwise(SOURCE_NEW).alias("source"),
                      F.array_join(F.slice("focus", 1, 3), " + ").alias("hint"),
                      new_skill_prompt(F.col("description"), F.col("occupations"), F.col("focus"), F.col("scenario"), F.col("negatives"),
                                       max_chars, F.col("request_id")).alias("prompt"))
