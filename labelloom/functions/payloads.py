"""JSON texts: occupations cells, answers with embedded JSON, prediction payloads."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arrays import let
from .text import strip

PREDICTION = "array<struct<title:string,score:double>>"


def _variant(c: Column) -> Column:
    return F.try_parse_json(c)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def parse_occupations(c: Column) -> Column:
    """Blank -> []; JSON list -> titles or plain strings; other JSON -> []; anything else is split on '|'."""
    return let(_variant(c), lambda v: _occupations(c, v))


def _occupations(c: Column, v: Column) -> Column:
    items = F.try_variant_get(v, "$", "array<variant>")
    names = F.transform(items, lambda x: F.when(
        _kind(x).startswith("OBJECT"), F.try_variant_get(x, "$.title", "string"))
        .when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string")))
    from_json = F.filter(F.transform(names, strip), lambda x: x.isNotNull() & (x != ""))
    from_bars = F.filter(F.transform(F.split(c, r"\|"), strip), lambda x: x != "")
    none = F.expr("cast(array() as array<string>)")
    return (F.when(c.isNull() | (strip(c) == ""), none)
            .when(v.isNull(), from_bars)
            .when(_kind(v).startswith("ARRAY"), from_json)
            .otherwise(none))


def _candidates(c: Column) -> list[Column]:
    none = F.expr("cast(array() as array<string>)")
    found = [F.array(c)]
    for pattern in (r"(?is)```json\s*(.*?)\s*```", r"(?is)```\s*(.*?)\s*```", r"(?is)`([^`]*)`"):
        found.append(F.coalesce(F.regexp_extract_all(c, F.lit(pattern), 1), none))
    found.append(F.coalesce(F.regexp_extract_all(c, F.lit(r"(?s)(\{.*\})"), 1), none))
    # a block opens on a line that starts with '{' (again on every such line) and closes on a later one that ends with '}'
    found.append(F.coalesce(F.regexp_extract_all(
        c, F.lit(r"(?m)^[ \t]*(\{[^\n]*\n(?:(?![ \t]*\{)[^\n]*\n)*?(?![ \t]*\{)[^\n]*\})[ \t\r]*$"), 1), none))
    return found


def json_candidates(c: Column) -> Column:
    """Texts worth parsing, best first: whole, fenced json, fenced, back-ticked, greatest braces, brace lines."""
    return let(c, lambda c: F.transform(F.flatten(F.array(*_candidates(c))), strip))


#: A text that begins like this is no JSON; a failed try to parse it costs far more than this look.
NO_JSON = r"^(?!true|false|null|NaN|INF|Infinity)[A-Za-z]"


def _first_json(c: Column, result) -> Column:
    """``result(text, variant)`` of the first candidate that parses. The text is worked out once, and each regular expression runs only where all candidates before it fail."""
    def parsed(x):
        return let(strip(x), lambda x: F.struct(x.alias("text"), F.when(~x.rlike(NO_JSON), _variant(x)).alias("variant")))

    def first(found):
        return F.get(F.filter(F.transform(found, parsed), lambda p: p.variant.isNotNull()), F.lit(0))
    return let(c, lambda c: let(F.coalesce(*[first(found) for found in _candidates(c)]), result))


def extract_json(c: Column) -> Column:
    """First candidate that parses, as JSON text; null when none does."""
    return _first_json(c, lambda p: p.text)


def response_groups(c: Column) -> Column:
    """``{"groups": [{"labels": [...]}]}`` inside an answer -> array<array<string>>; null when unusable."""
    return _first_json(c, lambda p: _groups(p.variant))


def _groups(v: Column) -> Column:
    groups = F.try_variant_get(v, "$.groups", "array<variant>")
    return F.transform(
        F.filter(groups, lambda g: _kind(g).startswith("OBJECT")),
        lambda g: F.filter(
            F.transform(F.coalesce(F.try_variant_get(g, "$.labels", "array<variant>"),
                                   F.expr("cast(array() as array<variant>)")),
                        lambda x: F.when(_kind(x) == "STRING", F.try_variant_get(x, "$", "string"))),
            lambda s: s.isNotNull()))


def _pairs(items: Column, *names: str) -> Column:
    """(title, score) of the objects that carry a name field and a score; others are ignored."""
    def one(x):
        title = F.coalesce(*[F.try_variant_get(x, f"$.{n}", "string") for n in names])
        return F.struct(title.alias("title"), F.try_variant_get(x, "$.score", "double").alias("score"))
    return F.filter(F.transform(items, one), lambda p: p.title.isNotNull() & p.score.isNotNull())


def parse_predictions_json(payload: Column) -> Column:
    """Four known payload shapes -> array of (title, score)."""
    return let(_variant(payload), _predictions)


def _predictions(v: Column) -> Column:
    def at(path):
        return F.try_variant_get(v, path, "array<variant>")

    skills = F.transform(at("$.skills"), lambda x: F.try_variant_get(x, "$", "string"))
    scores = F.transform(at("$.scores"), lambda x: F.try_variant_get(x, "$", "double"))
    n = F.least(F.size(skills), F.size(scores))
    zipped = F.filter(
        F.zip_with(F.slice(skills, F.lit(1), n), F.slice(scores, F.lit(1), n),
                   lambda a, b: F.struct(a.alias("title"), b.alias("score"))),
        lambda p: p.title.isNotNull() & p.score.isNotNull())
    return (F.when(at("$.predictions").isNotNull(), _pairs(at("$.predictions"), "skill", "name"))
            .when(at("$.skills").isNotNull() & at("$.scores").isNotNull(), zipped)
            .when(at("$").isNotNull(), _pairs(at("$"), "skill", "name"))
            .when(at("$.results").isNotNull(), _pairs(at("$.results"), "skill"))
            .otherwise(F.expr(f"cast(array() as {PREDICTION})")))


def parse_predictions_text(payload: Column) -> Column:
    """Lines ``title<TAB>score`` or ``title,score``; lines without a number are skipped."""
    def one(line):
        parts = F.when(F.contains(line, F.lit("\t")), F.split(line, "\t")).when(
            F.contains(line, F.lit(",")), F.split(line, ","))
        return F.struct(strip(F.get(parts, F.lit(0))).alias("title"),
                        strip(F.get(parts, F.lit(1))).try_cast("double").alias("score"))
    return F.filter(F.transform(F.split(strip(payload), "\n"), one),
                    lambda p: p.title.isNotNull() & p.score.isNotNull())


def parse_nested_predictions(payload: Column) -> Column:
    """``learning_outcomes.skills[].{title,score}``, highest score first (ties keep their order)."""
    items = F.try_variant_get(_variant(payload), "$.learning_outcomes.skills", "array<variant>")
    pairs = _pairs(items, "title")
    keyed = F.transform(pairs, lambda p, i: F.struct((-p.score).alias("k"), i.alias("i"), p.alias("p")))
    return F.coalesce(F.transform(F.array_sort(keyed), lambda x: x.p), F.expr(f"cast(array() as {PREDICTION})"))


def positional_scores(payload: Column, name: str = "name", required: str = "conceptUrl") -> Column:
    """List without scores -> score 1 - index/length; items without both fields are ignored."""
    items = F.try_variant_get(_variant(payload), "$", "array<variant>")
    scored = F.transform(items, lambda x, i: F.struct(
        F.when(F.try_variant_get(x, f"$.{required}", "string").isNotNull(),
               F.try_variant_get(x, f"$.{name}", "string")).alias("title"),
        (F.lit(1.0) - i / F.size(items)).alias("score")))
    return F.coalesce(F.filter(scored, lambda p: p.title.isNotNull()), F.expr(f"cast(array() as {PREDICTION})"))
