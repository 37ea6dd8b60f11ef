"""Text columns: every function is Column -> Column and stays inside code generation."""
from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F

from .arrays import let

# --- fixed values -----------------------------------------------------------------------------
# Blanks on which words are split (all Unicode blanks, not only the ASCII ones).
BLANK = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
URL_PATTERN = r"http\S+|www\S+|https\S+"
MAIL_PATTERN = r"\S+@\S+"
TOKENS_PER_WORD = 1.3
LEAD_INS = ("Teilnehmende lernen in diesem Kurs:", "Suche nach:")
BULLET_CHARS = "-•*1234567890. "
# ----------------------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Trim every Unicode blank at both ends."""
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{BLANK}+$", "")


def words(c: Column) -> Column:
    """Blank-separated words; an empty or blank text has none."""
    return F.filter(F.split(c, rf"{BLANK}+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    """Number of words, counted as runs of non-blank characters."""
    return F.regexp_count(c, F.lit(r"[^\s\x0B\x1c-\x1f\x85\p{Z}]+")).cast("long")


def clean_text(c: Column) -> Column:
    """Lower, drop links, drop mail addresses, collapse blanks, trim, in this order."""
    no_links = F.regexp_replace(F.lower(c), URL_PATTERN, "")
    no_mails = F.regexp_replace(no_links, MAIL_PATTERN, "")
    return strip(F.regexp_replace(no_mails, rf"{BLANK}+", " "))


def with_prefix(c: Column, role: str = "query", enabled: bool = True, model: str | None = None,
                instruction: str | None = None) -> Column:
    """Role prefix of asymmetric encoders, on by flag or when the model name contains 'e5'."""
    if instruction is not None:
        return F.concat(F.lit(instruction), c)
    if model is not None:
        enabled = "e5" in model.lower()
    prefix = {"query": "query: ", "passage": "passage: "}[role]
    return F.concat(F.lit(prefix), c) if enabled else c


def skill_text(label: Column, description: Column) -> Column:
    """``label: description``, or the label alone without a description."""
    return F.when(F.coalesce(description, F.lit("")) != "", F.concat_ws(": ", label, description)).otherwise(label)


def sample_text(query: Column, pos: Column) -> Column:
    return F.concat(query, F.lit(" "), F.array_join(pos, " "))


def estimated_tokens(c: Column) -> Column:
    """Default token count where no tokenizer is injected: words x 1.3, cut to an integer."""
    return F.floor(word_count(c) * F.lit(TOKENS_PER_WORD)).cast("long")


def token_count(c: Column, tokenizer=None, max_length: int | None = None) -> Column:
    """Encoder tokens incl. special tokens, truncated at the model maximum.

    ``tokenizer`` is a callable text -> number of tokens; it runs in Arrow batches.
    """
    if tokenizer is None:
        n = estimated_tokens(c)
    else:
        @F.pandas_udf("long")
        def count(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: tokenizer(t) if t is not None else 0).astype("int64")

        n = count(c)
    return n if max_length is None else F.least(n, F.lit(max_length).cast("long"))


def query_traits(c: Column) -> dict[str, Column]:
    """Length and word buckets, flags and complexity of a query text."""
    chars = F.length(c).cast("long")
    n = word_count(c)
    # a word longer than 8 characters
    long_words = F.regexp_count(c, F.lit(r"[^\s\x0B\x1c-\x1f\x85\p{Z}]{9,}")).cast("long")
    ratio = long_words / F.greatest(n, F.lit(1))
    return {
        "char_length": chars,
        "word_count": n,
        "length_category": F.when(chars < 100, "Short (50-100 chars)")
        .when(chars < 200, "Medium (100-200 chars)")
        .when(chars < 400, "Long (200-400 chars)").otherwise("Very Long (> 400 chars)"),
        "word_category": F.when(n < 10, "Few Words (5-10)")
        .when(n < 20, "Moderate Words (10-20)")
        .when(n < 40, "Many Words (20-40)").otherwise("Very Many Words (> 40)"),
        "complexity_level": F.when(ratio < 0.1, "Simple").when(ratio < 0.3, "Moderate").otherwise("Complex"),
        "has_punctuation": c.rlike("[.!?;:]"),
        "has_numbers": c.rlike(r"\p{Nd}"),
        "has_special_chars": c.rlike(r"[^\p{L}\p{N}_\s\x0B\x1c-\x1f\x85\p{Z}.!?;:,\-]"),
        "complexity_ratio": ratio,
    }


def positive_count_bucket(n: Column) -> Column:
    return (F.when(n == 1, "Single (1)").when(n <= 3, "Few (2-3)")
            .when(n <= 5, "Several (4-5)").otherwise("Many (6-10)"))


def route(tokens: Column, n_pos: Column, limit: int = 320, split_over: int = 3, long_tokens: int = 700,
          always_split_over: int = 5) -> Column:
    """keep / split / compress decision for a query."""
    split = ((n_pos > split_over) | ((tokens >= long_tokens) & (n_pos > 1)) | (n_pos > always_split_over))
    return F.when(tokens <= limit, "keep").when(split, "split").otherwise("compress")


def strip_lead_in(c: Column) -> Column:
    """Remove one known lead-in, then the blanks after it."""
    def cut(x):
        out = x
        for prefix in reversed(LEAD_INS):
            rest = F.regexp_replace(F.substring(x, len(prefix) + 1, 2147483647), rf"^{BLANK}+", "")
            out = F.when(x.startswith(prefix), rest).otherwise(out)
        return out
    return let(c, cut)


def bullets(c: Column) -> Column:
    """Lines of a bullet list without their markers; blank lines are dropped."""
    lines = F.split(c, r"\r\n|[\n\r\x0B\f\x1c-\x1e\x85  ]")
    bare = F.transform(lines, lambda x: F.regexp_replace(strip(x), r"^[\-•*0-9. ]+", ""))
    return F.filter(bare, lambda x: x != "")


def cut_to_length(c: Column, limit: int) -> Column:
    """Shorten an over-long text at the last blank before ``limit``; null when that leaves too little."""
    def finish(bare):
        dotted = strip(F.when(bare.endswith("."), bare).otherwise(F.concat(bare, F.lit("."))))
        fits = (bare != "") & (F.length(bare) >= limit * 0.6) & (F.length(dotted) <= limit)
        return F.when(fits, dotted)

    def shorten(head):
        at_blank = F.when(F.instr(head, " ") > 0, F.regexp_replace(head, r" [^ ]*$", "")).otherwise(head)
        return let(F.regexp_replace(at_blank, r"[,;:\-]+$", ""), finish)

    return let(c, lambda x: F.when(F.length(x) <= limit, x).otherwise(let(rstrip(F.substring(x, 1, limit)), shorten)))


def contains_any(text: Column, terms: Column) -> Column:
    """Case-insensitive: does the text contain one of the (non-empty) terms."""
    low = F.lower(text)
    return F.exists(terms, lambda t: (t != "") & F.contains(low, F.lower(t)))
