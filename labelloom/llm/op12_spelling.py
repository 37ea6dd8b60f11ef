"""Spelling variants: words at one edit from each other, found by probing generated edits against Bloom filters of the vocabulary.

Words are counted by Spark's own functions. The vocabulary goes into one blocked Bloom filter for each word length, all together of at most 16 MB,
which is broadcast. Every word generates its deletions and, towards larger letters, its replacements; as nearness has no direction, an insertion is the
deletion seen from the longer word, and a replacement is found from the word with the smaller letter. Hashes of edits follow from the word's
polynomial hash by one term, so an edit is spelled out only if its filter holds it. Only those positives are shuffled, to an equi-join with the
vocabulary that removes the false ones; a fuller filter costs more positives, never a result.

Forms are followed from the words without a form downwards, one join a round: a form has at least twice the occurrences, so rounds grow
with the logarithm of the largest count, and a word is the form of no more words than it has neighbours, so no key is hot.

Null and empty texts have no words. A null doc_id reads as empty text in the checksum. Repeated rows count again. Empty tables give no rows. Other columns of the
documents are not read, so their names cannot clash. Words of any length are handled whole.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from labelloom.llm import bloom
from labelloom.llm.common import arrow, column
from labelloom.llm.words import powers
from labelloom.session import cut_lineage

LEAST_LENGTH, LEAST_COUNT, EVERY = 5, 3, 97
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Edits that one numpy step hashes.
STEP = 1 << 20


def runs(text: Column) -> Column:
    """Array of the letter runs of a text, A-Z folded."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit("([a-z\\u00C0-\\u00FF]+)"), F.lit(1))


def slipped(doc_id: Column, run: Column, every: int = EVERY) -> Column:
    """The run, or the run without one letter where ``every`` divides the checksum of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n): occurrences of every word of enough letters and occurrences; combined on the map side."""
    words = docs.select(F.col(doc_id).alias("i"), F.explode(runs(F.col(text))).alias("run")).select(slipped(F.col("i"), F.col("run"), every).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, indices, letters as a matrix of bytes) of words; every letter is one byte of Latin-1."""
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths).tolist():
        some = np.flatnonzero(lengths == n)
        yield n, some, np.frombuffer("".join([words[i] for i in some.tolist()]).encode("latin-1"), np.uint8).reshape(len(some), n)


def sums(letters: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash, one column more than letters."""
    out = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
    np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * powers(BASE, letters.shape[1]), axis=1, out=out[:, 1:])
    return out


def edits(letters: np.ndarray, alphabet: np.ndarray, has) -> Iterator[tuple[np.ndarray, int, int]]:
    """(rows, place, letter) of deletions (letter -1) and replacements by larger letters that ``has(length, hashes)`` lets pass. A run of equal letters is shortened once."""
    n = letters.shape[1]
    power = powers(BASE, n)
    whole = sums(letters)
    last = whole[:, -1]
    for i in range(n):
        rows = np.arange(len(letters)) if i == 0 else np.flatnonzero(letters[:, i] != letters[:, i - 1])
        passed = rows[has(n - 1, whole[rows, i] + (last[rows] - whole[rows, i + 1]) * BACK)]
        if len(passed):
            yield passed, i, -1
        for c in alphabet.tolist():
            rows = np.flatnonzero(letters[:, i] < c)
            if len(rows):
                passed = rows[has(n, last[rows] + (np.uint64(c) - letters[rows, i].astype(np.uint64)) * power[i])]
                if len(passed):
                    yield passed, i, c


def filters(words: DataFrame) -> bloom.Filter:
    """One Bloom filter for each length of word."""
    counts = {r[0]: r[1] for r in words.groupBy(F.length("word").alias("l")).count().collect()}

    def hashed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for n, _, letters in by_length(column(batch, "word").to_pylist()):
            yield n, sums(letters)[:, -1]

    return bloom.build(words.select("word"), hashed, counts)


def near(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs of words (word, n) that one inserted, deleted or replaced letter sets apart, in both directions."""
    sieve = words.sparkSession.sparkContext.broadcast(filters(words))
    letters = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").distinct().collect()  # at most the 90 letters of a word
    alphabet = np.array(sorted(ord(r[0]) for r in letters), np.uint8)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_words, counts = column(batch, "word").to_pylist(), column(batch, "n").to_numpy()
            for n, some, matrix in by_length(all_words):
                step = max(1, STEP // n)
                for low in range(0, len(some), step):
                    found: list[tuple[str, int]] = []
                    for rows, i, c in edits(matrix[low:low + step], alphabet, sieve.value.has):
                        for j in some[low + rows].tolist():
                            w = all_words[j]
                            found.append((w[:i] + (chr(c) if c >= 0 else "") + w[i + 1:], j))
                    if found:
                        at = np.array([j for _, j in found])
                        yield pa.RecordBatch.from_arrays([pa.array([all_words[j] for j in at.tolist()]), pa.array(counts[at]), pa.array([e for e, _ in found])], names=["word", "n", "edit"])

    positives = arrow(words.select("word", "n"), probe, "word string, n long, edit string")
    pairs = positives.join(words.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
    both = F.array(F.struct("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")), F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.inline(both))


def variants(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word. Words and forms are kept in the folder of ``spark.checkpoint.dir``."""
    words = cut_lineage(words)
    best = near(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    strong = -F.col("best.minus") >= 2 * F.col("n")
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n"))
    return cut_lineage(out)


def rooted(forms: DataFrame) -> DataFrame:
    """Appends ``root``: the last of the forms that follow from a word, itself if none."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("root", T.StringType())])
    done = forms.filter("form is null").select("word", F.col("word").alias("root"))
    left, last = forms.filter("form is not null").select("word", "form"), done
    out = forms.sparkSession.createDataFrame([], schema).union(done)
    while True:
        last = cut_lineage(left.join(last.select(F.col("word").alias("form"), "root"), "form").select("word", "root"))
        if last.isEmpty():
            break
        out = out.union(last)
    return forms.join(out, "word")


def groups(docs: DataFrame, **options) -> DataFrame:
    """One row (word, form, root, n, n_near, form_n) for each word of the documents."""
    return rooted(variants(vocabulary(docs, **options))).select("word", "form", "root", "n", "n_near", "form_n")
