"""Records of large files whose borders depend on what came before: JSON arrays and CSV with quoted line breaks, read by many tasks.

Spark splits a text file into byte ranges at any one-character separator. ``}`` cuts JSON and a line break cuts CSV into pieces that may be part of a record or hold
a separator inside a string. Whether they do depends on the state at the start of the range, so a first pass sums up each range as a function of its start: parity of
quotes, and change and least value of the nesting for both cases of being inside a string. One row a range, these functions are composed in
file order by windows; then every range knows its start state, and a second pass cuts the records. Only pieces of records that cross a range are
shuffled, by the range where the record begins.

A JSON record is an object; nested ones belong to theirs. What stands between objects other than commas, brackets and blanks, and an object that never
ends, is handed on as rejected. The driver holds one row for each range, as Spark's own plan of the scan does.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_ESCAPED = re.compile(r"\\.", re.S)
_STRUCTURE = str.maketrans("", "", "{}[]")


class Objects:
    """JSON objects: at nesting ``base`` and below no object is open (1 inside a top-level array, 0 without one)."""
    sep = "}"

    def __init__(self, base: int):
        self.base = base

    def step(self, text: str) -> tuple[int, int, int]:
        """Parity of quotes, change of nesting if the text begins outside a string, and if inside."""
        parts = (_ESCAPED.sub("", text) if "\\" in text else text).split('"')

        def change(outside: str) -> int:
            return outside.count("{") + outside.count("[") - outside.count("}") - outside.count("]")

        return (len(parts) - 1) & 1, change("".join(parts[0::2])), change("".join(parts[1::2]))

    def head(self, text: str, inside: int) -> tuple[str, str]:
        """(what stands before the next object, the rest from its brace)."""
        i = 0
        while i < len(text):
            c = text[i]
            if inside and c == "\\":
                i += 1
            elif c == '"':
                inside ^= 1
            elif c == "{" and not inside:
                return text[:i], text[i:]
            i += 1
        return text, ""

    def junk(self, text: str) -> bool:
        return bool(text.strip(" \t\r\n,[]﻿"))

    def record(self, text: str) -> str:
        return text


class Quoted:
    """CSV records: a line break inside quotes belongs to the record."""
    sep, base = "\n", 0

    def __init__(self, quote: str = '"'):
        self.quote = quote

    def step(self, text: str) -> tuple[int, int, int]:
        parity = text.count(self.quote) & 1
        return parity, parity, -parity

    def head(self, text: str, inside: int) -> tuple[str, str]:
        return "", text

    def junk(self, text: str) -> bool:
        return False

    def record(self, text: str) -> str:
        return text.removesuffix("\n").removesuffix("\r").replace("\r\n", "\n")


def pieces(spark: SparkSession, paths, sep: str, **options) -> DataFrame:
    reader = spark.read.option("lineSep", sep)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), "value")


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int] | None, int, str | None]]:
    """((file, block), size, text) of each piece in order, and (None, 0, None) after each batch."""
    for batch in batches:
        yield from zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2).to_pylist(), batch.column(3).to_pylist())
        yield None, 0, None


def summaries(rows: DataFrame, kind) -> DataFrame:
    """One row for each range: parity, change and least nesting at the end of a piece, for both states at its start, and bytes."""
    names = ["file", "block", "size", "bytes", "parity", "d0", "m0", "d1", "m1", "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def out() -> pa.RecordBatch:
            size, used, parity, d, m, rest = state
            return pa.RecordBatch.from_pydict(dict(zip(names, [[now[0]], [now[1]], [size], [used], [parity], [d[0]], [m[0]], [d[1]], [m[1]], [rest]])))

        for key, size, text in _by_range(batches):
            if key is None:
                continue
            if key != now:
                if state:
                    yield out()
                now, state = key, [size, 0, 0, [0, 0], [1 << 40, 1 << 40], False]
            parity, *change = kind.step(text + kind.sep)
            p, d, m = state[2:5]
            for s in (0, 1):
                d[s] += change[p ^ s]
                m[s] = min(m[s], d[s])
            state[1] += len(text.encode()) + 1
            state[2] = p ^ parity
            state[5] = kind.junk(text)
        if state:
            yield out()

    return rows.mapInArrow(run, "file string, block long, size long, bytes long, parity long, d0 long, m0 long, d1 long, m1 long, rest boolean")


@dataclass
class Start:
    """State at the start of a range, the range in which the open record begins, whether it ends, and whether the last piece of the range lacks its separator."""
    inside: int
    level: int
    home: int
    ends: bool
    later: bool
    bare: bool


def starts(ranges: DataFrame, base: int) -> dict[tuple[str, int], Start]:
    """Composes the ranges of each file in order."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy("block").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    following = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    x = ranges.withColumn("inside", F.pmod(F.coalesce(F.sum("parity").over(before), F.lit(0)), F.lit(2)).cast("int"))
    for name in ("d", "m"):
        x = x.withColumn(name, F.when(F.col("inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1")))
    x = x.withColumn("level", F.coalesce(F.sum("d").over(before), F.lit(0)))
    closes = F.col("level") + F.col("m") <= base  # at the end of some piece of the range no record is open
    x = x.withColumn("closes", closes).withColumn("free", closes | (F.col("level") <= base))
    x = x.select("file", "block", "inside", "level", F.last(F.when(F.col("free"), F.col("block")), True).over(before).alias("home"),
                 F.max("closes").over(after).alias("ends"), F.max("closes").over(following).alias("later"),
                 (F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))) == 1).alias("last"),
                 (F.sum("bytes").over(Window.partitionBy("file")) - F.col("size")).alias("over"), "rest")
    bare = F.col("last") & F.when(F.col("over") == 0, False).when(F.col("over") == 1, True).otherwise(~F.col("rest"))  # sizes differ otherwise where bytes were no UTF-8
    rows = x.select("file", "block", "inside", "level", "home", "ends", "later", bare.alias("bare")).toLocalIterator()
    return {(r.file, r.block): Start(r.inside, r.level, r.block if r.home is None else r.home, bool(r.ends), bool(r.later), bool(r.bare)) for r in rows}


def records(spark: SparkSession, paths, kind, **options) -> tuple[DataFrame, DataFrame]:
    """(good, rejected), both (row_no, record). ``row_no`` = (file, range, piece) where the record begins, so it grows with the place in the file."""
    rows = pieces(spark, paths, kind.sep, **options)
    known = spark.sparkContext.broadcast(starts(summaries(rows, kind), kind.base))
    names = ["file", "home", "block", "seq", "record", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, held, seq, start = None, None, 0, None
        inside = level = 0
        buffer: list[str] | None = None
        home = first = 0

        def take(text: str) -> None:
            nonlocal inside, level, buffer, home, first
            parity, *change = kind.step(text)
            if buffer is None:
                junk, rest = kind.head(text, inside)
                if kind.junk(junk):
                    out.append((*now, now[1], seq, junk, "rejected"))
                if rest:
                    buffer, home, first = [rest], now[1], seq
            else:
                buffer.append(text)
            level += change[inside]
            inside ^= parity
            if buffer is not None and level <= kind.base:
                hand("whole" if home == now[1] else "part")

        def hand(how: str) -> None:
            nonlocal buffer
            text = "".join(buffer)
            out.append((now[0], home, now[1], first if home == now[1] else 0, kind.record(text) if how == "whole" else text, how))
            buffer = None

        def finish() -> None:
            nonlocal held
            if held is not None:
                take(held if start.bare else held + kind.sep)
                held = None
            if buffer is not None:
                hand("part" if (start.later if home == now[1] else start.ends) else "rejected")

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=names)

        for key, _, text in _by_range(batches):
            if key is None:
                yield batch_of()
                continue
            if key != now:
                finish()
                now, start, seq, buffer = key, known.value[key], 0, None
                inside, level = start.inside, start.level
                if level > kind.base:
                    buffer, home = [], start.home
            else:
                take(held + kind.sep)
                seq += 1
            held = text
        finish()
        yield batch_of()

    cut = rows.mapInArrow(run, "file string, home long, block long, seq long, record string, kind string")
    row_no = F.struct("file", F.col("home").alias("block"), "seq").alias("row_no")
    ordered = F.array_sort(F.collect_list(F.struct("block", "record")))
    parts = (cut.where("kind = 'part'").groupBy("file", "home").agg(F.max("seq").alias("seq"), F.array_join(F.transform(ordered, lambda x: x["record"]), "").alias("record")))
    if kind.sep == "\n":
        parts = parts.withColumn("record", F.regexp_replace(F.regexp_replace("record", "\r?\n\\z", ""), "\r\n", "\n"))
    good = cut.where("kind = 'whole'").select(row_no, "record").unionByName(parts.select(row_no, "record"))
    return good, cut.where("kind = 'rejected'").select(row_no, "record")
