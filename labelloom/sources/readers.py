"""Readers: JSON array / JSON Lines samples, label tables, corpora, target lists.

Every reader attaches ``row_no`` = (file, block, seq). ``monotonically_increasing_id`` is taken directly
above the scan and only ever compared within one block of one file, so it does not depend on how Spark
packs files into tasks. ``sample_id`` is the digest of the content and its number among equal contents, so neither packing nor paths change it. Malformed records go to a second DataFrame instead of failing the job.
"""
from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .. import schemas as S
from ..functions.arrays import or_empty
from ..functions.payloads import parse_occupations
from ..functions.ranking import running_before
from ..functions.text import strip
from ..session import cut_lineage
from . import ranges

BAD = "_bad"


@dataclass
class Loaded:
    """Good rows and the records that could not be read."""
    rows: DataFrame
    rejected: DataFrame


def row_position() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"))


def parse_meta(c: Column) -> Column:
    """JSON object text -> typed meta; unknown fields are kept as text in ``extra``."""
    known = F.from_json(c, T.StructType(S.META_FIELDS))
    everything = F.from_json(c, "map<string,string>")
    rest = F.map_filter(everything, lambda k, _: ~k.isin(*S.META_KNOWN))
    return F.when(c.isNotNull(), F.struct(
        *[known[n].alias(n) for n in S.META_KNOWN], F.when(F.size(rest) > 0, rest).alias("extra")))


def _samples(raw: DataFrame) -> Loaded:
    bad = raw.where(F.col(BAD).isNotNull()).select("row_no", F.col(BAD).alias("record"))
    good = raw.where(F.col(BAD).isNull()).withColumn("_content", F.md5(F.to_json(F.struct("query", "pos", "neg", "meta"))))
    # equal contents are numbered in file order; only those that occur more than once are moved for it, so without any nothing is joined
    several = cut_lineage(good.groupBy("_content").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("_content"))
    if several.isEmpty():
        good = good.withColumn("_before", F.lit(0).cast("long"))
    else:
        again = good.join(several, "_content", "left_semi").select("_content", "row_no")
        again = running_before(again, ["_content"], F.struct("row_no.file", "row_no.block"), [F.col("row_no.seq")], {"_before": F.lit(1).cast("long")}, once=False)
        again = again.select("row_no", "_before")
        good = good.join(again.withColumnRenamed("row_no", "_at"), F.col("row_no") == F.col("_at"), "left")
    good = good.select(
        F.md5(F.concat_ws("#", "_content", F.coalesce("_before", F.lit(0).cast("long")))).alias("sample_id"), "row_no", "query", "pos", "neg", parse_meta(F.col("meta")).alias("meta"))
    return Loaded(good, bad)


def _schema() -> T.StructType:
    return T.StructType(S.RAW_SAMPLE.fields + [T.StructField(BAD, T.StringType())])


def _parsed(rows: DataFrame, record: Column) -> DataFrame:
    """(row_no, fields of a sample, bad): JSON text by the schema; what cannot be read stands in ``bad``."""
    return rows.select("row_no", F.from_json(record, _schema(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("s")).select("row_no", "s.*")


def _json(spark: SparkSession, paths, **options) -> DataFrame:
    """One object a line; blank lines are dropped."""
    reader = spark.read
    for key, value in options.items():
        reader = reader.option(key, value)
    rows = reader.text(paths).select(row_position().alias("row_no"), "value").where(strip(F.col("value")) != "")
    return _parsed(rows, F.col("value"))


def _json_objects(spark: SparkSession, paths, base: int, **options) -> DataFrame:
    """As ``_json`` for top-level arrays (base 1) and objects over several lines (base 0); byte ranges of a file are read by many tasks."""
    good, rejected = ranges.records(spark, paths, ranges.Objects(base), **options)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.RAW_SAMPLE.fields]
    return _parsed(good, F.col("record")).unionByName(rejected.select("row_no", *nothing, F.col("record").alias(BAD)))


def read_jsonl(spark: SparkSession, path) -> Loaded:
    """One object per line; blank and undecodable lines are dropped, duplicates and order kept."""
    return _samples(_json(spark, path))


#: Pieces or characters of one range after which the probe has seen enough.
PROBE_PIECES, PROBE_CHARS = 1000, 1 << 16


def _format(text: str) -> str:
    """array, object or jsonl, from the beginning of a file."""
    text = text.lstrip("\ufeff \t\r\n")
    if text.startswith("["):
        return "array"
    line = text.split("\n", 1)[0]
    try:
        json.loads(line)
        return "jsonl"
    except ValueError:
        return "object" if line.startswith("{") else "jsonl"


def _plain(file: str) -> str:
    """One form for the names that Spark gives a file: its listing says file:///x where its rows say file:/x."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///(?!/)", r"\1:/", unquote(file))


def file_formats(spark: SparkSession, path, **options) -> dict[str, str]:
    """File -> array, object (over several lines) or jsonl, from the first characters of each file; empty files are left out.

    A task stops reading at the first large range it has looked into. Files that were packed behind it are asked for again, so each round reads the
    beginning of some files and never a large one to its end. The driver gets one short row a file, as it lists the files anyway.
    """
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun: dict[str, str] = {}
        names = ["file", "fmt", "seen"]
        for batch in batches:
            files, blocks, values = (batch.column(c).to_pylist() for c in (0, 1, 3))
            for file, block, value in zip(files, blocks, values):
                if block == 0 and len(begun.get(file, "")) < PROBE_CHARS:
                    begun[file] = begun.get(file, "") + value + "}"
            if files and files[0] == files[-1] and (len(files) >= PROBE_PIECES or sum(map(len, values)) >= PROBE_CHARS):
                break
        some = {f: t for f, t in begun.items() if t.strip("\ufeff \t\r\n}")}
        yield pa.RecordBatch.from_arrays([pa.array(list(begun), pa.string()), pa.array([_format(some[f]) if f in some else None for f in begun], pa.string()), pa.array([True] * len(begun))], names=names)

    out: dict[str, str] = {}
    asked = ranges.pieces(spark, path, "}", **options)
    left = {_plain(f) for f in asked.inputFiles()}
    while left:
        rows = asked.mapInArrow(probe, "file string, fmt string, seen boolean").collect()
        out.update({r.file: r.fmt for r in rows if r.fmt})
        seen = {_plain(r.file) for r in rows}
        if not seen:  # what is left has no bytes
            break
        if not seen <= left:
            raise ValueError(f"files that were not listed: {sorted(seen - left)[:3]}")
        left -= seen
        if left:
            asked = ranges.pieces(spark, sorted(left), "}")
    return out


def read_samples(spark: SparkSession, path, fmt: str = "auto", variant: str | None = None, **options) -> Loaded:
    """JSON array, one object, or JSON Lines; ``variant='gen'`` refuses a top-level object. ``fmt`` skips the probe.

    Large arrays are read by many tasks (module ``ranges``); what is no object in an array is rejected, the objects around it stay.
    """
    bases = {"array": 1, "object": 0}
    if fmt != "auto":
        raw = _json_objects(spark, path, bases[fmt], **options) if fmt in bases else _json(spark, path, **options)
    else:
        kinds = file_formats(spark, path, **options)
        if variant == "gen" and "object" in kinds.values():
            raise ValueError("a top-level object is not accepted here: expected a list of samples")
        parts = []
        for kind in ("jsonl", "object", "array"):
            if files := sorted(unquote(f) for f, k in kinds.items() if k == kind):
                parts.append(_json_objects(spark, files, bases[kind]) if kind in bases else _json(spark, files))
        if not parts:
            raise ValueError(f"no samples in {path}")
        raw = parts[0]
        for more in parts[1:]:
            raw = raw.unionByName(more)
    if raw.where(F.col(BAD).isNull()).where("query is not null or pos is not null or neg is not null").isEmpty():
        raise ValueError(f"no samples in {path}")
    return _samples(raw)


def read_directories(spark: SparkSession, paths: list[str]) -> Loaded:
    """All ``*.json`` files directly inside the directories (not below them)."""
    return read_samples(spark, list(paths), pathGlobFilter="*.json", recursiveFileLookup="false")


# --- strict contract --------------------------------------------------------------------------

def reject_reason(record: Column) -> Column:
    """Why a JSON text is no valid sample; null when it is one."""
    v = F.try_parse_json(record)

    def kind(path):
        return F.schema_of_variant(F.try_variant_get(v, path, "variant"))

    def bad_list(path):
        # only [] and lists whose items are all strings have these types
        return ~F.coalesce(kind(path).isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(False)) | (
            F.coalesce(kind(path) == "ARRAY<VOID>", F.lit(False))
            & (F.size(F.try_variant_get(v, path, "array<variant>")) > 0))

    meta = kind("$.meta")
    return (F.when(v.isNull(), "not json")
            .when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object")
            .when(~F.coalesce(kind("$.query") == "STRING", F.lit(False)), "query is not a string")
            .when(bad_list("$.pos"), "pos is not a list of strings")
            .when(bad_list("$.neg"), "neg is not a list of strings")
            .when(~F.coalesce(meta.startswith("OBJECT") | (meta == "VOID"), F.lit(True)), "meta is not an object"))


def validate_samples(df: DataFrame, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of rows holding one JSON text each; other columns are kept."""
    judged = df.withColumn("reject_reason", reject_reason(F.col(record)))
    rejected = judged.where(F.col("reject_reason").isNotNull())
    parsed = F.from_json(F.col(record), S.RAW_SAMPLE)
    valid = (judged.where(F.col("reject_reason").isNull()).withColumn("_s", parsed)
             .select(*df.columns, F.col("_s.query").alias("query"), F.col("_s.pos").alias("pos"),
                     F.col("_s.neg").alias("neg"),
                     parse_meta(F.coalesce(F.col("_s.meta"), F.lit("{}"))).alias("meta")))
    return valid, rejected


# --- label tables -----------------------------------------------------------------------------

LABEL_COLUMNS = ("preferredLabel", "preferred_label", "title")


def label_documents(df: DataFrame, label_columns=LABEL_COLUMNS, empty_description: str | None = None) -> DataFrame:
    """Raw label rows -> (label, description, occupations, skill_type); the LAST row of a label wins.

    ``df`` carries ``row_no``. One shuffle on the label, combined on the map side.
    """
    def text(name):
        return F.nullif(strip(F.col(name)), F.lit("")) if name in df.columns else F.lit(None).cast("string")

    def cell(name):
        return parse_occupations(F.col(name)) if name in df.columns else or_empty(F.lit(None).cast("array<string>"))

    rows = df.select(
        "row_no",
        F.coalesce(*[text(c) for c in label_columns]).alias("label"),
        F.coalesce(text("description"), F.lit(empty_description)).alias("description"),
        F.array_distinct(F.concat(cell("isEssentialForOccupations"), cell("isOptionalForOccupations"))).alias("occupations"),
        text("skillType").alias("skill_type")).where(F.col("label").isNotNull())
    body = F.struct("description", "occupations", "skill_type")
    return rows.groupBy("label").agg(F.max_by(body, "row_no").alias("b")).select("label", "b.*")


def read_csv(spark: SparkSession, path, sep: str = ",", **options) -> DataFrame:
    """(row_no and the columns of the header, as text) of CSV files whose quoted cells may hold line breaks.

    Byte ranges of a file are read by many tasks: the parity of quotes tells each range whether it begins inside a cell. Each file begins with a header;
    the columns are those of the first file's, as Spark's reader has it. Blank lines are dropped, missing cells are null, surplus ones are ignored.
    """
    good, _ = ranges.records(spark, path, ranges.Quoted(), **options)
    good = good.where(F.regexp_replace("record", r"^\ufeff", "") != "")
    first = Window.partitionBy("row_no.file").orderBy("row_no")
    heads = good.where("row_no.block = 0").withColumn("_n", F.row_number().over(first)).where("_n = 1").select("row_no", "record")
    head = heads.orderBy("row_no.file").first()
    if head is None:
        return spark.createDataFrame([], T.StructType([T.StructField("row_no", S.ROW_NO)]))
    names = next(csv.reader(io.StringIO(head.record.removeprefix("\ufeff")), delimiter=sep))
    names = [name or f"_c{i}" for i, name in enumerate(names)]
    body = good.join(heads.select(F.col("row_no").alias("_head")), F.col("row_no") == F.col("_head"), "left_anti")
    cells = F.from_csv("record", ", ".join(f"`{name}` string" for name in names), {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    return body.select("row_no", cells.alias("c")).select("row_no", "c.*")


def read_skills_csv(spark: SparkSession, path, extra_label: bool = False,
                    empty_description: str | None = None) -> DataFrame:
    """Header CSV of label documents; cells may hold line breaks."""
    columns = LABEL_COLUMNS + (("label",) if extra_label else ())
    return label_documents(read_csv(spark, path), columns, empty_description)


def competence_corpus(df: DataFrame) -> DataFrame:
    """Facet and requirement -> (title, page_content); a null part makes the content null."""
    return df.select(
        F.col("Kompetenzfacette").alias("title"),
        F.concat("Kompetenzfacette", F.lit(",/nKompetenzanforderungen: "), "Kompetenzanforderungen").alias("page_content"))


def read_competence_csv(spark: SparkSession, path) -> DataFrame:
    return competence_corpus(read_csv(spark, path, ";"))


def skill_corpus(df: DataFrame, label: str = "preferredLabel") -> DataFrame:
    """(page_content, title), null labels dropped; the corpus id is a hash of the title, not a position."""
    content = F.concat(F.col(label), F.lit(": "), F.coalesce("description", F.lit("")))
    return (df.select(F.xxhash64(label).alias("corpus_id"), F.col(label).alias("title"), content.alias("page_content"))
            .where(F.col("title").isNotNull() & F.col("page_content").isNotNull()))


def target_labels(record: DataFrame, column: str = "value") -> DataFrame:
    """``["a", ...]`` or ``{"skills": [...]}`` -> one row per label; non-strings are dropped."""
    v = F.try_parse_json(column)
    items = F.coalesce(F.try_variant_get(v, "$.skills", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"))
    return (record.select(F.explode(items).alias("x"))
            .where(F.schema_of_variant("x") == "STRING")
            .select(F.try_variant_get("x", "$", "string").alias("label")))


def read_target_labels(spark: SparkSession, path, skills: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, missing) target labels."""
    wanted = target_labels(spark.read.text(path, wholetext=True))
    known = skills.select("label")
    return wanted.join(known, "label", "left_semi"), wanted.join(known, "label", "left_anti")
