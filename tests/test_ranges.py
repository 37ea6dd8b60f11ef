"""Readers of byte ranges against whole-file parsers; ranges are made tiny so that records cross many of them."""
import csv
import io
import json
import random

import pytest

from pyspark.sql import functions as F

from labelloom.sources import ranges, readers


@pytest.fixture
def tiny(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k in names:
        spark.conf.unset(k)


def value(rng, depth=0):
    r = rng.random()
    if r < .5 or depth > 3:
        return "".join(rng.choice('ab{}[]",\\ é\n') for _ in range(rng.randint(0, 60)))
    if r < .75:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {str(i): value(rng, depth + 1) for i in range(rng.randint(0, 3))}


@pytest.mark.parametrize("indent, base", [(None, 1), (1, 1), (1, 0)])
def test_objects_equal_a_whole_parse(tiny, tmp_path, indent, base):
    rng = random.Random(base)
    files = {}
    for name in ("a.json", "b.json"):
        data = files[name] = [{str(i): value(rng) for i in range(rng.randint(0, 4))} for _ in range(60)] + [{"long": "}{" * 1500}]
        text = json.dumps(data, indent=indent, ensure_ascii=False) if base else "\n".join(json.dumps(x, indent=indent) for x in data)
        (tmp_path / name).write_text(text, encoding="utf-8")
    good, bad = ranges.records(tiny, str(tmp_path), ranges.Objects(base))
    rows = sorted(good.collect(), key=lambda r: r.row_no)
    for name, data in files.items():
        assert [json.loads(r.record) for r in rows if r.row_no.file.endswith(name)] == data
    assert bad.count() == 0 and ranges.pieces(tiny, str(tmp_path), "}").rdd.getNumPartitions() > 20


def test_what_is_no_object_is_rejected(tiny, tmp_path):
    filler = ", ".join(json.dumps({"query": "q" * 80, "pos": [], "neg": []}) for _ in range(8))
    (tmp_path / "a.json").write_text(f'[{filler}, 17, "x}}{{y", {filler}, null, {{"query": "cut off }}", "pos": [')
    good, bad = ranges.records(tiny, str(tmp_path / "a.json"), ranges.Objects(1))
    assert good.count() == 16
    text = "".join(r.record for r in sorted(bad.collect(), key=lambda r: r.row_no))
    assert "17" in text and '"x}' in text and "null" in text and "cut off" in text
    loaded = readers.read_samples(tiny, str(tmp_path / "a.json"))
    assert loaded.rows.count() == 16 and len(loaded.rejected.collect()) >= 3


@pytest.mark.parametrize("text, expected", [("[]", 0), ("", 0), (" [\n]\n", 0), ('[{"a": 1}]', 1), ('{"a": 1}', 1), ('[{"a": 1}]\n', 1), ('[{}, {}]', 2), ('﻿[{"a": "\\\\"}, {"b": "\\"}"}]', 2)])
def test_small_files(spark, tmp_path, text, expected):
    (tmp_path / "f.json").write_text(text, encoding="utf-8")
    good, bad = ranges.records(spark, str(tmp_path / "f.json"), ranges.Objects(0 if text.startswith("{") else 1))
    assert (good.count(), bad.count()) == (expected, 0)


def test_formats_from_the_first_characters(spark, tmp_path):
    (tmp_path / "big array.json").write_text("[" + ",".join(json.dumps({"query": f"q{i}", "pos": ["}"], "neg": []}) for i in range(30000)) + "]")
    (tmp_path / "lines.json").write_text('{"query": "a", "pos": [], "neg": []}\n' * 3)
    (tmp_path / "one.json").write_text('{\n"query": "a", "pos": [], "neg": []}')
    (tmp_path / "plain.json").write_text("no json\n")
    (tmp_path / "none.json").write_text("\n")
    kinds = {f.rsplit("/", 1)[1]: k for f, k in readers.file_formats(spark, str(tmp_path)).items()}
    assert kinds == {"big%20array.json": "array", "lines.json": "jsonl", "one.json": "object", "plain.json": "jsonl"}
    loaded = readers.read_samples(spark, str(tmp_path))
    assert loaded.rows.count() == 30004 and len(loaded.rejected.collect()) == 1


def test_csv_equals_a_whole_parse(tiny, tmp_path):
    rng = random.Random(7)
    header = ["preferredLabel", "a b", "description"]
    files = {}
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n")):
        rows = [["".join(rng.choice('ab"",; \né') for _ in range(rng.randint(0, 60))) for _ in range(3)] for _ in range(80)]
        rows = files[name] = [["x" + r[0].strip(), "y" + r[1].strip(), "z" + r[2].strip()] for r in rows]
        out = io.StringIO()
        csv.writer(out, lineterminator=end).writerows([header, *rows])
        (tmp_path / name).write_text(out.getvalue() + end, encoding="utf-8", newline="")
    got = readers.read_csv(tiny, str(tmp_path))
    assert got.columns == ["row_no", *header]
    rows = sorted(got.collect(), key=lambda r: r.row_no)
    for name, expected in files.items():
        assert [list(r[1:]) for r in rows if r.row_no.file.endswith(name)] == expected
    assert sum("\n" in x for r in files["a.csv"] for x in r) > 20


def test_csv_edges(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿label;x\n"one\n\n""two""";1\n\nlast', encoding="utf-8")
    assert [tuple(r[1:]) for r in sorted(readers.read_csv(spark, str(tmp_path / "a.csv"), ";").collect(), key=lambda r: r.row_no)] == [('one\n\n"two"', "1"), ("last", None)]
    (tmp_path / "b.csv").write_text("")
    assert readers.read_csv(spark, str(tmp_path / "b.csv")).count() == 0
    (tmp_path / "c.csv").write_text("label,x\n")
    assert readers.read_csv(spark, str(tmp_path / "c.csv")).columns == ["row_no", "label", "x"] and readers.read_csv(spark, str(tmp_path / "c.csv")).count() == 0


def test_no_file_is_left_out_behind_others(spark, tmp_path, monkeypatch):
    """A task that stops at the first file it has looked into leaves those behind it to further rounds; equal contents are still numbered."""
    monkeypatch.setattr(readers, "PROBE_PIECES", 1)
    line = F.concat(F.lit('{"query":"'), (F.col("id") % 1990).cast("string"), F.lit('","pos":[],"neg":[]}'))
    path = str(tmp_path / "many files")
    spark.range(2000).select(line.alias("value")).repartition(40).write.text(path)
    (tmp_path / "many files" / "part-empty.txt").write_text("")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    try:
        assert len(readers.file_formats(spark, path)) == 40
        rows = readers.read_samples(spark, path).rows
        assert (rows.count(), rows.select("sample_id").distinct().count()) == (2000, 2000)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_different_contents_are_not_joined(spark, tmp_path):
    """Without equal contents nothing is shuffled to number them."""
    path = str(tmp_path / "x")
    spark.range(50).select(F.col("id").cast("string").alias("query"), F.array().cast("array<string>").alias("pos")).write.json(path)
    plan = readers.read_samples(spark, path).rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
