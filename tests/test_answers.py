"""Answers are parsed once, and only as far as needed."""
from pyspark.sql import functions as F

from labelloom.functions import payloads
from labelloom.operators import generation

ANSWERS = ['{"a": 1}', ' {"a": 1}\n', 'Sure:\n```json\n{"a": 1}\n```\nDone {"b": 2}.', 'x ```{"a": 1}``` y', 'so `{"a": 1}` it', 'Then {"a": 1} and', 'none', 'no {brace', 'true', 'text\n{"a":\n1}\nend', "",
           'null', 'tail', 'NaN', '```json\nnot json\n``` but `{"a": 2}`', '[1]', '12', '"quoted"', 'Infinity', '-Infinity', '+1', None]


def test_first_json_equals_trying_all_candidates(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ANSWERS)], "i int, a string")
    every = F.get(F.filter(payloads.json_candidates(F.col("a")), lambda x: F.try_parse_json(x).isNotNull()), F.lit(0))
    for row in df.select("a", every.alias("want"), payloads.extract_json(F.col("a")).alias("got")).collect():
        assert row.got == row.want, row


def test_groups_are_worked_out_once(spark):
    """They were worked out again in the filter that Spark infers for explode, and the text once for each pattern."""
    df = spark.createDataFrame([(1, "q", ["a", "b", "c"], ["d"], '```json\n{"groups": [{"labels": ["a", "c"]}, {"labels": []}]}\n```'), (2, "q", ["a"], None, None), (3, "q", ["a", "b", "c"], [], "nothing"), (4, "q", [], [], "")],
                               "sample_id int, query string, pos array<string>, neg array<string>, answer string")
    answer = F.concat("answer", F.lit("  marked  "))
    out = generation.split_by_group(df.withColumn("groups", generation.reconcile_groups(F.col("pos"), answer, 2)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("marked") == 1 and plan.count("```json") == 1
    assert sorted((r.sample_id, r.group_index, r.pos, r.neg, r.total_groups) for r in out.collect()) == [(1, 0, ["a", "c"], ["b", "d"], 2), (1, 1, ["b"], ["a", "c", "d"], 2), (2, 0, ["a"], [], 1)]
