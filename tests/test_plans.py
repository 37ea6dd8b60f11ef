"""Physical plans: no nested-loop or Cartesian joins, pruned scans."""
import pytest

import __spark_entry__ as entry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["d1_enrich_labels", "d5_label_cooccurrence", "d6_cooccurring_by_group", "d7_resolve_qrels", "e9_length_outliers", "f14_length_bucket",
                                  "g7_topk_similar", "g15_mine_hard_negatives", "g16_group_hard_negatives", "h1_cap_multi_label", "i12_accept", "k8_metric_table"])
def test_no_nested_loops(spark, sf, name):
    p = plan(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_is_pruned(spark, sf):
    p = plan(entry.queries()["e1_label_frequency"](spark, sf))
    assert "l_extendedprice" not in p and "l_shipdate" not in p


def test_classification_has_no_shuffle(spark, sf):
    p = plan(entry.queries()["f5_classify_rules"](spark, sf))
    assert "Exchange" not in p and "Join" not in p


def test_label_documents_are_built_once(spark, sf):
    """Requests with companions and negatives read kept label documents, not the lines again."""
    assert "FileScan" not in plan(entry.queries()["i17_new_label_requests_multi"](spark, sf))
