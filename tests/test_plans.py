"""Properties of the physical plans that decide how the queries scale."""

import os
import re

import pytest

from oreworks.workload import registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WRITES_TABLES = {name for name in registered() if name.startswith("full_run")}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(text, name):
    return len(re.findall(rf"(?:^|[ +:\-]){name}\b", text, flags=re.MULTILINE))


@pytest.mark.parametrize("name", sorted(set(registered()) - WRITES_TABLES))
def test_no_plan_has_an_operator_that_does_not_scale(spark, name):
    text = plan(registered()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit"):
        assert bad not in text
    # Every ranking window is reduced to one row per key before its shuffle.
    assert nodes(text, "WindowGroupLimit") == 2 * nodes(text, "Window")


def test_three_stages_are_one_shuffle(spark):
    text = plan(registered()["silver_c_lineitem"](spark, FOLDER))
    assert nodes(text, "Exchange") == 1
    read = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert len(read.split(",")) == 8 and "l_suppkey" not in read


@pytest.mark.parametrize("name", ["silver_a_orders", "silver_b_customer", "silver_b_documents",
                                  "quality_score_orders", "expect_drop", "expect_fail"])
def test_row_operators_do_not_shuffle(spark, name):
    assert nodes(plan(registered()[name](spark, FOLDER)), "Exchange") == 0


def test_required_fields_reach_the_scan(spark):
    text = plan(registered()["silver_a_orders"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_custkey), IsNotNull(o_orderkey)" in text
    assert "o_orderpriority" not in text


def test_counts_read_key_columns_only(spark):
    text = plan(registered()["duplicates_lineitem"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert "partial_count(1)" in text


def test_all_completeness_counts_are_one_scan(spark):
    text = plan(registered()["completeness_orders"](spark, FOLDER))
    assert nodes(text, "FileScan") == 1


def test_latest_errors_is_a_top_k(spark):
    text = plan(registered()["latest_errors"](spark, FOLDER))
    assert "TakeOrderedAndProject" in text and nodes(text, "Exchange") == 0


def test_the_quality_report_reads_every_table_once(spark):
    text = plan(registered()["quality_report"](spark, FOLDER))
    assert nodes(text, "FileScan") == 2  # orders and line items
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*orderkey", text)) == 2
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(len(r.split(",")) for r in read) == [3, 4]
