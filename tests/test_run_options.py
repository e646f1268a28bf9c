"""Options of a run: groups of combinations, failing expectations, stored metrics, missing input,
survivors."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from oreworks.model import Combination, Settings
from oreworks.operators.checks import completeness
from oreworks.operators.dedup import deduplicate, duplicate_groups, key_profile
from oreworks.operators.expectations import Expectation, valid_data_types
from oreworks.plans.pipeline import run
from oreworks.sources import rules, sinks
from oreworks.workload import registered

GOOD, BAD, GONE = (Combination("s", "l", d) for d in ("good", "bad", "gone"))
SETTINGS = Settings(
    bronze_schema="opt_raw",
    silver_schema="opt_clean",
    dedup_keys={"good": ("k",), "bad": ("k", "not_there")},
)


@pytest.fixture(scope="module")
def inputs(spark):
    sinks.ensure_schema(spark, "opt_raw")
    for c, rows in ((GOOD, [(1, "a", 5), (1, "b", 9), (2, "c", 1)]), (BAD, [(1, None, 5)])):
        frame = spark.createDataFrame(rows, "k int, v string, at int")
        frame.write.mode("overwrite").saveAsTable(f"opt_raw.{c.label}_202407_bronze")
    none = rules.schema_rules(spark, []), rules.transform_rules(spark, [])
    return lambda settings=SETTINGS, combos=(GOOD, BAD), **o: run(
        spark, settings, "202407", combos, *none, raise_failures=False, **o
    )


def test_groups_do_not_change_results(inputs):
    for size in (1, 2, 100):
        result = inputs(combos=[GOOD, BAD, GONE], group=size)
        assert sorted(r[5] for r in result.log_rows) == [0, 0, 0, 1, 1, 1, 2, 3, 3]


def test_a_failing_expectation_stops_its_combination_only(inputs):
    guard = {"silver_a": lambda df: {"v_there": Expectation(F.col("v").isNotNull(), "fail")}}
    result = inputs(expectations=guard)
    assert result.failed == [BAD] and (GOOD, "silver_c") in result.written


def test_store_does_not_double(spark, inputs):
    where = ("opt_clean.metrics", "opt_clean.errors")
    first = inputs(store=where).metrics.count()
    inputs(store=where)
    assert spark.table(where[0]).count() == first > 0
    assert {r.run for r in spark.table(where[0]).select("run").collect()} == {"202407"}


def test_missing_input_can_skip_or_fail(spark, inputs):
    assert inputs(combos=[GONE], on_missing_input="skip").written == {}
    assert inputs(combos=[GONE], on_missing_input="fail").failed == [GONE]


def test_completeness_rides_on_the_write(spark, inputs):
    wanted = ["k", "v", "not_there"]
    fields = rules.schema_rules(spark, [(*GOOD, f, "STRING", True) for f in wanted])
    off = replace(SETTINGS, validation_enabled=False)
    none = rules.transform_rules(spark, [])
    sinks.ensure_schema(spark, "opt_raw")
    result = run(spark, off, "202407", [GOOD], fields, none, on_error="passthrough")
    got, want = result.completeness()[0], completeness(result.table(GOOD, "silver_c"), GOOD, wanted)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_survivors_and_missing_keys_are_settings(inputs):
    latest = replace(SETTINGS, dedup_order={"good": ("at DESC",)}, on_missing_keys="error")
    result = inputs(settings=latest)
    assert {(r.k, r.v) for r in result.table(GOOD, "silver_c").collect()} == {(1, "b"), (2, "c")}
    assert result.failed == [BAD]


def test_without_finalizing_there_is_no_false_alarm(inputs):
    result = inputs(combos=[GOOD], finalize=False)
    assert result.checks[GOOD, "silver_c"]


def test_settings_come_from_the_mapping():
    raw = {
        "pipeline": {"bronze_schema": "b", "silver_schema": "s", "bronze_suffix": "_x"},
        "tables": {"schema_rules": "r", "transform_rules": "t"},
        "sources": [{"name": "n", "lobs": ["l"], "domains": ["texts"]}],
        "allowed_domains": ["texts"],
        "deduplication": {"keys": {"texts": ["text"]}, "on_missing_keys": "skip"},
        "data_quality": {"min_quality_score": 0.7},
    }
    s = Settings.from_mapping(raw)
    assert (s.bronze_suffix, s.min_quality_score, s.on_missing_keys) == ("_x", 0.7, "skip")
    assert s.keys_for("texts") == ("text",)
    with pytest.raises(ValueError, match="unknown domains"):
        Settings.from_mapping({**raw, "allowed_domains": ["sales"]})


def test_helper_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 5, 6)], "key_rank int, key_count int, row_count int")
    assert deduplicate(df, ["key_rank"]).columns == df.columns
    assert key_profile(df, ["key_count"]).first().total_records == 2
    assert duplicate_groups(df, ["row_count"]).count() == 0


def test_text_keys_are_sorted_by_their_hash(spark):
    df = spark.createDataFrame([("a", "x", 1)], "t string, u string, n int")
    plan = deduplicate(df, ["t"])._jdf.queryExecution().optimizedPlan().toString()
    window = next(x for x in plan.splitlines() if "Window [" in x)
    parts, order = window.split("], [")[-2:]
    assert parts.startswith("_w0") and "xxhash64(t" in plan
    assert order.index("n#") < order.index("u#")


def test_types_that_never_convert_count(spark):
    df = spark.createDataFrame([(1.5, "a"), (None, None)], "x double, y string")
    found = valid_data_types(df, [{"field_name": "x", "data_type": "DATE"}, {"field_name": "y", "data_type": "VARCHR"}])
    got = df.select(*[F.count_if(~c).alias(n) for n, c in found.items()]).first()
    assert tuple(got) == (1, 1)


def test_stage_checks_open_no_table_but_their_own(spark, tmp_path):
    rows = [(1, 10, "O", 5.0), (2, 10, "O", 3.0), (3, 10, "P", 1.0), (4, 11, "F", None)]
    df = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")
    df.write.parquet(f"{tmp_path}/orders.parquet")
    found = registered()["stage_checks"](spark, str(tmp_path)).collect()
    assert {(r.stage, r.metric_value, r.record_count) for r in found} == {("silver_b", 0.0, 3), ("silver_c", 1.0, 2)}
