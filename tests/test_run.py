"""Full runs over the sample tables: written stages, logs, checks and failures."""

import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import BRONZE, MEDICAL1, MEMBER1, MEMBER2, PHARMACY1, PHARMACY2

from oreworks.model import QUALITY_METRICS, Combination, Settings
from oreworks.operators import expectations, report, summary
from oreworks.plans.pipeline import RunFailed, run
from oreworks.plans.quality import quality_run, write_quality
from oreworks.sources import rules, sinks, tables

ABSENT = Combination("source9", "lob9", "pharmacy")


@pytest.fixture(scope="module")
def settings(spark):
    s = Settings(bronze_schema="raw", silver_schema="clean")
    sinks.ensure_schema(spark, "raw")
    for c, (ddl, rows) in BRONZE.items():
        name = tables.bronze_table(s, c, "202407")
        spark.createDataFrame(rows, ddl).write.mode("overwrite").saveAsTable(name)
    return s


@pytest.fixture(scope="module")
def sample_rules(spark):
    return (
        rules.schema_rules(spark, rules.SAMPLE_SCHEMA_RULES),
        rules.transform_rules(spark, rules.SAMPLE_TRANSFORM_RULES),
    )


@pytest.fixture(scope="module")
def result(spark, settings, sample_rules):
    return run(spark, settings, "202407", [*BRONZE, ABSENT], *sample_rules)


@pytest.mark.parametrize(
    ("combination", "a_columns", "counts"),
    [
        (PHARMACY1, ["drug_name", "patient_id", "prescription_date", "quantity"], (7, 7, 6)),
        (MEDICAL1, ["patient_id", "procedure_code", "service_date"], (7, 7, 7)),
        (MEMBER1, ["enrollment_date", "member_id"], (7, 7, 7)),
        (PHARMACY2, None, (4, 4, 4)),
        (MEMBER2, None, (4, 4, 3)),
    ],
)
def test_expected_tables(result, bronze, combination, a_columns, counts):
    stages = ("silver_a", "silver_b", "silver_c")
    frames = [result.table(combination, s) for s in stages]
    assert frames[0].columns == (a_columns or bronze[combination].columns)
    assert tuple(f.count() for f in frames) == counts
    logged = {r[3]: r[5] for r in result.log_rows if r[:3] == tuple(combination)}
    assert tuple(logged[s] for s in stages) == counts


def test_expected_values(result):
    c = result.table(PHARMACY1, "silver_c")
    survivor = c.filter("patient_id = 'PAT001'").collect()
    # Numbers and dates settle the tie before strings do.
    assert [r["drug_name"] for r in survivor] == ["Metformin"]
    assert c.filter("drug_name = 'Metoprolol'").count() == 1
    assert {r[0] for r in c.select("quality_score").collect()} == {Decimal("1.00")}
    assert {r[0] for r in c.select("pipeline_stage").collect()} == {"silver_c"}
    medical = result.table(MEDICAL1, "silver_c")
    assert medical.filter("procedure_code = '99213'").count() == 2
    scores = result.table(PHARMACY2, "silver_c").groupBy("quality_score").count().collect()
    assert {(str(r[0]), r[1]) for r in scores} == {("0.88", 1), ("1.00", 3)}
    members = result.table(MEMBER2, "silver_c").select("quality_score").distinct().collect()
    assert [str(r[0]) for r in members] == ["0.88"]


def test_missing_input_becomes_a_placeholder(result):
    assert result.table(ABSENT, "silver_a").columns == ["placeholder"]
    final = result.table(ABSENT, "silver_c")
    assert final.columns == ["placeholder", "quality_score", "processed_timestamp", "pipeline_stage"]
    assert final.count() == 0
    assert result.checks[ABSENT, "silver_c"] is False
    assert result.checks[PHARMACY1, "silver_b"] is True


def test_tables_are_labelled(spark, result):
    name = result.written[PHARMACY1, "silver_c"]
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert shown["quality"] == "silver" and shown["layer"] == "silver_c"
    assert (shown["source"], shown["lob"], shown["domain"]) == tuple(PHARMACY1)
    assert shown["deduplication_keys"] == "patient_id,ndc,service_date"
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert "source1/lob1/pharmacy" in described["Comment"]


def test_scores_come_with_the_write(result):
    assert result.score_rows[PHARMACY2]["min_quality"] == 0.88
    assert result.score_rows[ABSENT]["avg_quality"] is None


def test_logs_feed_the_summaries(result, as_rows):
    assert result.errors.count() == 0
    rates = summary.throughput(result.run_log)
    assert rates.count() == 18 and rates.filter("records_per_second < 0").count() == 0
    stages = {(c, s): result.table(c, s) for c, s in result.written}
    counted = as_rows(summary.run_summary(stages))
    logged = as_rows(result.run_log, "source", "lob", "domain", "stage", "record_count")
    assert counted == logged


def test_expectations_are_counted_by_the_write(spark, sample_rules, as_rows):
    s = Settings(bronze_schema="raw", silver_schema="expected")
    out = run(
        spark, s, "202407", [PHARMACY1, MEMBER2], *sample_rules,
        expectations={
            "silver_b": lambda df: expectations.not_null(df.columns[1]),
            "silver_c": lambda df: {
                **expectations.acceptable_quality_scores(df, 0.9),
                **expectations.correct_pipeline_stage(df),
                **expectations.recent_processing_timestamp(df),
            },
        },
    )
    assert out.violations[PHARMACY1, "silver_b"] == {"patient_id_not_null": 0}
    assert out.violations[MEMBER2, "silver_c"] == {
        "acceptable_quality_scores": 3,
        "correct_pipeline_stage": 0,
        "recent_processing_timestamp": 0,
    }
    metrics = out.metrics
    assert metrics.schema == QUALITY_METRICS
    found = as_rows(
        metrics.filter("domain = 'member' AND stage = 'silver_c'"),
        "metric_name", "metric_value", "status", "record_count",
    )
    assert ("acceptable_quality_scores", 3.0, "WARN", 3) in found
    assert ("silver_c_completeness", 1.0, "PASS", 3) in found
    assert ("avg_quality", 0.88, "PASS", 3) in found
    assert metrics.filter("metric_name = 'records_per_second'").count() == 6


def test_a_run_without_input_still_has_metrics(result):
    absent = result.metrics.filter("domain = 'pharmacy' AND source = 'source9'").collect()
    got = {r["metric_name"]: r for r in absent if r["stage"] == "silver_c"}
    assert got["silver_c_completeness"]["status"] == "WARN"
    assert got["avg_quality"]["metric_value"] is None


def test_quality_run_on_the_final_tables(spark, result, sample_rules, as_rows):
    finals = {c: result.table(c, "silver_c") for c in BRONZE}
    metrics = quality_run(finals, sample_rules[0])
    assert metrics.filter("stage = 'duplicate_detection' AND status <> 'PASS'").count() == 0
    sinks.append_rows(metrics, "clean.data_quality_metrics")
    write_quality(finals, sample_rules[0], "clean.data_quality_metrics", batch=2)
    stored = spark.table("clean.data_quality_metrics")
    assert stored.count() == 2 * metrics.count()
    names = ["table_name", "stage", "metric_name", "metric_value", "status", "record_count"]
    assert as_rows(stored.select(*names).distinct()) == as_rows(metrics.select(*names).distinct())
    assert report.quality_history(stored, "source1", "pharmacy").count() > 0


def test_rerun_overwrites(spark, settings, sample_rules, result):
    again = run(spark, settings, "202407", [MEMBER2], *sample_rules)
    assert again.table(MEMBER2, "silver_c").count() == 3


def test_one_plan_for_the_last_stage_only(spark, settings, sample_rules):
    narrow = Settings(bronze_schema="raw", silver_schema="clean_c")
    out = run(spark, narrow, "202407", [PHARMACY1], *sample_rules, materialize=("silver_c",))
    assert list(out.written) == [(PHARMACY1, "silver_c")]
    assert out.table(PHARMACY1, "silver_c").count() == 6


def test_stages_one_by_one(spark, sample_rules, as_rows, result):
    s = Settings(bronze_schema="raw", silver_schema="steps")
    for stage in ("silver_a", "silver_b", "silver_c"):
        out = run(spark, s, "202407", [PHARMACY1], *sample_rules, stages=[stage])
        assert list(out.written) == [(PHARMACY1, stage)]
    columns = ["patient_id", "drug_name", "quantity", "quality_score"]
    whole = result.table(PHARMACY1, "silver_c")
    assert as_rows(out.table(PHARMACY1, "silver_c"), *columns) == as_rows(whole, *columns)
    fresh = Settings(bronze_schema="raw", silver_schema="steps_absent")
    late = run(spark, fresh, "202407", [PHARMACY1], *sample_rules, stages=["silver_b", "silver_c"])
    assert late.table(PHARMACY1, "silver_b").columns == ["placeholder"]
    assert late.checks[PHARMACY1, "silver_b"] is False
    for wrong in ([], ["silver_a", "silver_c"], ["gold"]):
        with pytest.raises(ValueError, match="consecutive"):
            run(spark, s, "202407", [PHARMACY1], *sample_rules, stages=wrong)


def test_pass_through_and_disabled_validation(spark, sample_rules):
    loose = Settings(bronze_schema="raw", silver_schema="loose", validation_enabled=False)
    out = run(spark, loose, "202407", [PHARMACY1], *sample_rules, finalize=False)
    final = out.table(PHARMACY1, "silver_c")
    assert final.columns == ["drug_name", "patient_id", "prescription_date", "quantity"]
    assert final.count() == 8


def test_rejected_rules_are_logged_but_do_not_stop_the_run(spark, sample_rules):
    s = Settings(bronze_schema="raw", silver_schema="odd")
    bad = rules.transform_rules(spark, [(*MEMBER2, "gender", "UPPER(gender", "FUNCTION", 1)])
    out = run(spark, s, "202407", [MEMBER2], sample_rules[0], bad)
    assert out.table(MEMBER2, "silver_c").count() == 3
    logged = out.errors.first()
    assert logged["error_type"] == "RejectedRule" and "gender" in logged["additional_context"]


def test_a_failing_combination_does_not_stop_the_others(spark, sample_rules):
    s = Settings(bronze_schema="raw", silver_schema="broken")
    schema = rules.schema_rules(spark, [(*PHARMACY1, "no_such_column", "STRING", True)])
    data_error = rules.transform_rules(spark, [(*MEMBER2, "plan_code", "CAST(plan_code AS INT)", "CAST", 1)])
    combos = [PHARMACY1, MEMBER2, PHARMACY2]
    with pytest.raises(RunFailed) as failure:
        run(spark, s, "202407", combos, schema, data_error)
    got = failure.value.result
    assert sorted(got.failed) == sorted([PHARMACY1, MEMBER2])
    assert got.table(PHARMACY2, "silver_c").count() == 4
    assert {(r["domain"], r["stage"]) for r in got.errors.collect()} == {
        ("pharmacy", "silver_a"), ("member", "silver_b"),
    }
    by_type = summary.error_summary(got.errors)
    assert by_type.filter(F.col("error_type").isNull()).first()["error_count"] == 2
    assert summary.latest_errors(got.errors).count() == 2
    calm = run(spark, s, "202407", combos, schema, data_error, raise_failures=False,
               on_error="passthrough")
    assert calm.failed == [MEMBER2]


def test_the_result_does_not_depend_on_parallelism(spark, sample_rules, as_rows):
    s = Settings(bronze_schema="raw", silver_schema="serial")
    out = run(spark, s, "202407", list(BRONZE), *sample_rules, parallel=1)
    wide = Settings(bronze_schema="raw", silver_schema="wide")
    other = run(spark, wide, "202407", list(BRONZE), *sample_rules, parallel=8)
    for c in BRONZE:
        a, b = (r.table(c, "silver_c").drop("processed_timestamp") for r in (out, other))
        assert as_rows(a) == as_rows(b)


def test_an_empty_run(spark, settings):
    assert run(spark, settings, "202407", []).written == {}


def test_combinations_in_flight_share_no_local_properties(spark, settings, sample_rules):
    both, seen = threading.Barrier(2, timeout=60), []

    def probe(df):
        mine = str(threading.get_ident())
        spark.sparkContext.setLocalProperty("oreworks.probe", mine)
        both.wait()
        seen.append(spark.sparkContext.getLocalProperty("oreworks.probe") == mine)
        both.wait()
        return {}

    run(spark, settings, "202407", [PHARMACY1, MEMBER1], *sample_rules, parallel=2, expectations={"silver_a": probe})
    assert seen == [True, True]
