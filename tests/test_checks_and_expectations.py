import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from samples import BRONZE, MEMBER2, PHARMACY1, PHARMACY2

from oreworks.functions.types import type_matches
from oreworks.model import QUALITY_METRICS, Settings
from oreworks.operators import checks, expectations, report, summary
from oreworks.operators.score import add_metadata, add_quality_score
from oreworks.plans.quality import quality_run
from oreworks.sources import rules
from oreworks.sources.tables import empty_quality_metrics, placeholder, table_columns

PHARMACY_FIELDS = ["patient_id", "prescription_date", "drug_name"]


@pytest.fixture(scope="module")
def sample_rules(spark):
    return rules.schema_rules(spark, rules.SAMPLE_SCHEMA_RULES)


def pharmacy(sample_rules):
    return rules.for_combination(sample_rules, PHARMACY1)


def test_schema_compliance_of_the_samples(spark, bronze, sample_rules, as_rows):
    columns = table_columns({PHARMACY1: bronze[PHARMACY1]})
    found = checks.schema_findings(pharmacy(sample_rules), columns)
    assert as_rows(found, "check_type", "field_name", "status") == [
        ("extra_field", f, "WARN") for f in ("cost", "days_supply", "pharmacy_id", "prescriber_id")
    ]
    verdict = checks.schema_compliance(pharmacy(sample_rules), columns).first()
    assert (verdict["overall_status"], verdict["extra_fields"]) == ("WARN", 4)


def test_missing_required_fails_and_missing_optional_is_silent(spark, bronze, sample_rules, as_rows):
    columns = table_columns({PHARMACY1: bronze[PHARMACY1].select("patient_id", "drug_name")})
    found = checks.schema_findings(pharmacy(sample_rules), columns)
    assert as_rows(found, "field_name", "status", "message") == [
        ("prescription_date", "FAIL", "Required field prescription_date is missing")
    ]
    verdict = checks.schema_compliance(pharmacy(sample_rules), columns).first()
    assert verdict["overall_status"] == "FAIL"


def test_types_of_the_samples(bronze, sample_rules, as_rows):
    columns = table_columns({PHARMACY1: bronze[PHARMACY1]})
    found = checks.type_checks(pharmacy(sample_rules), columns)
    assert as_rows(found, "status") == [("PASS",)] * 4


@pytest.mark.parametrize(
    ("expected", "actual", "matches"),
    [
        ("INTEGER", "int", True),
        ("integer", "bigint", True),
        ("INTEGER", "smallint", False),
        ("INTEGER", "interval day to second", False),
        ("DOUBLE", "float", True),
        ("STRING", "string", True),
        ("STRING", "array<string>", False),
        ("DATE", "timestamp", False),
        ("TIMESTAMP", "timestamp_ntz", True),
        ("BOOLEAN", "boolean", True),
        ("BIGINT", "bigint", True),
        ("long", "bigint", True),
        ("DECIMAL(10, 2)", "decimal(10,2)", True),
        ("numeric(10,2)", "decimal(10,3)", False),
        ("DECIMAL", "decimal(10,0)", True),
        ("ARRAY<STRING>", "array<string>", True),
        (None, "string", False),
    ],
)
def test_type_families(spark, expected, actual, matches):
    df = spark.createDataFrame([(expected, actual)], "e string, a string")
    assert df.selectExpr(type_matches("e", "a")).first()[0] is matches


def test_completeness_of_the_samples(bronze):
    found = checks.completeness(bronze[PHARMACY1], PHARMACY1, PHARMACY_FIELDS).collect()
    by_field = {r["field_name"]: r for r in found}
    assert by_field["patient_id"]["null_count"] == 1
    assert by_field["patient_id"]["completeness_percent"] == 87.5
    assert by_field["patient_id"]["status"] == "FAIL"
    assert by_field["drug_name"]["status"] == "PASS"
    assert by_field[None]["completeness_percent"] == pytest.approx(95.8333333333)
    assert by_field[None]["status"] == "FAIL"


def test_completeness_tolerance(bronze):
    found = checks.completeness(bronze[PHARMACY1], PHARMACY1, ["patient_id"], 12.5)
    assert {r["status"] for r in found.collect()} == {"PASS"}


def test_completeness_counts_absent_fields_as_complete(bronze):
    found = checks.completeness(bronze[PHARMACY1], PHARMACY1, ["patient_id", "ndc"])
    overall = found.filter("level = 'overall'").first()
    assert overall["completeness_percent"] == 93.75 and overall["missing_fields"] == ["ndc"]


def test_completeness_edge_cases(bronze):
    df = bronze[PHARMACY1]
    empty = checks.completeness(df.limit(0), PHARMACY1, ["patient_id"]).collect()
    assert [(r["level"], r["completeness_percent"], r["status"]) for r in empty] == [
        ("overall", 0.0, "WARN")
    ]
    nothing_required = checks.completeness(df, PHARMACY1, []).collect()
    assert [(r["completeness_percent"], r["status"]) for r in nothing_required] == [(100.0, "PASS")]
    all_absent = checks.completeness(df, PHARMACY1, ["ndc"]).collect()
    assert [(r["completeness_percent"], r["status"]) for r in all_absent] == [(100.0, "PASS")]


def test_duplicates_of_the_samples(bronze):
    found = checks.duplicates(bronze[MEMBER2], MEMBER2, ["member_id", "effective_date"]).first()
    assert (found["total_records"], found["unique_records"], found["duplicate_count"]) == (4, 3, 1)
    assert (found["duplicate_percentage"], found["status"]) == (25.0, "WARN")


def test_duplicates_without_keys(bronze):
    df = bronze[MEMBER2]
    assert checks.duplicates(df, MEMBER2, []).first()["status"] == "PASS"
    no_key = checks.duplicates(df, MEMBER2, ["nope"]).first()
    assert no_key["status"] == "WARN" and "No key columns" in no_key["message"]
    assert checks.duplicates(df.limit(0), MEMBER2, ["nope"]).first()["status"] == "PASS"


def test_stage_checks_report_and_never_filter(spark, bronze):
    df = bronze[PHARMACY1]
    assert checks.transformation_check(df, PHARMACY1, ["patient_id"]).first()["status"] == "PASS"
    assert checks.transformation_check(df, PHARMACY1, ["ndc"]).first()["status"] == "WARN"
    assert checks.transformation_check(df.limit(0), PHARMACY1, []).first()["metric_value"] == 0.0
    assert checks.completion_check(add_metadata(df), PHARMACY1).first()["record_count"] == 8
    assert checks.completion_check(placeholder(spark), PHARMACY1).first()["status"] == "WARN"


def test_report_has_the_metrics_schema_even_without_counts(bronze, sample_rules):
    frames = {c: bronze[c] for c in BRONZE}
    metrics = quality_run(frames, sample_rules, Settings(), include_types=True)
    assert [(f.name, f.dataType) for f in metrics.schema] == [
        (f.name, f.dataType) for f in QUALITY_METRICS.fields
    ]
    rows = metrics.collect()
    assert {r["stage"] for r in rows} == {
        "schema_validation", "completeness_validation", "duplicate_detection", "type_validation",
    }
    dups = {r["table_name"]: r for r in rows if r["stage"] == "duplicate_detection"}
    assert len(dups) == 5 and dups["source2_lob3_member"]["metric_value"] == 25.0
    only_schema = report.quality_report(
        schema=checks.schema_findings(sample_rules, table_columns(frames))
    )
    assert {r["record_count"] for r in only_schema.collect()} == {None}
    assert only_schema.unionByName(empty_quality_metrics(only_schema.sparkSession)).count() > 0


def test_report_of_nothing_is_empty(spark):
    assert report.quality_report().schema == QUALITY_METRICS
    assert report.quality_report().count() == 0


def test_history_is_filtered_and_newest_first(spark):
    metrics = spark.createDataFrame(
        [("s", "d", 1), ("s", "d", 3), ("s", "e", 2), ("t", "d", 2)],
        "source string, domain string, created_timestamp int",
    )
    found = report.quality_history(metrics, "s", "d").collect()
    assert [r["created_timestamp"] for r in found] == [3, 1]
    assert report.quality_history(metrics).count() == 4


# --------------------------------------------------------------------------


def test_null_predicates_are_violations(spark):
    df = spark.createDataFrame([(5.0,), (None,), (-1.0,)], "amount double")
    found = expectations.expectation_counts(df, expectations.valid_amount_range()).first()
    assert (found["total_records"], found["violations"], found["status"]) == (3, 2, "WARN")
    assert expectations.expect(df, expectations.valid_amount_range(), "drop").count() == 1


def test_actions(spark):
    df = spark.createDataFrame([("a",), (None,)], "patient_id string")
    check = expectations.not_null("patient_id")
    assert expectations.expect(df, check).count() == 2
    assert expectations.expect(df, check, "drop").count() == 1
    with pytest.raises(Exception, match="patient_id_not_null violated"):
        expectations.expect(df, check, "fail").count()
    assert expectations.expect(df.dropna(), check, "fail").count() == 1
    with pytest.raises(ValueError):
        expectations.expect(df, check, "explode")


def test_fail_is_not_optimised_away(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, patient_id string")
    guarded = expectations.expect(df, expectations.not_null("patient_id"), "fail")
    for use in (guarded.select("n"), guarded.groupBy().sum("n"), guarded.filter("n > 0")):
        with pytest.raises(Exception, match="violated"):
            use.collect()


def test_observed_counts_ride_on_the_same_job(spark):
    df = spark.createDataFrame([("a",), (None,)], "patient_id string")
    seen = Observation()
    kept = expectations.expect(df, expectations.not_null("patient_id"), "drop", seen)
    assert kept.count() == 1 and seen.get == {"patient_id_not_null": 1}


def test_minimum_records(spark):
    df = spark.range(3)
    assert expectations.expectation_counts(df, {}, 1).first()["status"] == "PASS"
    assert expectations.expectation_counts(df, {}, 4).first()["violations"] == 1
    assert expectations.expectation_counts(df.limit(0), {}, 1).first()["status"] == "WARN"
    with pytest.raises(ValueError):
        expectations.expectation_counts(df, {})


def test_date_format_works_on_dates_and_strings(spark):
    df = spark.createDataFrame([("2024-07-01",), ("07/01/2024",), (None,)], "service_date string")
    check = expectations.valid_date_format()
    assert expectations.expectation_counts(df, check).first()["violations"] == 2
    dates = spark.sql("SELECT DATE '2024-07-01' AS service_date")
    assert expectations.expectation_counts(dates, check).first()["violations"] == 0


def test_recent_reaches_back_to_midnight_of_the_day_before(spark):
    stamps = ["2024-01-18 23:59:59", "2024-01-19 00:00:00", "2024-01-20 10:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        F.to_timestamp("s").alias("processed_timestamp")
    )
    now = F.to_timestamp(F.lit("2024-01-20 15:30:00"))
    check = expectations.recent_processing_timestamp(df, now)
    assert expectations.expectation_counts(df, check).first()["violations"] == 1


def test_column_expectations_hold_without_the_column(spark):
    df = spark.range(2)
    named = {
        **expectations.acceptable_quality_scores(df),
        **expectations.recent_processing_timestamp(df),
        **expectations.correct_pipeline_stage(df),
    }
    found = expectations.expectation_counts(df, named).collect()
    assert [r["status"] for r in found] == ["PASS"] * 3


def test_duplicate_expectation_without_keys(bronze):
    found = expectations.no_duplicates_on_business_keys(bronze[MEMBER2], ["nope"]).first()
    assert (found["total_records"], found["violations"]) == (4, 0)


# --------------------------------------------------------------------------


def test_score_statistics(bronze):
    stats = summary.quality_stats(add_quality_score(bronze[PHARMACY2])).first()
    assert stats["avg_quality"] == pytest.approx(0.97)
    assert (stats["min_quality"], stats["max_quality"]) == (0.88, 1.0)
    empty = summary.quality_stats(add_quality_score(bronze[PHARMACY2]).limit(0)).first()
    assert tuple(empty) == (None, None, None)


def test_rows_removed_without_a_key(bronze):
    assert summary.removed_by_dedup(bronze[MEMBER2], ["nope"]).first()["rows_removed"] == 0


def test_throughput_of_no_time_is_zero(spark):
    log = spark.createDataFrame([(10, 0.0), (10, 2.0)], "record_count bigint, seconds double")
    rates = [r["records_per_second"] for r in summary.throughput(log).collect()]
    assert sorted(rates) == [0.0, 5.0]


def test_error_summaries_of_an_empty_log(spark):
    from oreworks.sources.tables import empty_error_log

    assert [tuple(r) for r in summary.error_summary(empty_error_log(spark)).collect()] == [(None, 0)]
    assert summary.latest_errors(empty_error_log(spark)).count() == 0


@pytest.mark.parametrize("required", [[], ["k"], ["k", "v", "not there", "a.b"], ["v", "v"]])
@pytest.mark.parametrize("keys", [[], ["k"], ["k", "a.b"], ["gone"], ["v", "gone", "v"]])
@pytest.mark.parametrize("rows", [0, 6])
def test_one_scan_finds_what_two_checks_find(spark, as_rows, required, keys, rows):
    from oreworks.model import Combination
    from oreworks.operators import checks, report

    data = [(1, None, "x"), (1, None, "x"), (None, 2, None), (None, 2, "y"), (3, 4, "z"), (3, 5, None)]
    df = spark.createDataFrame(data[:rows], "k int, v int, `a.b` string")
    c = Combination("s", "l", "d")
    both = report.quality_report(
        completeness=[checks.completeness(df, c, required)], duplicates=[checks.duplicates(df, c, keys)]
    )
    one = report.quality_report(tables=[checks.table_findings(df, c, required, keys)])
    assert one.schema == both.schema or one.columns == both.columns
    assert as_rows(one.drop("created_timestamp")) == as_rows(both.drop("created_timestamp"))
