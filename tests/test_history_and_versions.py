"""Stored history by run, versions of stage tables, months side by side, and dropped rows."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from oreworks.model import Combination, Settings
from oreworks.operators.expectations import Expectation, TableExpectation
from oreworks.plans.pipeline import run
from oreworks.sources import rules, sinks, versions
from oreworks.sources.history import expire, store_rows

SALES = Combination("s", "l", "sales")
OTHER = Combination("s 1", "l/2", "50%=x")
LOG = "source string, lob string, domain string, what string, at timestamp"
NOW = datetime(2024, 9, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module", autouse=True)
def schemas(spark):
    for name in ("hist", "ver_raw", "ver"):
        sinks.ensure_schema(spark, name)


def logged(spark, *rows):
    return spark.createDataFrame([(*c, what, NOW - timedelta(days=age)) for c, what, age in rows], LOG)


def kept(spark, table):
    return sorted((r.run, r.domain, r.what) for r in spark.table(table).collect())


def test_runs_and_combinations_stay_apart(spark):
    table = "hist.apart"
    store_rows(logged(spark, (SALES, "a", 0), (OTHER, "b", 0)), table, "202407", [SALES, OTHER])
    store_rows(logged(spark, (SALES, "c", 0), (SALES, "d", 0)), table, "202408", [SALES])
    assert kept(spark, table) == [("202407", OTHER.domain, "b"), ("202407", "sales", "a"), ("202408", "sales", "c"), ("202408", "sales", "d")]
    store_rows(logged(spark, (SALES, "e", 0)), table, "202408", [SALES])
    store_rows(logged(spark, (OTHER, "f", 0)), table, "202407", [OTHER])
    assert kept(spark, table) == [("202407", OTHER.domain, "f"), ("202407", "sales", "a"), ("202408", "sales", "e")]


def test_a_clean_run_clears_what_it_covers(spark):
    table = "hist.cleared"
    store_rows(logged(spark, (SALES, "a", 0), (OTHER, "b", 0)), table, "202407", [SALES, OTHER])
    store_rows(logged(spark).limit(0), table, "202407", [OTHER])
    assert kept(spark, table) == [("202407", "sales", "a")]
    store_rows(logged(spark).limit(0), table, "202408", [SALES])
    assert kept(spark, table) == [("202407", "sales", "a")]
    store_rows(logged(spark).limit(0), table, "202407", [SALES])
    assert kept(spark, table) == []


def test_rows_without_a_combination_are_kept(spark):
    rows = spark.createDataFrame([(None, None, None, "x", NOW)], LOG)
    for _ in range(2):
        store_rows(rows, "hist.unnamed", "202407", [])
    assert kept(spark, "hist.unnamed") == [("202407", None, "x")]


def test_the_setting_of_the_session_is_left_alone(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    store_rows(logged(spark, (SALES, "a", 0)), "hist.setting", "1", [SALES])
    store_rows(logged(spark, (SALES, "a", 0)), "hist.setting", "1", [SALES])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_old_runs_expire_by_their_newest_row(spark):
    table = "hist.aged"
    store_rows(logged(spark, (SALES, "old", 40), (OTHER, "older", 90)), table, "202406", [SALES])
    store_rows(logged(spark, (SALES, "old", 40), (OTHER, "new", 3)), table, "202407", [SALES])
    assert expire(spark, table, "at", 30, NOW) == ["202406"]
    assert {r[0] for r in kept(spark, table)} == {"202407"}
    assert expire(spark, "hist.not_there", "at", 30, NOW) == []


# --------------------------------------------------------------------------
# Versions
# --------------------------------------------------------------------------


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def write(spark, table, rows, **options):
    return sinks.write_measured(spark.range(rows), table, "said", {"quality": "silver"}, **options)


def test_versions_replace_each_other_and_roll_back(spark):
    table = "ver.plain"
    for rows in (1, 2, 3):
        write(spark, table, rows, keep=2)
    assert ids(spark.table(table)) == [0, 1, 2]
    assert versions.versions(spark, table) == [2, 3]
    assert versions.rollback(spark, table) == 2
    assert ids(spark.table(table)) == [0, 1]
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert shown["quality"] == "silver"
    with pytest.raises(LookupError):
        versions.rollback(spark, table)
    write(spark, table, 5, keep=2)  # what was published before stays, not what was rolled back
    assert versions.versions(spark, table) == [2, 4]


def test_a_write_that_fails_changes_nothing(spark):
    table = "ver.failing"
    write(spark, table, 2)
    broken = spark.range(100).withColumn("x", F.when(F.col("id") == 70, F.raise_error(F.lit("no"))))
    with pytest.raises(PySparkException):
        sinks.write_measured(broken, table)
    assert ids(spark.table(table)) == [0, 1]
    write(spark, table, 3)
    assert ids(spark.table(table)) == [0, 1, 2]


def test_readers_of_the_version_before_are_not_disturbed(spark):
    write(spark, "ver.read", 2)
    reader = spark.table("ver.read")
    write(spark, "ver.read", 4)
    assert ids(reader) == [0, 1] and ids(spark.table("ver.read")) == [0, 1, 2, 3]


def test_a_table_from_before_versions_becomes_one(spark):
    spark.range(7).write.saveAsTable("ver.former")
    write(spark, "ver.former", 2)
    assert versions.versions(spark, "ver.former") == [0, 1]
    assert versions.rollback(spark, "ver.former") == 0
    assert ids(spark.table("ver.former")) == list(range(7))


def test_months_are_replaced_one_at_a_time_and_pruned(spark):
    table = "ver.months"
    write(spark, table, 2, month="202407")
    sinks.write_measured(spark.range(3).withColumn("more", F.lit("x")), table, month="202408")
    sinks.write_measured(spark.range(1).withColumn("more", F.lit("y")), table, month="202408")
    got = sorted((r.year_month, r.id, r.more) for r in spark.table(table).collect())
    assert got == [("202407", 0, None), ("202407", 1, None), ("202408", 0, "y")]
    july = spark.table(table).where("year_month = '202407'")
    plan = july._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "months_202407__v1" in plan
    assert versions.rollback(spark, table, "202408") == 1
    assert spark.table(table).count() == 5
    with pytest.raises(ValueError, match="kept by month"):
        write(spark, table, 1)
    with pytest.raises(ValueError, match="more is string in one month"):
        sinks.write_measured(spark.range(1).withColumn("more", F.lit(1)), table, month="202406")
    assert spark.table(table).count() == 5


# --------------------------------------------------------------------------
# Runs
# --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def runs(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (2, 9, "a"), (3, None, "c"), (4, 1, None)]
    frame = spark.createDataFrame(rows, "k int, v int, w string")
    for month in ("202407", "202408"):
        frame.write.mode("overwrite").saveAsTable(f"ver_raw.{SALES.label}_{month}_bronze")
        frame = frame.where("k < 3")
    none = rules.schema_rules(spark, []), rules.transform_rules(spark, [])

    def go(schema, month="202407", monthly=False, keys_once=False, **options):
        settings = Settings(bronze_schema="ver_raw", silver_schema=schema, dedup_keys={"sales": ("k", "w")}, monthly=monthly, keys_once=keys_once)
        return run(spark, settings, month, [SALES], *none, **options)

    return go


def low(df):
    return {"low": Expectation(F.col("v") < 9, "drop"), "named": Expectation(F.col("w").isNotNull(), "drop"), "not_a": F.col("w") != "a"}


def test_drops_hold_whatever_is_written(runs):
    all_ = runs("ver_all", expectations={"silver_b": low})
    last = runs("ver_last", expectations={"silver_b": low}, materialize=("silver_c",))
    key = lambda r: sorted((x.k, x.w) for x in r.table(SALES, "silver_c").collect())
    assert key(all_) == key(last) == [(1, "a"), (1, "b")]
    assert (SALES, "silver_b") not in last.violations


def test_fail_holds_whatever_is_written(runs):
    guard = {"silver_a": lambda df: {"named": Expectation(F.col("w").isNotNull(), "fail")}}
    result = runs("ver_guard", expectations=guard, materialize=("silver_c",), raise_failures=False)
    assert result.failed == [SALES] and not result.written


def test_stages_asked_for_must_be_there(runs):
    for wrong in (
        {"expectations": {"silver_d": low}},
        {"table_expectations": {"gold": TableExpectation(1)}},
        {"materialize": ("silver_x",)},
        {"table_expectations": {"silver_b": TableExpectation(1)}, "materialize": ("silver_c",)},
        {"expectations": {"silver_a": low}, "stages": ("silver_b", "silver_c")},
    ):
        with pytest.raises(ValueError, match="stages"):
            runs("ver_wrong", **wrong)


def test_dropped_rows_stay_beside_the_table(spark, runs):
    plain = runs("ver_drop", expectations={"silver_b": low, "silver_c": low})
    split = runs("ver_quarantine", expectations={"silver_b": low, "silver_c": low}, quarantine=True)
    rows = lambda df: sorted(map(str, df.drop("processed_timestamp").collect()))
    for stage in ("silver_b", "silver_c"):
        assert split.table(SALES, stage).columns == plain.table(SALES, stage).columns
        assert rows(split.table(SALES, stage)) == rows(plain.table(SALES, stage))
    assert split.violations == plain.violations and split.score_rows == plain.score_rows
    assert [r[5] for r in split.log_rows] == [r[5] for r in plain.log_rows]
    dropped = {(r.k, r.w): r.broken_checks for r in split.dropped(SALES, "silver_b").collect()}
    assert dropped == {(2, "a"): ["low"], (3, "c"): ["low"], (4, None): ["named"]}
    # One job has written both sides: one version, with a partition each.
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {split.written[SALES, 'silver_b']}__v1").collect()]
    assert sorted(names) == ["row_verdict=dropped", "row_verdict=kept"]
    runs("ver_quarantine", expectations={})
    assert not spark.catalog.tableExists("ver_quarantine.s_l_sales_silver_b_dropped")
    assert split.table(SALES, "silver_b").count() == 5


def test_months_of_a_run(spark, runs):
    first = runs("ver_monthly", "202407", monthly=True)
    second = runs("ver_monthly", "202408", monthly=True)
    assert first.written[SALES, "silver_c"] == "ver_monthly.s_l_sales_2024_silver_c"
    assert (first.table(SALES, "silver_c").count(), second.table(SALES, "silver_c").count()) == (5, 3)
    assert "year_month" not in first.table(SALES, "silver_c").columns
    again = runs("ver_monthly", "202408", monthly=True, stages=("silver_c",), now=F.lit(NOW))
    assert again.table(SALES, "silver_c").count() == 3
    counts = spark.table("ver_monthly.s_l_sales_2024_silver_c").groupBy("year_month").count().collect()
    assert {r[0]: r[1] for r in counts} == {"202407": 5, "202408": 3}
    missing = runs("ver_monthly", "202409", monthly=True, stages=("silver_b",), on_missing_input="fail", raise_failures=False)
    assert missing.failed == [SALES]


def test_a_key_stays_in_its_first_month(spark, runs):
    frame = lambda *rows: spark.createDataFrame(list(rows), "k int, v int, w string")
    months = {
        "202311": frame((1, 5, "a"), (4, 1, None), (None, 2, None)),
        "202401": frame((1, 6, "a"), (4, 7, None), (5, 1, "b"), (5, 1, "b"), (None, 3, None)),
        "202402": frame((5, 2, "b"), (1, 9, "z"), (None, 1, "q")),
    }
    for month, rows in months.items():
        rows.write.mode("overwrite").saveAsTable(f"ver_raw.{SALES.label}_{month}_bronze")
    options = {"monthly": True, "keys_once": True}

    def final(month, **more):
        found = runs("ver_once", month, **options, **more).table(SALES, "silver_c")
        return sorted((tuple(r) for r in found.select("k", "w").collect()), key=repr)

    first, second, third = [(1, "a"), (4, None), (None, None)], [(5, "b")], [(1, "z"), (None, "q")]
    assert final("202311") == first and final("202401") == second and final("202402") == third
    # A month that is run again meets the months before it, not its own rows or later ones.
    assert final("202401") == second and final("202311") == first
    # One plan without written stages gives the same rows.
    assert final("202402", materialize=("silver_c",)) == third


def test_a_key_once_needs_months_and_their_key_columns(spark, runs):
    with pytest.raises(ValueError, match="monthly"):
        Settings(keys_once=True)
    with pytest.raises(ValueError, match="missing section 'sources'.*keys_once needs tables.monthly"):
        Settings.from_mapping({"pipeline": {}, "tables": {}, "deduplication": {"keys_once": True}})
    # A year whose only month had no input compares with nothing.
    empty = runs("ver_once_empty", "202212", monthly=True, keys_once=True)
    assert empty.table(SALES, "silver_c").count() == 0
    assert runs("ver_once_empty", "202407", monthly=True, keys_once=True).table(SALES, "silver_c").count() == 5
    spark.createDataFrame([(1,)], "k int").write.mode("overwrite").saveAsTable(f"ver_raw.{SALES.label}_202201_bronze")
    runs("ver_once_short", "202201", monthly=True, keys_once=True)
    short = runs("ver_once_short", "202407", monthly=True, keys_once=True, raise_failures=False)
    assert short.failed == [SALES] and "not in the table" in short.error_rows[0][7]
