import pytest
from samples import BRONZE, MEMBER1, PHARMACY1

from oreworks.model import Combination, Settings, SourceSpec
from oreworks.plans.tuning import session_conf
from oreworks.sources import rules, tables

SETTINGS = Settings(
    schema_rules_table="rule_store.schema_definitions",
    transform_rules_table="rule_store.transform_definitions",
    sources=(SourceSpec("source1", ("lob1", "lob2"), ("pharmacy", "member")),),
)


def test_settings_from_mapping():
    raw = {
        "pipeline": {"bronze_schema": "raw", "silver_schema": "clean"},
        "tables": {"schema_rules": "r.s", "transform_rules": "r.t"},
        "sources": [{"name": "s", "lobs": ["l"], "domains": ["mbr"]}],
        "data_quality": {"null_tolerance_percent": 7, "validation_enabled": False},
    }
    settings = Settings.from_mapping(raw)
    assert settings.combinations() == [Combination("s", "l", "mbr")]
    assert (settings.null_tolerance_percent, settings.validation_enabled) == (7, False)
    assert tables.bronze_table(settings, Combination("s", "l", "mbr"), "202407") == (
        "raw.s_l_mbr_202407_bronze"
    )


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"pipeline": {"bronze_schema": "b"}}, "silver_schema"),
        ({"tables": {}}, "transform_rules"),
        ({"sources": []}, "must not be empty"),
        ({"sources": [{"name": "s", "lobs": []}]}, "lacks domains"),
        ({"sources": [{"name": "s", "lobs": ["l"], "domains": ["vision"]}]}, "vision"),
    ],
)
def test_settings_name_their_problems(change, message):
    raw = {
        "pipeline": {"bronze_schema": "b", "silver_schema": "s"},
        "tables": {"schema_rules": "r.s", "transform_rules": "r.t"},
        "sources": [{"name": "s", "lobs": ["l"], "domains": ["member"]}],
        **change,
    }
    with pytest.raises(ValueError, match=message):
        Settings.from_mapping(raw)
    with pytest.raises(ValueError, match="missing section"):
        Settings.from_mapping({})


def test_names():
    c = Combination("s", "l", "d")
    assert tables.silver_table(Settings(), c, "silver_a") == "silver.s_l_d_silver_a"
    assert tables.silver_table(Settings(), c, "silver_c", "2024") == "silver.s_l_d_2024_silver_c"
    assert tables.bronze_table(Settings(bronze_suffix=""), c, "202407") == "bronze.s_l_d_202407"


def test_year_month(spark):
    assert tables.year_month(spark) == "202407"
    assert tables.year_month(spark, "202501") == "202501"
    spark.conf.set("pipeline.year_month", "202412")
    try:
        assert tables.year_month(spark) == "202412"
    finally:
        spark.conf.unset("pipeline.year_month")


def test_rule_tables_are_seeded_once(spark):
    for _ in range(2):
        rules.create_rule_tables(spark, SETTINGS, sample=True)
    assert spark.table(SETTINGS.schema_rules_table).count() == 9
    assert spark.table(SETTINGS.transform_rules_table).count() == 6
    stored = spark.table(SETTINGS.transform_rules_table)
    found = rules.lookup_transform_rules(stored, PHARMACY1).collect()
    assert [r["field_name"] for r in found] == ["drug_name", "patient_id", "quantity"]
    assert stored.filter("created_date IS NULL").count() == 0


def test_lookups_cannot_be_injected(spark):
    frame = rules.schema_rules(spark, rules.SAMPLE_SCHEMA_RULES)
    nasty = Combination("source1' OR '1'='1", "lob1", "pharmacy")
    assert rules.lookup_schema_rules(frame, nasty).count() == 0


def test_collect_rules_matches_the_lookups(spark):
    frame = rules.transform_rules(
        spark,
        [(*PHARMACY1, "b", "2", "FUNCTION", 2), (*PHARMACY1, "b", "1", "FUNCTION", 1),
         (*PHARMACY1, "a", "3", None, 1), (*MEMBER1, "z", "4", None, None)],
    )
    got = rules.collect_rules(frame, [PHARMACY1, MEMBER1, Combination("no", "such", "one")])
    want = rules.lookup_transform_rules(frame, PHARMACY1).collect()
    assert [r["transform"] for r in got[PHARMACY1]] == [r["transform"] for r in want]
    assert [r["transform"] for r in got[PHARMACY1]] == ["3", "1", "2"]
    assert [len(v) for v in got.values()] == [3, 1, 0]


def test_groups_of_combinations_hold_all():
    combos = SETTINGS.combinations()
    for size in (1, 2, len(combos), 100):
        assert [c for some in rules.in_groups(combos, size) for c in some] == combos


def test_unknown_type_names_are_a_finding(spark):
    kinds = ["STRING", "decimal(10, 2)", "array<int>", "VARCHR", None, "timestamp_ntz"]
    frame = rules.schema_rules(spark, [(*PHARMACY1, f"f{i}", k, False) for i, k in enumerate(kinds)])
    found = rules.lint_rules(frame).collect()
    assert [(r["field_name"], r["finding"]) for r in found] == [("f3", "unknown_type")]


def test_combinations_frame_matches_the_settings(spark, as_rows):
    frame = rules.combinations(rules.config_frame(spark, SETTINGS))
    assert as_rows(frame) == sorted(tuple(c) for c in SETTINGS.combinations())


def test_dedup_keys():
    s = Settings()
    assert s.keys_for("pharmacy") == ("patient_id", "ndc", "service_date")
    assert s.keys_for("mbr") == s.keys_for("member") == ("member_id", "effective_date")
    assert s.keys_for("other") == ("patient_id", "service_date")


def test_lint(spark, bronze, as_rows):
    frame = rules.schema_rules(
        spark,
        [(*PHARMACY1, "cost", "DOUBLE", True), (*PHARMACY1, "cost", "DOUBLE", True),
         (*PHARMACY1, "Drug_Name", "STRING", None), (*PHARMACY1, "nope", "STRING", None),
         ("s", "l", "vision", "x", "STRING", None), (None, "l", "member", "x", "STRING", None)],
    )
    columns = tables.table_columns({PHARMACY1: bronze[PHARMACY1]})
    found = rules.lint_rules(frame, table_columns=columns)
    assert as_rows(found, "field_name", "finding") == [
        ("Drug_Name", "case_mismatch"),
        ("cost", "duplicate_rule"),
        ("x", "invalid_domain"),
        ("x", "null_key"),
    ]


def test_inventory_lists_missing_tables(spark, bronze, as_rows):
    frames = {c.label: bronze[c] for c in BRONZE}
    found = tables.inventory({**frames, "not_there": None})
    assert as_rows(found)[0] == ("not_there", False, 0, 0)
    assert as_rows(found.filter("exists"), "row_count") == [(4,), (4,), (7,), (7,), (8,)]
    assert as_rows(tables.inventory({"x": None})) == [("x", False, 0, 0)]
    assert as_rows(tables.catalog_inventory(spark, ["no_such_table"])) == [
        ("no_such_table", False, 0, 0)
    ]
    assert tables.inventory({}).count() == 0


def test_sample_rows(spark):
    assert [r["id"] for r in tables.sample_rows(spark.range(9), 2, "id").collect()] == [0, 1]
    assert tables.sample_rows(spark.range(9), 4).count() == 4


def test_session_conf_scales_with_the_input():
    small = session_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    middle = session_conf(100 << 30, 64)
    assert middle["spark.sql.shuffle.partitions"] == "400"
    huge = session_conf(100 << 40, 4000)
    assert huge["spark.sql.shuffle.partitions"] == str((100 << 40) // (256 << 20))
    wide = session_conf(100 << 40, 4000, split_bytes=1 << 30)
    assert int(wide["spark.sql.files.maxPartitionBytes"]) > int(
        small["spark.sql.files.maxPartitionBytes"]
    )
