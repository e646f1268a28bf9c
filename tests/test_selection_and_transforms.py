import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from samples import PHARMACY1

from oreworks.functions.expressions import may_read, quote_references
from oreworks.operators.required import drop_incomplete, drop_low_quality
from oreworks.operators.selection import required_fields, rule_fields, select_by_rules
from oreworks.operators.transform import (
    _batches,
    field_major,
    transform_by_rules,
    transform_with_outcomes,
)
from oreworks.plans.silver import silver_a, silver_b, silver_c
from oreworks.sources.rules import schema_rule_list, transform_rule_list


def statuses(outcomes):
    return {(o.field_name, o.transform): o.status for o in outcomes}


def test_no_rules_keep_every_column(bronze):
    df = bronze[PHARMACY1]
    assert select_by_rules(df, []).columns == df.columns


def test_selection_follows_rule_order_and_skips_absent_fields(bronze):
    rules = schema_rule_list([("quantity", "INTEGER", False), ("cost", "DOUBLE", None),
                              ("nope", "STRING", True)])
    assert select_by_rules(bronze[PHARMACY1], rules).columns == ["cost", "quantity"]


def test_selection_matches_case_sensitively(bronze):
    rules = schema_rule_list([("COST", "DOUBLE", True)])
    with pytest.raises(ValueError):
        select_by_rules(bronze[PHARMACY1], rules)
    kept = select_by_rules(bronze[PHARMACY1], rules, on_error="passthrough")
    assert kept.columns == bronze[PHARMACY1].columns


def test_duplicate_rules_select_a_column_once():
    rules = schema_rule_list([("a", "STRING", None), ("a", "STRING", True), ("b", "STRING", None)])
    assert rule_fields(rules) == ["a", "b"]
    assert required_fields(rules) == ["a"]


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1, "x", None)], "`a.b` int, `c d` string, `e``f` string")
    rules = schema_rule_list([("a.b", "INTEGER", True), ("c d", "STRING", True),
                              ("e`f", "STRING", False)])
    a = silver_a(df, rules)
    assert a.columns == ["a.b", "c d", "e`f"] and a.count() == 1
    b = transform_by_rules(a, transform_rule_list([("c d", "UPPER(`c d`)", 1), ("a.b", "a.b + 1", 1)]))
    assert tuple(b.first()) == (2, "X", None)
    c = silver_c(b, ["a.b"]).first()
    assert str(c["quality_score"]) == "0.67"


def test_required_filter_ignores_absent_fields_and_can_be_off(bronze):
    df = bronze[PHARMACY1]
    assert drop_incomplete(df, ["patient_id", "nope"]).count() == 7
    assert drop_incomplete(df, ["patient_id"], enabled=False).count() == 8


def test_empty_string_is_not_null(spark):
    df = spark.createDataFrame([("",), (None,)], "a string")
    assert drop_incomplete(df, ["a"]).count() == 1


def test_quality_filter_needs_the_column(spark):
    df = spark.range(3)
    assert drop_low_quality(df) is df


def test_rounding_comes_before_the_threshold(spark):
    df = spark.createDataFrame([("0.695",), ("0.694",)], "q string")
    scored = df.select(F.col("q").cast("double").cast("decimal(3,2)").alias("quality_score"))
    assert drop_low_quality(scored).count() == 1


def test_field_major_order():
    rules = transform_rule_list([("b", "b1", 1), ("a", "a2", 2), ("b", "b3", 3), ("c", "c1", 1)])
    assert [r["transform"] for r in field_major(rules)] == ["b1", "b3", "c1", "a2"]


def test_batches_split_on_dependence_only():
    rules = transform_rule_list([("a", "UPPER(a)", 1), ("b", "UPPER(b)", 1), ("c", "CONCAT(a, c)", 1)])
    assert [[r["field_name"] for r in b] for b in _batches(field_major(rules))] == [["a", "b"], ["c"]]
    twice = transform_rule_list([("a", "UPPER(a)", 1), ("a", "TRIM(a)", 2)])
    assert [len(b) for b in _batches(field_major(twice))] == [1, 1]


def test_a_later_rule_sees_the_rewritten_column_whatever_its_spelling(spark):
    df = spark.createDataFrame([(1, 10)], "a int, b int")
    rules = transform_rule_list([("a", "a + 1", 1), ("b", "A * 100", 2)])
    assert tuple(transform_by_rules(df, rules).first()) == (2, 200)
    star = transform_rule_list([("a", "a + 1", 1), ("b", "CAST(hash(*) AS INT)", 2)])
    want = df.selectExpr("a + 1 AS a", "b").selectExpr("a", "hash(*) AS b").first()
    assert tuple(transform_by_rules(df, star).first()) == tuple(want)


def test_bad_rules_cost_only_themselves(spark):
    df = spark.createDataFrame([("x", 1)], "name string, n int")
    rules = transform_rule_list(
        [
            ("name", "UPPER(name", 1),
            ("name", "UPPER(name)", 2),
            ("n", "n + no_such", 1),
            ("n", "n + 1", 2),
            ("gone", "UPPER(gone)", 1),
            ("n", "SUM(n)", 3),
            ("n", None, 4),
        ]
    )
    out, outcomes = transform_with_outcomes(df, rules)
    assert tuple(out.first()) == ("X", 2)
    assert statuses(outcomes) == {
        ("name", "UPPER(name"): "rejected",
        ("name", "UPPER(name)"): "applied",
        ("n", "n + no_such"): "rejected",
        ("n", "n + 1"): "applied",
        ("gone", "UPPER(gone)"): "unknown_field",
        ("n", "SUM(n)"): "rejected",
        ("n", None): "rejected",
    }


def test_data_errors_are_not_hidden(spark):
    df = spark.createDataFrame([("ab",)], "a string")
    out = transform_by_rules(df, transform_rule_list([("a", "CAST(a AS INT)", 1)]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        out.collect()
    lenient = transform_by_rules(df, transform_rule_list([("a", "TRY_CAST(a AS INT)", 1)]))
    assert lenient.first()[0] is None


def test_a_name_inside_another_name(spark):
    df = spark.createDataFrame([("p", "i")], "patient_id string, id string")
    rules = transform_rule_list([("id", "CONCAT(patient_id, id)", 1)])
    assert transform_by_rules(df, rules).first()["id"] == "pi"


def test_a_name_that_needs_quoting(spark):
    df = spark.createDataFrame([("p", 7, 2)], "`drug-name` string, drug int, name int")
    rules = transform_rule_list([("drug-name", "UPPER(drug-name)", 1)])
    assert transform_by_rules(df, rules).first()["drug-name"] == "P"


def test_quoting_leaves_literals_and_quoted_names_alone():
    assert quote_references("CONCAT(id, 'id', `id`, pid, \"id\")", "id") == (
        "CONCAT(`id`, 'id', `id`, pid, \"id\")"
    )


def test_may_read_has_no_false_negatives():
    assert may_read("upper(NAME)", {"name"})
    assert may_read("hash(*)", {"x"})
    assert not may_read("a * 2", {"b"})


def test_only_scalar_rules_run(spark):
    df = spark.createDataFrame([([1, 2], 3), ([], 4)], "a array<int>, b int")
    bad = ["EXPLODE(a)", "MAX(b)", "ROW_NUMBER() OVER (ORDER BY b)", "(SELECT 1)", "b IN (SELECT 1)"]
    rules = transform_rule_list([("b", text, 1) for text in bad] + [("b", "b + 1", 2)])
    out, outcomes = transform_with_outcomes(df, rules)
    assert [o.status for o in outcomes] == ["rejected"] * len(bad) + ["applied"]
    assert sorted(r["b"] for r in out.collect()) == [4, 5]


def test_transform_to_null_drops_a_required_row(spark):
    df = spark.createDataFrame([("x",), ("y",)], "a string")
    rules = transform_rule_list([("a", "NULLIF(a, 'x')", 1)])
    required = schema_rule_list([("a", "STRING", True)])
    assert silver_b(df, rules, required).count() == 1
    assert silver_b(df, rules, required, validate=False).count() == 2


def test_many_rules_stay_in_few_projections(spark):
    width = 300
    df = spark.range(2).select(*[F.col("id").alias(f"c{i:03d}") for i in range(width)])
    rules = transform_rule_list([(f"c{i:03d}", f"c{i:03d} + {i}", 1) for i in range(width)])
    assert len(_batches(field_major(rules))) == 1
    assert transform_by_rules(df, rules).first()["c299"] == 299


EXPRESSIONS = ["a + 1", "a + b", "B * 2", "coalesce(c, `a`)", "A - C", "hash(*)", "nope + 1", "b +",
               "nullif(c, 3)", "sum(a)"]


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("abcd"), st.sampled_from(EXPRESSIONS), st.integers(1, 3)),
        max_size=8,
    )
)
def test_batching_equals_one_rule_at_a_time(spark, rows):
    df = spark.createDataFrame([(1, 2, 3), (4, None, 3)], "a int, b int, c int")
    rules = transform_rule_list(rows)
    one_by_one = df
    for rule in field_major(rules):
        if rule["field_name"] in df.columns:
            try:
                one_by_one = one_by_one.withColumn(rule["field_name"], F.expr(rule["transform"]))
            except PySparkException:
                pass
    want = sorted(map(repr, one_by_one.collect()))
    assert sorted(map(repr, transform_by_rules(df, rules).collect())) == want


def test_stateless_stages_accept_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("a", 1), (None, 2)], "k string, v int").write.parquet(source)
    stream = spark.readStream.schema("k string, v int").parquet(source)
    fields = schema_rule_list([("k", "STRING", True), ("v", "INTEGER", False)])
    b = silver_b(silver_a(stream, fields), transform_rule_list([("k", "UPPER(k)", 1)]), fields)
    run = b.writeStream.format("memory").queryName("staged").trigger(availableNow=True)
    run.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination(60)
    assert [tuple(r) for r in spark.table("staged").collect()] == [("A", 1)]
