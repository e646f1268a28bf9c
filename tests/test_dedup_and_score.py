import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import MEMBER2, PHARMACY1, PHARMACY2

from oreworks.operators.dedup import deduplicate, duplicate_groups, key_profile
from oreworks.operators.score import add_metadata, add_quality_score
from oreworks.plans.silver import silver_c
from oreworks.sources.tables import placeholder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_keys_or_no_present_key_changes_nothing(bronze):
    df = bronze[MEMBER2]
    assert deduplicate(df, []) is df
    assert deduplicate(df, ["nope"]) is df


def test_missing_key_columns(bronze):
    df = bronze[PHARMACY1]
    keys = ["patient_id", "ndc", "service_date"]
    assert deduplicate(df, keys).count() == 7
    assert deduplicate(df, keys, on_missing="skip").count() == 8
    with pytest.raises(ValueError):
        deduplicate(df, keys, on_missing="error")
    with pytest.raises(ValueError):
        deduplicate(df, keys, on_missing="what")


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert sorted(r["v"] for r in deduplicate(df, ["k"]).collect()) == [1, 3]


def test_survivor_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 101).alias("v"))
    results = {
        tuple(sorted(tuple(r) for r in deduplicate(df.repartition(n), ["k"]).collect()))
        for n in (1, 3, 8)
    }
    assert len(results) == 1


def test_explicit_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    assert deduplicate(df, ["k"], [F.desc("v")]).first()["v"] == 2
    assert deduplicate(df, ["k"], ["v"]).first()["v"] == 1


def test_maps_take_no_part_in_the_tie_break(spark):
    df = spark.createDataFrame([("a", {"x": 1}, 2), ("a", {"y": 1}, 1)], "k string, m map<string,int>, v int")
    assert deduplicate(df, ["k"]).first()["v"] == 1
    only_map = df.select("k", "m")
    assert deduplicate(only_map, ["k"]).count() == 1


def test_nested_columns_pass_through(spark):
    df = spark.createDataFrame([(1, [1, 2], ("x", 1))], "k int, a array<int>, s struct<p:string,q:int>")
    row = silver_c(df, ["k"]).first()
    assert row["a"] == [1, 2] and row["s"]["p"] == "x"


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    out = deduplicate(df, ["k"])
    text = plan(out)
    partial, exchange = text.index("Partial"), text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text and exchange < partial  # plans print top down
    assert out.count() == df.select("k").distinct().count()


def test_whole_row_key_aggregates_without_a_sort(spark):
    text = plan(deduplicate(spark.range(10).withColumn("b", F.lit(1)), ["id", "b"]))
    assert "HashAggregate" in text and "Window" not in text


def test_key_profile(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert tuple(key_profile(df, ["k"]).first()) == (3, 2, 1)
    assert tuple(key_profile(df.limit(0), ["k"]).first()) == (0, 0, 0)
    assert [tuple(r) for r in duplicate_groups(df, ["k"]).collect()] == [(None, 2)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "a", "b", "c"]),
            st.sampled_from([None, 1, 2]),
            st.one_of(st.none(), st.integers(-5, 5)),
        ),
        max_size=30,
    )
)
def test_invariants(spark, data):
    df = spark.createDataFrame(data, "k string, j int, v int")
    keys = ["k", "j"]
    once = deduplicate(df, keys)
    assert once.count() == len({(k, j) for k, j, _ in data})
    assert sorted(map(repr, once.collect())) == sorted(map(repr, deduplicate(once, keys).collect()))
    low = {}
    for k, j, v in data:
        low.setdefault((k, j), []).append(v)
    first = {key: None if None in vs else min(vs) for key, vs in low.items()}
    assert {(r["k"], r["j"]): r["v"] for r in once.collect()} == first
    for r in add_quality_score(df).collect():
        filled = sum(x is not None for x in r[:3])
        assert float(r["quality_score"]) == {0: 0, 1: 0.33, 2: 0.67, 3: 1}[filled]


def test_scores_of_the_samples(bronze):
    scores = add_quality_score(bronze[PHARMACY2]).select("quality_score").collect()
    assert sorted(str(r[0]) for r in scores) == ["0.88", "1.00", "1.00", "1.00"]


def test_very_wide_tables_stay_plannable(spark):
    df = spark.range(1).select(*[F.col("id").alias(f"c{i}") for i in range(2000)])
    assert str(add_quality_score(df).select("quality_score").first()[0]) == "1.00"


def test_metadata(spark):
    row = add_metadata(spark.range(1)).first()
    assert row["pipeline_stage"] == "silver_c" and row["processed_timestamp"] is not None


def test_placeholder_flows_through_stage_c(spark):
    out = silver_c(placeholder(spark), ["patient_id"])
    assert out.columns == ["placeholder", "quality_score", "processed_timestamp", "pipeline_stage"]
    assert out.count() == 0


def test_pass_through(bronze):
    assert silver_c(bronze[MEMBER2], ["member_id"], finalize=False) is bronze[MEMBER2]
