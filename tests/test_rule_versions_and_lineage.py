"""Rules as of a time, and where the values of rewritten columns come from."""

from datetime import datetime, timezone

import pytest

from oreworks.model import TRANSFORM_RULES
from oreworks.operators.transform import lineage_rows, transform_with_outcomes
from oreworks.sources import rules

C = ("s", "l", "d")


def at(text):
    return None if text is None else datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def versions(spark):
    data = [
        ("f", "first", 1, None),
        ("f", "second", 1, "2024-03-01"),
        ("f", "second again", 1, "2024-03-01"),
        ("f", "third", 1, "2024-05-10"),
        ("f", "other priority", 2, "2024-04-01"),
        ("f", "null priority", None, "2024-04-01"),
        ("g", "g", 1, "2024-04-01"),
        ("g", None, 1, "2024-05-01"),
        ("g", "back", 1, "2024-06-01"),
    ]
    rows = [(*C, f, t, "FUNCTION", p, at(d), at(d)) for f, t, p, d in data]
    return spark.createDataFrame(rows, TRANSFORM_RULES)


@pytest.mark.parametrize(
    ("month", "held"),
    [
        ("202401", ["first"]),
        ("202402", ["first"]),
        ("202403", ["second", "second again"]),
        ("202404", ["g", "null priority", "other priority", "second", "second again"]),
        ("202405", ["null priority", "other priority", "third"]),
        ("202412", ["back", "null priority", "other priority", "third"]),
    ],
)
def test_rules_hold_until_the_next_version(versions, month, held):
    got = rules.rules_as_of(versions, rules.end_of_month(month))
    assert got.columns == versions.columns
    assert sorted(r["transform"] for r in got.collect()) == held


def test_validity_is_an_interval(versions):
    spans = rules.with_validity(versions).where("field_name = 'f' AND priority = 1")
    got = {r["transform"]: (r.valid_from.month, r.valid_to and r.valid_to.month) for r in spans.collect()}
    assert got["second"] == got["second again"] == (3, 5) and got["third"] == (5, None)
    assert got["first"][1] == 3


def test_the_end_of_a_month():
    assert rules.end_of_month("202412") == datetime(2025, 1, 1, tzinfo=timezone.utc)
    assert rules.end_of_month("202402") == datetime(2024, 3, 1, tzinfo=timezone.utc)


def test_lineage_follows_chains(spark):
    df = spark.createDataFrame([(1, 2, "x")], "a int, b int, `c-d` string")
    chain = rules.transform_rule_list([("a", "a + b", 1), ("b", "a * 2", 2), ("c-d", "UPPER(c-d)", 3), ("b", "NO_SUCH(a)", 4), ("a", "7", 5)])
    _, outcomes = transform_with_outcomes(df, chain, trace=True)
    got = {(r[2], r[3]): (r[4], r[6], r[7]) for r in lineage_rows(outcomes)}
    assert got["a", "a + b"] == ("applied", ["a", "b"], ["a", "b"])
    assert got["a", "7"] == ("applied", [], [])
    assert got["b", "a * 2"][:2] == ("applied", ["a"])
    assert got["c-d", "UPPER(c-d)"] == ("applied", ["c-d"], ["c-d"])
    assert got["b", "NO_SUCH(a)"][0] == "rejected" and got["b", "NO_SUCH(a)"][1] == []


def test_without_tracing_nothing_is_read(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert transform_with_outcomes(df, rules.transform_rule_list([("a", "a + 1", 1)]))[1][0].inputs is None
