"""The three stages as one plan against a row-by-row model of them."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from oreworks.plans.silver import silver
from oreworks.sources.rules import schema_rule_list, transform_rule_list

FIELDS = schema_rule_list(
    [("k", "STRING", True), ("v", "INTEGER", False), ("w", "INTEGER", True), ("gone", "DATE", True)]
)
TRANSFORMS = transform_rule_list(
    [("k", "UPPER(TRIM(k))", 1), ("k", "NULLIF(k, 'Z')", 2), ("v", "NULLIF(v, 0)", 1),
     ("w", "w + COALESCE(v, 100)", 2), ("w", "w +", 3), ("gone", "NULL", 1)]
)


def model(rows):
    """Rows of (k, v, w, dropped) to the set of (k, v, w, score)."""
    staged = []
    for k, v, w, _ in rows:
        if k is None or w is None:
            continue
        k = k.strip(" ").upper()
        v = None if v == 0 else v
        w = w + (100 if v is None else v)
        if k != "Z":
            staged.append((k, v, w))
    groups = {}
    for k, v, w in staged:
        groups.setdefault(k, []).append((v is not None, v or 0, w, v))
    out = set()
    for k, members in groups.items():
        _, _, w, v = min(members, key=lambda m: m[:3])
        filled = Decimal(2 + (v is not None)) / 3
        out.add((k, v, w, filled.quantize(Decimal("0.01"), ROUND_HALF_UP)))
    return out


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "a", " A", "b ", "z", "c"]),
            st.one_of(st.none(), st.integers(-3, 3)),
            st.one_of(st.none(), st.integers(-3, 3)),
            st.integers(0, 9),
        ),
        max_size=25,
    )
)
def test_stages_agree_with_the_model(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, w int, dropped int")
    out = silver(df, ["k", "not_there"], FIELDS, TRANSFORMS)
    assert out.columns == ["k", "v", "w", "quality_score", "processed_timestamp", "pipeline_stage"]
    got = [tuple(r) for r in out.select("k", "v", "w", "quality_score").collect()]
    assert len(got) == len(set(got)) and set(got) == model(rows)
