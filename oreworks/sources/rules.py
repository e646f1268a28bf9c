"""Rule tables: creation, lookup, linting, and the combinations they steer."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreworks.functions.expressions import conjunction
from oreworks.functions.local import local_frame
from oreworks.functions.types import unknown_type
from oreworks.model import (
    ALLOWED_DOMAINS,
    COMBINATION_COLUMNS,
    CONFIG,
    DEDUP_KEYS,
    DEFAULT_DEDUP_KEYS,
    SCHEMA_RULES,
    TRANSFORM_RULES,
    Combination,
    Settings,
)

# Sample rules.
SAMPLE_SCHEMA_RULES = (
    ("source1", "lob1", "pharmacy", "patient_id", "STRING", True),
    ("source1", "lob1", "pharmacy", "prescription_date", "DATE", True),
    ("source1", "lob1", "pharmacy", "drug_name", "STRING", True),
    ("source1", "lob1", "pharmacy", "quantity", "INTEGER", False),
    ("source1", "lob1", "medical", "patient_id", "STRING", True),
    ("source1", "lob1", "medical", "service_date", "DATE", True),
    ("source1", "lob1", "medical", "procedure_code", "STRING", True),
    ("source1", "lob1", "member", "member_id", "STRING", True),
    ("source1", "lob1", "member", "enrollment_date", "DATE", True),
)
SAMPLE_TRANSFORM_RULES = (
    ("source1", "lob1", "pharmacy", "patient_id", "UPPER(patient_id)", "FUNCTION", 1),
    ("source1", "lob1", "pharmacy", "drug_name", "TRIM(drug_name)", "FUNCTION", 1),
    ("source1", "lob1", "pharmacy", "quantity", "CAST(quantity AS INTEGER)", "CAST", 1),
    ("source1", "lob1", "medical", "patient_id", "UPPER(patient_id)", "FUNCTION", 1),
    ("source1", "lob1", "medical", "procedure_code", "UPPER(TRIM(procedure_code))", "FUNCTION", 1),
    ("source1", "lob1", "member", "member_id", "UPPER(member_id)", "FUNCTION", 1),
)

_KEYS = COMBINATION_COLUMNS
BEGINNING = "1000-01-01 00:00:00"


def _rule_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Rows without the two date columns get the current time for both."""
    short = T.StructType(schema.fields[:-2])
    return local_frame(spark, rows, short).select(
        "*",
        F.current_timestamp().alias("created_date"),
        F.current_timestamp().alias("updated_date"),
    )


def schema_rules(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """Rows of (source, lob, domain, field_name, data_type, is_required)."""
    return _rule_frame(spark, rows, SCHEMA_RULES)


def transform_rules(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """Rows of (source, lob, domain, field_name, transform, transform_type, priority)."""
    return _rule_frame(spark, rows, TRANSFORM_RULES)


def create_rule_tables(spark: SparkSession, settings: Settings, sample: bool = False) -> None:
    """Create both rule tables if they are absent; ``sample`` adds the sample rules once.

    Running it again adds nothing: rows already present are left out of the insert.
    """
    plan = (
        (settings.schema_rules_table, SCHEMA_RULES, schema_rules, SAMPLE_SCHEMA_RULES),
        (settings.transform_rules_table, TRANSFORM_RULES, transform_rules, SAMPLE_TRANSFORM_RULES),
    )
    for table, schema, build, rows in plan:
        if "." in table:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")
        if sample:
            identity = schema.names[:-2]
            known = spark.table(table).select(*identity)
            fresh = build(spark, rows).join(known, identity, "left_anti")
            fresh.select(*schema.names).write.mode("append").insertInto(table)


def with_validity(rules: DataFrame) -> DataFrame:
    """Every version of a rule with the time from which it holds, ``valid_from``, and the one at
    which the next version of the same rule replaces it, ``valid_to`` (NULL: still valid).

    Versions of a rule share combination, field and, for transform rules, priority; what was
    created at the same time is one version. A rule without a date holds from the beginning.
    """
    identity = [*COMBINATION_COLUMNS, *[c for c in ("field_name", "priority") if c in rules.columns]]
    start = F.coalesce("created_date", F.lit(BEGINNING).cast("timestamp"))
    dated = rules.withColumn("valid_from", start).alias("r")
    times = dated.select(*identity, "valid_from").distinct()
    later = F.lead("valid_from").over(Window.partitionBy(*identity).orderBy("valid_from"))
    spans = times.withColumn("valid_to", later).alias("t")
    same = conjunction([F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in (*identity, "valid_from")])
    return dated.join(spans, same).select("r.*", "t.valid_to")


def rules_as_of(rules: DataFrame, at: datetime) -> DataFrame:
    """The rules that held just before ``at``. A version whose transform (of a schema rule: whose
    data type) is NULL ends its rule."""
    found = with_validity(rules)
    value = "transform" if "transform" in rules.columns else "data_type"
    moment = F.lit(at)
    held = (F.col("valid_from") < moment) & (F.col("valid_to").isNull() | (F.col("valid_to") >= moment))
    return found.where(held & F.col(value).isNotNull()).drop("valid_from", "valid_to")


def end_of_month(month: str) -> datetime:
    """The first moment after a month given as yyyymm."""
    year, number = int(month[:4]), int(month[4:])
    return datetime(year + number // 12, number % 12 + 1, 1, tzinfo=timezone.utc)


def for_combination(rules: DataFrame, combination: Combination) -> DataFrame:
    """Rules of one combination; literals stay literals, so nothing can be injected."""
    return rules.filter(
        (F.col("source") == combination.source)
        & (F.col("lob") == combination.lob)
        & (F.col("domain") == combination.domain)
    )


def lookup_schema_rules(rules: DataFrame, combination: Combination) -> DataFrame:
    return (
        for_combination(rules, combination)
        .select("field_name", "data_type", "is_required")
        .orderBy("field_name")
    )


def lookup_transform_rules(rules: DataFrame, combination: Combination) -> DataFrame:
    return (
        for_combination(rules, combination)
        .select("field_name", "transform", "transform_type", "priority")
        .orderBy("priority", "field_name")
    )


def collect_rules(
    rules: DataFrame, combinations: Sequence[Combination]
) -> dict[Combination, list[Row]]:
    """All rules of the given combinations in one job, grouped on the driver.

    The filter reaches the scan of the rule table, and a semi-join with the triples leaves
    only theirs. Rules are ordered as by the lookups. Callers with many combinations go through
    them in groups (`in_groups`), so that the driver holds the rules of one group at a time.
    """
    wanted = sorted(set(combinations))
    order = ["priority", "field_name"] if "priority" in rules.columns else ["field_name"]
    near = conjunction([F.col(c).isin(sorted({w[i] for w in wanted})) for i, c in enumerate(_KEYS)])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _KEYS])
    triples = local_frame(rules.sparkSession, wanted, schema)
    rows = (
        rules.filter(near)
        .join(triples, [*_KEYS], "left_semi")
        .drop("created_date", "updated_date")
        .collect()
    )

    grouped: dict[Combination, list[Row]] = defaultdict(list)
    for row in rows:
        grouped[Combination(*[row[c] for c in _KEYS])].append(row)
    return {c: sorted(grouped[c], key=lambda r: _sort_key(r, order)) for c in combinations}


def in_groups(combinations: Sequence[Combination], size: int) -> Iterator[Sequence[Combination]]:
    """The combinations, ``size`` at a time."""
    for start in range(0, len(combinations), size):
        yield combinations[start : start + size]


def _sort_key(row: Row, order: Sequence[str]) -> tuple:
    """NULLs first, then ascending; the remaining columns settle ties."""
    rest = [c for c in row.asDict() if c not in order]
    return tuple(
        (row[c] is not None, row[c] if row[c] is not None else 0) for c in [*order, *rest]
    )


def combinations(config: DataFrame) -> DataFrame:
    """Source x lob x domain from rows of (name, lobs array, domains array)."""
    return (
        config.select(F.col("name").alias("source"), F.explode("lobs").alias("lob"), "domains")
        .select("source", "lob", F.explode("domains").alias("domain"))
    )


def config_frame(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [(s.name, list(s.lobs), list(s.domains)) for s in settings.sources]
    return local_frame(spark, rows, CONFIG)


def dedup_keys(
    domain: Column,
    keys: Mapping[str, Sequence[str]] = DEDUP_KEYS,
    default: Sequence[str] = DEFAULT_DEDUP_KEYS,
) -> Column:
    """The business key columns of a domain as an array, with the default for others."""
    known = F.create_map(
        *[
            part
            for name, columns in keys.items()
            for part in (F.lit(name), F.array(*map(F.lit, columns)))
        ]
    )
    return F.coalesce(F.element_at(known, domain), F.array(*map(F.lit, default)))


def rule_counts(rules: DataFrame) -> DataFrame:
    return rules.groupBy(*COMBINATION_COLUMNS).agg(F.count(F.lit(1)).alias("rule_count"))


def lint_rules(
    rules: DataFrame,
    allowed_domains: Sequence[str] = ALLOWED_DOMAINS,
    table_columns: DataFrame | None = None,
) -> DataFrame:
    """One row per finding: invalid_domain, null_key, duplicate_rule, unknown_type,
    case_mismatch.

    A rule is a duplicate if another has the same combination and field (and, for
    transform rules, the same expression and priority). ``table_columns`` rows of
    (source, lob, domain, field_name) turn on the check for fields that match a column
    in all but letter case. Every check reads one pre-aggregated group, so the lint of a
    rule table is one shuffle; columns are joined in distinct.
    """
    identity = [*COMBINATION_COLUMNS, "field_name"]
    detail = [c for c in ("transform", "priority", "data_type") if c in rules.columns]
    if "data_type" in detail:  # schema rules: one rule per field, whatever its type
        rules, detail = rules.withColumn("data_type", unknown_type(F.col("data_type"))), []
    bad = F.bool_or("data_type") if "data_type" in rules.columns else F.bool_or(F.lit(False))
    grouped = rules.groupBy(*identity, *detail).agg(
        F.count(F.lit(1)).alias("occurrences"), F.coalesce(bad, F.lit(False)).alias("_bad_type")
    )

    domain_ok = F.col("domain").isin(*allowed_domains)
    any_null = F.greatest(*[F.col(c).isNull() for c in identity])
    findings = [
        F.when(~domain_ok, F.lit("invalid_domain")),
        F.when(any_null, F.lit("null_key")),
        F.when(F.col("occurrences") > 1, F.lit("duplicate_rule")),
        F.when(F.col("_bad_type"), F.lit("unknown_type")),
    ]
    if table_columns is not None:
        exact = table_columns.select(*identity).distinct().withColumn("_exact", F.lit(True))
        folded = table_columns.select(*COMBINATION_COLUMNS, F.lower("field_name").alias("_folded"))
        near = folded.distinct().withColumn("_near", F.lit(True))
        grouped = (
            grouped.withColumn("_folded", F.lower("field_name"))
            .join(exact, identity, "left")
            .join(near, [*COMBINATION_COLUMNS, "_folded"], "left")
        )
        mismatch = F.col("_near") & F.col("_exact").isNull()
        findings.append(F.when(mismatch, F.lit("case_mismatch")))
    return grouped.select(
        *identity,
        "occurrences",
        F.explode(F.array_compact(F.array(*findings))).alias("finding"),
    )


def schema_rule_list(rows: Iterable[Sequence]) -> list[dict]:
    """Schema rules known at plan time: (field_name, data_type, is_required), in lookup order."""
    names = ("field_name", "data_type", "is_required")
    return sorted((dict(zip(names, r)) for r in rows), key=lambda r: r["field_name"])


def transform_rule_list(rows: Iterable[Sequence]) -> list[dict]:
    """Transform rules known at plan time: (field_name, transform, priority), in lookup order."""
    names = ("field_name", "transform", "priority")
    return sorted(
        (dict(zip(names, r)) for r in rows), key=lambda r: (r["priority"], r["field_name"])
    )
