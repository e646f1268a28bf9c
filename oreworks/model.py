"""Schemas, settings and the fixed values every layer shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values
# --------------------------------------------------------------------------

COMBINATION_COLUMNS = ("source", "lob", "domain")

STAGES = ("silver_a", "silver_b", "silver_c")

# Business keys per domain; a domain that is not listed uses the default.
DEDUP_KEYS = {
    "pharmacy": ("patient_id", "ndc", "service_date"),
    "medical": ("patient_id", "procedure_code", "service_date"),
    "member": ("member_id", "effective_date"),
    "mbr": ("member_id", "effective_date"),
}
DEFAULT_DEDUP_KEYS = ("patient_id", "service_date")

ALLOWED_DOMAINS = ("pharmacy", "medical", "member", "mbr")

DEFAULT_YEAR_MONTH = "202407"
YEAR_MONTH_CONF = "pipeline.year_month"

MIN_QUALITY_SCORE = 0.7
NULL_TOLERANCE_PERCENT = 5

SCORE_COLUMN = "quality_score"
PROCESSED_COLUMN = "processed_timestamp"
STAGE_COLUMN = "pipeline_stage"
MONTH_COLUMN = "year_month"

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _table(**columns: str) -> T.StructType:
    """Columns as name="type", with a trailing ``!`` for not null; needs no session."""
    return T.StructType(
        [
            T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!"))
            for name, kind in columns.items()
        ]
    )


SCHEMA_RULES = _table(
    source="string",
    lob="string",
    domain="string",
    field_name="string",
    data_type="string",
    is_required="boolean",
    created_date="timestamp",
    updated_date="timestamp",
)

TRANSFORM_RULES = _table(
    source="string",
    lob="string",
    domain="string",
    field_name="string",
    transform="string",
    transform_type="string",
    priority="int",
    created_date="timestamp",
    updated_date="timestamp",
)

# record_count is a bigint: a single run at the target scale passes 2^31 rows.
QUALITY_METRICS = _table(
    source="string!",
    lob="string!",
    domain="string!",
    stage="string!",
    table_name="string!",
    metric_name="string!",
    metric_value="double",
    threshold="double",
    status="string!",
    record_count="bigint",
    created_timestamp="timestamp!",
)

ERROR_LOG = _table(
    error_id="string!",
    timestamp="timestamp!",
    source="string",
    lob="string",
    domain="string",
    stage="string",
    error_type="string!",
    error_message="string!",
    stack_trace="string",
    record_count="bigint",
    additional_context="string",
)

RUN_LOG = _table(
    source="string",
    lob="string",
    domain="string",
    stage="string",
    table_name="string",
    record_count="bigint",
    seconds="double",
)

LINEAGE = _table(
    source="string",
    lob="string",
    domain="string",
    stage="string",
    step="int",
    output_column="string",
    expression="string",
    status="string",
    reason="string",
    input_columns="array<string>",
    source_columns="array<string>",
)

TABLE_COLUMNS = _table(
    source="string", lob="string", domain="string", field_name="string", actual_type="string"
)

INVENTORY = _table(
    table_name="string", exists="boolean", column_count="int", row_count="bigint"
)

CONFIG = _table(name="string", lobs="array<string>", domains="array<string>")

PLACEHOLDER = _table(placeholder="string")


class Combination(NamedTuple):
    """The unit of work: one source, line of business and domain."""

    source: str
    lob: str
    domain: str

    @property
    def label(self) -> str:
        return "_".join(self)


@dataclass(frozen=True)
class SourceSpec:
    name: str
    lobs: Sequence[str]
    domains: Sequence[str]


@dataclass(frozen=True)
class Settings:
    """Settings that change results; nothing here is read from global state."""

    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    schema_rules_table: str = "business_rules.schema_definitions"
    transform_rules_table: str = "business_rules.transform_definitions"
    sources: Sequence[SourceSpec] = field(default_factory=tuple)
    validation_enabled: bool = True
    null_tolerance_percent: float = NULL_TOLERANCE_PERCENT
    min_quality_score: float | None = None
    bronze_suffix: str = "_bronze"
    dedup_keys: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(DEDUP_KEYS))
    default_dedup_keys: Sequence[str] = DEFAULT_DEDUP_KEYS
    # Which row of a key survives, per domain: column names, "name DESC" for the largest first.
    dedup_order: Mapping[str, Sequence[str]] = field(default_factory=dict)
    on_missing_keys: str = "available"
    allowed_domains: Sequence[str] = ALLOWED_DOMAINS
    # Silver tables by year that hold their months side by side, each replaced by itself.
    monthly: bool = False
    # Of a key that an earlier month's final rows hold, a month keeps nothing (needs `monthly`).
    keys_once: bool = False
    # Versions of a stage table (or of its months) that stay, with the published one.
    keep_versions: int = 2
    # How long stored metrics and errors stay; None: for ever.
    retention_days: int | None = None

    def __post_init__(self) -> None:
        if self.keys_once and not self.monthly:
            raise ValueError("keys_once compares months: it needs monthly tables")

    @classmethod
    def from_mapping(cls, raw: Mapping) -> Settings:
        """Build settings from a nested mapping, such as a parsed configuration file.

        Missing sections and keys, an empty source list and unknown domains raise
        ``ValueError`` naming every problem at once. Which domains are known is data, too
        (``allowed_domains``). A section ``deduplication`` may hold keys, default_keys,
        order, on_missing_keys and keys_once; ``tables`` may hold monthly and keep_versions, and
        ``monitoring`` retention_days.
        """
        required = {
            "pipeline": ("bronze_schema", "silver_schema"),
            "tables": ("schema_rules", "transform_rules"),
            "sources": (),
        }
        problems = []
        for section, keys in required.items():
            if section not in raw:
                problems.append(f"missing section {section!r}")
                continue
            problems += [f"missing {section}.{k}" for k in keys if k not in raw[section]]

        allowed = tuple(raw.get("allowed_domains", ALLOWED_DOMAINS))
        specs = []
        for entry in raw.get("sources") or ():
            absent = [k for k in ("name", "lobs", "domains") if k not in entry]
            if absent:
                problems.append(f"source entry lacks {', '.join(absent)}")
                continue
            unknown = sorted(set(entry["domains"]) - set(allowed))
            if unknown:
                problems.append(f"source {entry['name']!r} has unknown domains {unknown}")
            specs.append(SourceSpec(entry["name"], tuple(entry["lobs"]), tuple(entry["domains"])))
        if "sources" in raw and not specs and not problems:
            problems.append("sources must not be empty")
        if raw.get("deduplication", {}).get("keys_once") and not raw.get("tables", {}).get("monthly"):
            problems.append("deduplication.keys_once needs tables.monthly")
        if problems:
            raise ValueError("invalid settings: " + "; ".join(problems))

        quality = raw.get("data_quality", {})
        tables, monitoring = raw["tables"], raw.get("monitoring", {})
        dedup = raw.get("deduplication", {})
        keys = dedup.get("keys", DEDUP_KEYS)
        return cls(
            allowed_domains=allowed,
            monthly=tables.get("monthly", False),
            keep_versions=tables.get("keep_versions", 2),
            retention_days=monitoring.get("retention_days"),
            bronze_suffix=raw["pipeline"].get("bronze_suffix", "_bronze"),
            min_quality_score=quality.get("min_quality_score"),
            dedup_keys={domain: tuple(names) for domain, names in keys.items()},
            default_dedup_keys=tuple(dedup.get("default_keys", DEFAULT_DEDUP_KEYS)),
            dedup_order={domain: tuple(names) for domain, names in dedup.get("order", {}).items()},
            on_missing_keys=dedup.get("on_missing_keys", "available"),
            keys_once=dedup.get("keys_once", False),
            bronze_schema=raw["pipeline"]["bronze_schema"],
            silver_schema=raw["pipeline"]["silver_schema"],
            schema_rules_table=tables["schema_rules"],
            transform_rules_table=tables["transform_rules"],
            sources=tuple(specs),
            validation_enabled=quality.get("validation_enabled", True),
            null_tolerance_percent=quality.get(
                "null_tolerance_percent", NULL_TOLERANCE_PERCENT
            ),
        )

    def combinations(self) -> list[Combination]:
        return [
            Combination(spec.name, lob, domain)
            for spec in self.sources
            for lob in spec.lobs
            for domain in spec.domains
        ]

    def keys_for(self, domain: str) -> tuple[str, ...]:
        return tuple(self.dedup_keys.get(domain, self.default_dedup_keys))
