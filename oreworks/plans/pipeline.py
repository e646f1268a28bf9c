"""A full run: every combination through every stage, written as tables."""

from __future__ import annotations

import json
import logging
import traceback
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oreworks.functions.expressions import column
from oreworks.functions.local import local_frame
from oreworks.model import (
    ERROR_LOG,
    LINEAGE,
    MONTH_COLUMN,
    NULL_TOLERANCE_PERCENT,
    PLACEHOLDER,
    PROCESSED_COLUMN,
    QUALITY_METRICS,
    RUN_LOG,
    STAGE_COLUMN,
    STAGES,
    Combination,
    Settings,
)
from oreworks.operators.checks import completeness_of_counts
from oreworks.operators.dedup import free_name, key_profile, present_keys
from oreworks.operators.expectations import (
    KEPT,
    Expectation,
    TableExpectation,
    by_action,
    expect,
    violation_counts,
    with_verdict,
)
from oreworks.operators.selection import required_fields, rule_fields
from oreworks.operators.summary import SCORE_MEASURES
from oreworks.operators.transform import lineage_rows, transform_with_outcomes
from oreworks.plans.silver import silver_a, silver_b, silver_c
from oreworks.sources import tables, versions
from oreworks.sources.history import expire, store_rows
from oreworks.sources.rules import collect_rules, end_of_month, in_groups, rules_as_of
from oreworks.sources.sinks import (
    ROWS_OUT,
    ensure_schema,
    stage_properties,
    write_measured,
)

log = logging.getLogger(__name__)

CHECK_NAMES = {"silver_b": "transformation_success", "silver_c": "silver_c_completeness"}

STAGE_COMMENTS = {
    "silver_a": "columns selected by schema rules",
    "silver_b": "columns rewritten by transform rules",
    "silver_c": "deduplicated, scored and stamped",
}


class RunFailed(RuntimeError):
    """Some combinations failed; ``result`` holds what the others produced."""

    def __init__(self, result: RunResult):
        self.result = result
        super().__init__(f"failed combinations: {', '.join(c.label for c in result.failed)}")


@dataclass
class RunResult:
    """What a run wrote, with one log row per table and one error row per failure."""

    spark: SparkSession
    written: dict[tuple[Combination, str], str] = field(default_factory=dict)
    log_rows: list[tuple] = field(default_factory=list)
    error_rows: list[tuple] = field(default_factory=list)
    score_rows: dict[Combination, dict] = field(default_factory=dict)
    checks: dict[tuple[Combination, str], bool] = field(default_factory=dict)
    violations: dict[tuple[Combination, str], dict[str, int]] = field(default_factory=dict)
    failed: list[Combination] = field(default_factory=list)
    nulls: dict[Combination, tuple[list[str], int, dict[str, int]]] = field(default_factory=dict)
    lineage_rows: list[tuple] = field(default_factory=list)
    attempted: list[Combination] = field(default_factory=list)
    month: str | None = None  # of tables that are kept by month

    def completeness(self, tolerance_percent: float = NULL_TOLERANCE_PERCENT) -> list[DataFrame]:
        """The completeness findings of every final table, from counts that its write has
        gathered: no further scan."""
        return [
            completeness_of_counts(self.spark, c, required, rows, gaps, tolerance_percent)
            for c, (required, rows, gaps) in self.nulls.items()
        ]

    @property
    def run_log(self) -> DataFrame:
        return local_frame(self.spark, self.log_rows, RUN_LOG)

    @property
    def errors(self) -> DataFrame:
        return local_frame(self.spark, self.error_rows, ERROR_LOG)

    @property
    def lineage(self) -> DataFrame:
        """What every transform rule of the run did, and from which columns (`run(trace=True)`)."""
        return local_frame(self.spark, self.lineage_rows, LINEAGE)

    @property
    def metrics(self) -> DataFrame:
        """The run in the long metrics format: throughput, stage checks, scores and
        expectation violations of every written table."""
        now = datetime.now(timezone.utc)
        rows = []
        counts = {(Combination(*c), stage): n for *c, stage, _, n, _ in self.log_rows}
        for *c, stage, _, count, seconds in self.log_rows:
            key = Combination(*c)
            rate = count / seconds if seconds > 0 else 0.0
            found = [("records_per_second", rate, None, "PASS")]
            if stage in CHECK_NAMES:
                passed = self.checks[key, stage]
                found.append((CHECK_NAMES[stage], float(passed), 1.0, "PASS" if passed else "WARN"))
            if stage == "silver_c":
                found += [(n, v, None, "PASS") for n, v in self.score_rows.get(key, {}).items()]
                if (key, "silver_b") in counts:
                    removed = counts[key, "silver_b"] - count
                    found.append(("rows_removed", float(removed), None, "PASS"))
            for name, broken in self.violations.get((key, stage), {}).items():
                found.append((name, float(broken), 0.0, "WARN" if broken else "PASS"))
            rows += [(*c, stage, key.label, *metric, count, now) for metric in found]
        return local_frame(self.spark, rows, QUALITY_METRICS)

    def store(
        self,
        metrics_table: str,
        errors_table: str,
        run: str,
        keep_days: int | None = None,
        now: datetime | None = None,
    ) -> None:
        """Keep metrics and errors by run. Storing a run again replaces the rows of its
        combinations, and clears those that have none now. With ``keep_days``, runs whose newest
        row is older are dropped."""
        for rows, table, time in (
            (self.metrics, metrics_table, "created_timestamp"),
            (self.errors, errors_table, "timestamp"),
        ):
            store_rows(rows, table, run, self.attempted)
            if keep_days is not None:
                expire(self.spark, table, time, keep_days, now)

    def table(self, combination: Combination, stage: str) -> DataFrame:
        """The published rows, of the run's month where months are kept."""
        whole = self.spark.table(self.written[combination, stage])
        if self.month is None:
            return whole
        return whole.where(F.col(MONTH_COLUMN) == self.month).drop(MONTH_COLUMN)

    def dropped(self, combination: Combination, stage: str) -> DataFrame:
        """The rows that expectations dropped, with the names of the checks they break."""
        whole = self.spark.table(versions.dropped_table(self.written[combination, stage]))
        if self.month is None:
            return whole
        return whole.where(F.col(MONTH_COLUMN) == self.month).drop(MONTH_COLUMN)


def error_row(
    error: BaseException, combination: Combination, stage: str | None, context: dict | None = None
) -> tuple:
    """One error log row for a failure on the driver."""
    now = datetime.now(timezone.utc)
    return (
        f"{now:%Y%m%d_%H%M%S_%f}_{combination.label}",
        now,
        *combination,
        stage,
        type(error).__name__,
        str(error),
        "".join(traceback.format_exception(error)),
        None,
        json.dumps(context) if context else None,
    )


def _rule_errors(outcomes, combination: Combination) -> list[tuple]:
    """Rejected rules are errors of the run, though they do not stop it."""
    now = datetime.now(timezone.utc)
    return [
        (
            f"{now:%Y%m%d_%H%M%S_%f}_{combination.label}_{i}",
            now,
            *combination,
            "silver_b",
            "RejectedRule",
            f"{o.field_name}: {o.reason}",
            None,
            None,
            json.dumps({"field_name": o.field_name, "transform": o.transform}),
        )
        for i, o in enumerate(outcomes)
        if o.status == "rejected"
    ]


class _CombinationRun:
    """One combination on its way through the stages."""

    def __init__(self, spark, settings, combination, schema_rules, transform_rules, options):
        self.spark = spark
        self.settings = settings
        self.combination = combination
        self.schema_rules = schema_rules
        self.transform_rules = transform_rules
        self.options = options
        self.stage: str | None = None
        self.found = True
        self.month = options["month"] if settings.monthly else None
        self.result = RunResult(spark)

    def _sink(self, df: DataFrame, needed: Sequence[str]) -> DataFrame:
        """Apply the stage's expectations, and if asked to, write it and continue from the
        written version, so that no later stage, retry or lost executor goes back to Bronze."""
        c, stage, month = self.combination, self.stage, self.month
        expected = self.options["expectations"].get(stage)
        checks = by_action(expected(df) if expected else {})
        if checks["fail"]:
            df = expect(df, checks["fail"], "fail")
        if stage not in self.options["materialize"]:
            return expect(df, checks["drop"], "drop") if checks["drop"] else df
        dropped, split, kept = Observation(), None, None
        aside = checks["drop"] if self.options["quarantine"] else {}
        if aside:
            split = (free_name(df, "row_verdict"), free_name(df, "broken_checks"))
            df, kept = with_verdict(df, aside, *split), column(split[0]) == KEPT
        elif checks["drop"]:
            df = expect(df, checks["drop"], "drop", dropped)
        name = tables.silver_table(self.settings, c, stage, month and month[:4])
        comment = f"{c.source}/{c.lob}/{c.domain}: {STAGE_COMMENTS[stage]}"
        properties = stage_properties(self.settings, c, stage)
        measures = violation_counts(checks["warn"], kept) + violation_counts(aside)
        wanted = required_fields(self.schema_rules) if stage == STAGES[-1] else []
        present = [f for f in dict.fromkeys(wanted) if f in df.columns]
        gap = lambda f: column(f).isNull() if kept is None else kept & column(f).isNull()
        measures += [F.count_if(gap(f)).alias(f"_nulls_{i}") for i, f in enumerate(present)]
        keep = self.settings.keep_versions
        measured = write_measured(df, name, comment, properties, measures, month, keep, split)
        rows = measured[ROWS_OUT]
        if stage == STAGES[-1]:
            gaps = {f: measured[f"_nulls_{i}"] for i, f in enumerate(present)}
            self.result.nulls[c] = (wanted, rows, gaps)
        broken = {n: measured[n] for n in (*checks["warn"], *aside)} | dict.fromkeys(checks["fail"], 0)
        if checks["drop"] and not aside:
            broken |= {n: dropped.get[n] for n in checks["drop"]}
        self.result.written[c, stage] = name
        self.result.log_rows.append((*c, stage, name, rows, measured["seconds"]))
        scores = {n: measured[n] for n in SCORE_MEASURES if n in measured}
        if scores:
            self.result.score_rows[c] = scores
        written = self.spark.table(measured["version"])
        if split:
            written = written.where(column(split[0]) == KEPT).drop(*split)
        whole = self.options["table_expectations"].get(stage, TableExpectation())
        if whole.min_records is not None:
            broken["valid_record_count"] = int(rows < whole.min_records)
        if whole.unique_keys:
            keys = present_keys(written, self.settings.keys_for(c.domain))
            repeated = key_profile(written, keys).first()["duplicate_groups"] if keys else 0
            broken["no_duplicates_on_business_keys"] = repeated
        self.result.violations[c, stage] = broken
        self.result.checks[c, stage] = rows > 0 and set(needed) <= set(written.columns)
        return written

    def _input(self, stage: str) -> DataFrame:
        """What the run's first stage reads: Bronze, or the table of the stage before."""
        if stage == STAGES[0]:
            name = tables.bronze_table(self.settings, self.combination, self.options["month"])
        else:
            before = STAGES[STAGES.index(stage) - 1]
            year = self.month and self.month[:4]
            name = tables.silver_table(self.settings, self.combination, before, year)
        self.found = tables.table_exists(self.spark, name)
        if stage != STAGES[0] and self.month and self.found:
            self.found = self.month in versions.published(self.spark, name)
            if self.found:
                whole = self.spark.table(name)
                return whole.where(F.col(MONTH_COLUMN) == self.month).drop(MONTH_COLUMN)
        if not self.found:
            log.warning("no input table %s", name)
            return tables.placeholder(self.spark)
        return self.spark.table(name)

    def _silver_a(self, bronze: DataFrame) -> DataFrame:
        validate, on_error = self.settings.validation_enabled, self.options["on_error"]
        rules = self.schema_rules if self.found else ()
        return self._sink(silver_a(bronze, rules, validate, on_error), ())

    def _silver_b(self, stage_a: DataFrame) -> DataFrame:
        trace = self.options["trace"]
        rewritten, outcomes = transform_with_outcomes(stage_a, self.transform_rules, trace)
        if trace:
            self.result.lineage_rows += [(*self.combination, *row) for row in lineage_rows(outcomes)]
        self.result.error_rows += _rule_errors(outcomes, self.combination)
        b = silver_b(rewritten, (), self.schema_rules, self.settings.validation_enabled)
        return self._sink(b, rule_fields(self.schema_rules))

    def _kept_before(self, stage_b: DataFrame) -> DataFrame | None:
        """The keys of the final rows of earlier months, of the run's year and of those before;
        None if there are none. Read by key columns alone, months by their own tables."""
        settings, c = self.settings, self.combination
        if not settings.keys_once or not self.options["finalize"] or not self.found:
            return None
        used = present_keys(stage_b, settings.keys_for(c.domain), settings.on_missing_keys)
        parts = []
        for year in tables.silver_years(self.spark, settings, c, STAGES[-1]) if used else ():
            name = tables.silver_table(settings, c, STAGES[-1], year)
            if any(m < self.month for m in versions.published(self.spark, name)):
                whole = self.spark.table(name)
                if not set(PLACEHOLDER.fieldNames()) <= set(whole.columns) or set(used) & set(whole.columns):
                    before = whole.where(F.col(MONTH_COLUMN) < self.month)
                    parts.append(before.select(*map(column, present_keys(whole, used, "error"))))
        return tables.union_all(parts) if parts else None

    def _silver_c(self, stage_b: DataFrame) -> DataFrame:
        settings = self.settings
        final = silver_c(
            stage_b,
            settings.keys_for(self.combination.domain),
            self.schema_rules,
            settings.validation_enabled,
            finalize=self.options["finalize"],
            min_score=settings.min_quality_score,
            order=_order(settings.dedup_order.get(self.combination.domain)),
            on_missing_keys=settings.on_missing_keys,
            now=self.options["now"],
            kept=self._kept_before(stage_b),
        )
        stamped = (PROCESSED_COLUMN, STAGE_COLUMN) if self.options["finalize"] else ()
        return self._sink(final, stamped)

    def execute(self) -> RunResult:
        steps = dict(zip(STAGES, (self._silver_a, self._silver_b, self._silver_c)))
        try:
            df = self._input(self.options["stages"][0])
            if not self.found and self.options["on_missing_input"] == "fail":
                raise FileNotFoundError(f"no input table for {self.combination.label}")
            if not self.found and self.options["on_missing_input"] == "skip":
                return self.result
            for self.stage in self.options["stages"]:
                df = steps[self.stage](df)
        except Exception as error:
            log.exception("%s failed in %s", self.combination.label, self.stage)
            self.result.error_rows.append(error_row(error, self.combination, self.stage))
            self.result.failed.append(self.combination)
        return self.result


def _order(names: Sequence[str] | None) -> list[Column] | None:
    """Sort columns from "name" or "name DESC"; NULLs come last in either."""
    if not names:
        return None
    last = " DESC"
    return [
        column(n[: -len(last)]).desc_nulls_last()
        if n.upper().endswith(last)
        else column(n).asc_nulls_last()
        for n in names
    ]


def _consecutive(stages: Sequence[str]) -> tuple[str, ...]:
    found = tuple(stages)
    start = STAGES.index(found[0]) if found and found[0] in STAGES else 0
    if not found or found != STAGES[start : start + len(found)]:
        raise ValueError(f"stages must be consecutive ones of {STAGES}, not {found}")
    return found


def _check_stages(stages, materialize, expectations, table_expectations) -> None:
    """Raise if something is asked of a stage that the run does not have or does not write."""
    unknown = {*materialize, *expectations, *table_expectations} - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; there are {STAGES}")
    absent = set(expectations) - set(stages)
    if absent:
        raise ValueError(f"expectations on stages that do not run: {sorted(absent)}")
    unwritten = set(table_expectations) - (set(stages) & set(materialize))
    if unwritten:
        raise ValueError(f"table expectations on stages that are not written: {sorted(unwritten)}")


def run(
    spark: SparkSession,
    settings: Settings,
    month: str | None = None,
    combinations: Sequence[Combination] | None = None,
    schema_rules: DataFrame | None = None,
    transform_rules: DataFrame | None = None,
    stages: Sequence[str] = STAGES,
    materialize: Sequence[str] = STAGES,
    parallel: int = 4,
    finalize: bool = True,
    on_error: str = "raise",
    raise_failures: bool = True,
    now: Column | None = None,
    expectations: Mapping[str, Callable[[DataFrame], Mapping[str, Column | Expectation]]]
    | None = None,
    table_expectations: Mapping[str, TableExpectation] | None = None,
    on_missing_input: str = "placeholder",
    store: tuple[str, str] | None = None,
    group: int = 256,
    quarantine: bool = False,
    trace: bool = False,
    rules_of_month: bool = False,
) -> RunResult:
    """Refine every combination and write its stage tables.

    Rules are read for ``group`` combinations at a time, in one job per rule table. ``parallel``
    combinations are in flight at a time, so one combination's shuffle tail overlaps
    another's scan; results never depend on it. A combination that fails is logged and
    the others go on; at the end ``RunFailed`` is raised unless ``raise_failures`` is
    off. ``materialize`` names the stages to write: the full list gives exact counts and
    restart points, ``("silver_c",)`` runs the three stages as one plan. ``stages`` runs
    some stages only, from the table of the stage before. ``expectations`` maps a stage to
    a function from its DataFrame to named predicates or `Expectation`s; violations are
    counted by the write, and the rows kept, dropped, or the combination failed, as the
    action says; in a stage that is not written, rows are dropped and failed alike, but nothing
    is counted. With ``quarantine`` the same write keeps dropped rows beside the table, with the
    names of the checks they break (`RunResult.dropped`). ``table_expectations`` are checked on
    the written table of a stage. A missing input becomes a placeholder table unless ``on_missing_input`` says ``skip``
    (good tables stay as they are) or ``fail``. ``trace`` keeps the lineage of the transform
    rules. ``rules_of_month`` takes, of rules that have changed, the versions that held at the
    end of the run's month. With ``Settings.keys_once``, monthly tables hold a key once: run months
    oldest first; one that is run again is compared with the months before it only. ``store`` names two tables that keep the
    run's metrics and errors, by month.
    """
    if on_missing_input not in ("placeholder", "skip", "fail"):
        raise ValueError(f"unknown on_missing_input {on_missing_input!r}")
    _check_stages(stages, materialize, expectations or {}, table_expectations or {})
    combos = list(combinations if combinations is not None else settings.combinations())
    month = tables.year_month(spark, month)
    result = RunResult(spark, attempted=combos, month=month if settings.monthly else None)
    if not combos:
        return result
    if schema_rules is None:
        schema_rules = spark.table(settings.schema_rules_table)
    if transform_rules is None:
        transform_rules = spark.table(settings.transform_rules_table)
    if rules_of_month:
        at = end_of_month(month)
        schema_rules, transform_rules = rules_as_of(schema_rules, at), rules_as_of(transform_rules, at)
    ensure_schema(spark, settings.silver_schema)
    options = {
        "month": month,
        "stages": _consecutive(stages),
        "materialize": tuple(materialize),
        "finalize": finalize,
        "on_error": on_error,
        "now": now,
        "expectations": expectations or {},
        "table_expectations": table_expectations or {},
        "on_missing_input": on_missing_input,
        "quarantine": quarantine,
        "trace": trace,
    }
    parts: list[RunResult] = []
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for some in in_groups(combos, group):
            selecting = collect_rules(schema_rules, some)
            rewriting = collect_rules(transform_rules, some)

            def one(c: Combination, selecting=selecting, rewriting=rewriting) -> RunResult:
                steps = _CombinationRun(spark, settings, c, selecting[c], rewriting[c], options)
                return steps.execute()

            # A wrapped function owns one copy of the caller's local properties. Threads that share it
            # share Spark's execution id, too, and end each other's.
            wrapped = [inheritable_thread_target(spark)(one) for _ in some]
            parts += pool.map(lambda f, c: f(c), wrapped, some)

    for part in parts:
        result.written.update(part.written)
        result.log_rows += part.log_rows
        result.error_rows += part.error_rows
        result.lineage_rows += part.lineage_rows
        result.score_rows.update(part.score_rows)
        result.checks.update(part.checks)
        result.nulls.update(part.nulls)
        result.violations.update(part.violations)
        result.failed += part.failed
    if store:
        result.store(*store, run=month, keep_days=settings.retention_days)
    if result.failed and raise_failures:
        raise RunFailed(result)
    return result
