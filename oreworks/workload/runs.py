"""Full runs: Bronze views in, written stage tables out."""

from __future__ import annotations

import re
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.model import Combination, Settings
from oreworks.operators.expectations import Expectation, TableExpectation
from oreworks.operators.summary import run_summary
from oreworks.plans.pipeline import RunResult, run
from oreworks.plans.quality import quality_run
from oreworks.sources import rules, versions
from oreworks.sources.sinks import ensure_schema, require_shared_warehouse
from oreworks.workload.registry import query

SALES = Combination("tpch", "retail", "sales")
LINES = Combination("tpch", "retail", "lines")
CLICKS = Combination("web", "site", "clicks")
TEXTS = Combination("crawl", "text", "texts")
ABSENT = Combination("crawl", "text", "absent")

INPUTS = {SALES: "orders", LINES: "lineitem", CLICKS: "events", TEXTS: "documents"}

SETTINGS = Settings(
    bronze_schema="global_temp",
    dedup_keys={
        "sales": ("o_custkey", "o_orderstatus"),
        "lines": ("l_orderkey", "l_linenumber"),
        "clicks": ("user_id", "event_type"),
        "texts": ("text",),
    },
)

SCHEMA_RULES = [
    (*SALES, "o_orderkey", "BIGINT", True),
    (*SALES, "o_custkey", "BIGINT", True),
    (*SALES, "o_orderstatus", "STRING", True),
    (*SALES, "o_totalprice", "DOUBLE", False),
    (*LINES, "l_orderkey", "BIGINT", True),
    (*LINES, "l_linenumber", "INTEGER", True),
    (*LINES, "l_quantity", "DOUBLE", True),
    (*LINES, "l_returnflag", "STRING", False),
    (*CLICKS, "event_id", "BIGINT", True),
    (*CLICKS, "user_id", "BIGINT", True),
    (*CLICKS, "event_type", "STRING", False),
    (*TEXTS, "text", "STRING", True),
    (*TEXTS, "lang", "STRING", True),
]
TRANSFORM_RULES = [
    (*SALES, "o_orderstatus", "NULLIF(o_orderstatus, 'P')", "FUNCTION", 1),
    (*LINES, "l_returnflag", "LOWER(NULLIF(l_returnflag, 'N'))", "FUNCTION", 1),
    (*LINES, "l_quantity", "NULLIF(l_quantity, 50)", "FUNCTION", 1),
    (*CLICKS, "event_type", "NULLIF(event_type, 'error')", "FUNCTION", 1),
    (*TEXTS, "text", "TRIM(LOWER(text))", "FUNCTION", 1),
]


def dated(found, dates):
    """Rules with the dates of their versions, by expression; the others hold from the start."""
    day = F.lit("2000-01-01")
    for text, value in dates.items():
        day = F.when(F.col("transform").eqNullSafe(F.lit(text)), F.lit(value)).otherwise(day)
    at = day.cast("timestamp")
    return found.withColumns({"created_date": at, "updated_date": at})


def refine(
    t, combinations, schema: str, rule_tables: bool = False, month="202407", frames=None, changes=None, **options
) -> RunResult:
    """Run the combinations over views of the test tables (or of ``frames``, by combination), into
    tables of ``schema``, by rules given inline or kept in rule tables; ``changes`` are settings."""
    spark = t.spark
    require_shared_warehouse(spark)
    transforms = options.pop("transforms", None)
    # Applications that share a metastore, and runs in one application, have names of their own.
    app = re.sub(r"\W", "_", spark.sparkContext.applicationId)
    settings = replace(SETTINGS, silver_schema=f"{schema}_{app}", bronze_suffix=f"_{schema}", **(changes or {}))
    for combination in combinations:
        if combination not in INPUTS:
            continue
        view = f"{combination.label}_{month}{settings.bronze_suffix}"
        frame = (frames or {}).get(combination)
        (getattr(t, INPUTS[combination]) if frame is None else frame).createOrReplaceGlobalTempView(view)
    ensure_schema(spark, settings.silver_schema)
    transforms = rules.transform_rules(spark, TRANSFORM_RULES) if transforms is None else transforms
    inline = [dated(rules.schema_rules(spark, SCHEMA_RULES), {}), transforms]
    if rule_tables:
        settings = replace(
            settings,
            schema_rules_table=f"{settings.silver_schema}.schema_rules",
            transform_rules_table=f"{settings.silver_schema}.transform_rules",
        )
        rules.create_rule_tables(spark, settings)
        for frame, table in zip(inline, (settings.schema_rules_table, settings.transform_rules_table)):
            frame.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        inline = [None, None]
    now = F.to_timestamp_ntz(F.lit("2024-08-01 00:00:00"))
    return run(spark, settings, month, combinations, *inline, now=now, **options)


_STAGE_COUNTS = """counts AS (
  SELECT 'tpch' AS source, 'retail' AS lob, 'sales' AS domain, count(*) AS a,
         count(*) FILTER (WHERE o_orderstatus <> 'P') AS b,
         count(DISTINCT (o_custkey, o_orderstatus)) FILTER (WHERE o_orderstatus <> 'P') AS c
  FROM orders
  UNION ALL
  SELECT 'tpch', 'retail', 'lines', count(*), count(*) FILTER (WHERE l_quantity <> 50),
         count(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE l_quantity <> 50)
  FROM lineitem
  UNION ALL
  SELECT 'web', 'site', 'clicks', count(*), count(*),
         count(DISTINCT (user_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END))
  FROM events
  UNION ALL
  SELECT 'crawl', 'text', 'texts', count(*), count(*), count(DISTINCT trim(lower(text), ' '))
  FROM documents
  UNION ALL
  SELECT 'crawl', 'text', 'absent', 0, 0, 0)"""


@query(
    f"""WITH {_STAGE_COUNTS}
SELECT source, lob, domain, 'silver_a' AS stage, a AS row_count FROM counts
UNION ALL SELECT source, lob, domain, 'silver_b', b FROM counts
UNION ALL SELECT source, lob, domain, 'silver_c', c FROM counts"""
)
def full_run(t):
    """Five combinations, one without an input, through all stages into written tables."""
    result = refine(t, [*INPUTS, ABSENT], "oreworks_full_run")
    return run_summary({key: result.table(*key) for key in result.written})


@query(
    f"""WITH {_STAGE_COUNTS},
fields(source, lob, domain, f) AS (VALUES
  ('tpch', 'retail', 'sales', 'o_orderkey'), ('tpch', 'retail', 'sales', 'o_custkey'),
  ('tpch', 'retail', 'sales', 'o_orderstatus'), ('tpch', 'retail', 'lines', 'l_orderkey'),
  ('tpch', 'retail', 'lines', 'l_linenumber'), ('tpch', 'retail', 'lines', 'l_quantity'),
  ('web', 'site', 'clicks', 'event_id'), ('web', 'site', 'clicks', 'user_id'),
  ('crawl', 'text', 'texts', 'text'), ('crawl', 'text', 'texts', 'lang')),
metadata(f) AS (VALUES ('quality_score'), ('processed_timestamp'), ('pipeline_stage'))
SELECT source, lob, domain, 'completeness_validation' AS stage,
       source || '_' || lob || '_' || domain AS table_name, 'completeness_' || f AS metric_name,
       100.0::DOUBLE AS metric_value, 95.0::DOUBLE AS threshold, 'PASS' AS status,
       c AS record_count
FROM fields JOIN counts USING (source, lob, domain)
UNION ALL
SELECT source, lob, domain, 'duplicate_detection', source || '_' || lob || '_' || domain,
       'duplicate_percentage', 0.0, 0.0, 'PASS', c
FROM counts WHERE domain <> 'absent'
UNION ALL
SELECT source, lob, domain, 'schema_validation', source || '_' || lob || '_' || domain,
       'extra_field', 0.0, 1.0, 'WARN', NULL
FROM counts, metadata WHERE domain <> 'absent'"""
)
def full_run_quality(t):
    """The quality run over the final tables: no gaps, no duplicates, three added columns."""
    result = refine(t, list(INPUTS), "oreworks_quality_run")
    finals = {c: result.table(c, "silver_c") for c in INPUTS}
    metrics = quality_run(finals, rules.schema_rules(t.spark, SCHEMA_RULES), SETTINGS)
    return metrics.drop("created_timestamp")


_PROPERTIES = ("layer", "source", "lob", "domain", "deduplication_keys")


@query(
    f"""WITH {_STAGE_COUNTS},
stages(stage, keyed) AS (VALUES ('silver_a', false), ('silver_b', false), ('silver_c', true)),
keys(domain, k) AS (VALUES ('sales', 'o_custkey,o_orderstatus'), ('lines', 'l_orderkey,l_linenumber'),
                           ('clicks', 'user_id,event_type'), ('texts', 'text')),
tables AS (SELECT *, CASE stage WHEN 'silver_a' THEN a WHEN 'silver_b' THEN b ELSE c END AS row_count
           FROM counts JOIN keys USING (domain) CROSS JOIN stages)
SELECT source, lob, domain, stage, row_count, p AS property,
       CASE p WHEN 'layer' THEN stage WHEN 'source' THEN source WHEN 'lob' THEN lob
              WHEN 'domain' THEN domain ELSE k END AS value
FROM tables, (SELECT unnest(['layer', 'source', 'lob', 'domain', 'deduplication_keys']) AS p)
WHERE p <> 'deduplication_keys' OR keyed"""
)
def full_run_rule_tables(t):
    """From stored rules to labelled tables: rows of each table, and its properties."""
    result = refine(t, list(INPUTS), "oreworks_stored_rules", rule_tables=True)
    counts = run_summary({key: result.table(*key) for key in result.written})
    labels = None
    for (c, stage), table in result.written.items():
        shown = t.spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key").isin(*_PROPERTIES))
        key = [F.lit(v).alias(n) for n, v in zip(("source", "lob", "domain", "stage"), (*c, stage))]
        own = shown.select(*key, F.col("key").alias("property"), "value")
        labels = own if labels is None else labels.unionAll(own)
    return counts.join(labels, ["source", "lob", "domain", "stage"])


@query(
    """WITH b AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
kept AS (SELECT * FROM b WHERE o_totalprice < 200000)
SELECT 'silver_b' AS stage, 'price_in_range' AS metric_name,
       (SELECT count(*) FROM b WHERE NOT o_totalprice < 200000)::DOUBLE AS metric_value,
       'WARN' AS status, (SELECT count(*) FROM kept) AS record_count
UNION ALL
SELECT 'silver_b', 'not_open', (SELECT count(*) FROM kept WHERE o_orderstatus = 'O')::DOUBLE, 'WARN',
       (SELECT count(*) FROM kept)
UNION ALL
SELECT 'silver_b', 'o_custkey_not_null', 0.0, 'PASS', (SELECT count(*) FROM kept)
UNION ALL
SELECT 'silver_c', 'valid_record_count', 1.0, 'WARN',
       (SELECT count(DISTINCT (o_custkey, o_orderstatus)) FROM kept)
UNION ALL
SELECT 'silver_c', 'no_duplicates_on_business_keys', 0.0, 'PASS',
       (SELECT count(DISTINCT (o_custkey, o_orderstatus)) FROM kept)"""
)
def full_run_expectations(t):
    """Expectations that drop, warn and guard in a run, and checks of a written table."""
    expected = {
        "silver_b": lambda df: {
            "price_in_range": Expectation(F.col("o_totalprice") < 200000, "drop"),
            "o_custkey_not_null": Expectation(F.col("o_custkey").isNotNull(), "fail"),
            "not_open": F.col("o_orderstatus") != "O",
        }
    }
    whole = {"silver_c": TableExpectation(min_records=10**12, unique_keys=True)}
    options = {"expectations": expected, "table_expectations": whole}
    result = refine(t, [SALES], "oreworks_expectations", **options)
    names = [*expected["silver_b"](None), "valid_record_count", "no_duplicates_on_business_keys"]
    found = result.metrics.where(F.col("metric_name").isin(*names))
    return found.select("stage", "metric_name", "metric_value", "status", "record_count")


def _fresh(t, schema: str, *names: str) -> list[str]:
    """The names in the schema of a full run, with what an earlier call has left removed."""
    app = re.sub(r"\W", "_", t.spark.sparkContext.applicationId)
    found = [f"{schema}_{app}.{name}" for name in names]
    for name in found:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    return found


_MONTH_ROWS = """months(run, part) AS (VALUES ('202407', 0), ('202408', 1)),
sales AS (SELECT run, o_custkey, o_orderstatus, o_totalprice FROM orders, months
          WHERE o_orderkey % 2 = part AND (run <> '202408' OR o_totalprice < 200000)),
clicks AS (SELECT run, user_id, event_type FROM events, months WHERE event_id % 2 = part)"""


def _months(t):
    """Two months of orders and events; in the second one, the orders come twice: first all, then
    those below a price."""
    half = lambda df, key, part: df.where(F.col(key) % 2 == part)
    july = {SALES: half(t.orders, "o_orderkey", 0), CLICKS: half(t.events, "event_id", 0)}
    august = {SALES: half(t.orders, "o_orderkey", 1), CLICKS: half(t.events, "event_id", 1)}
    again = {SALES: august[SALES].where("o_totalprice < 200000")}
    return july, august, again


@query(
    f"""WITH {_MONTH_ROWS},
counts AS (
  SELECT run, 'tpch' AS source, 'retail' AS lob, 'sales' AS domain, count(*) AS a,
         count(*) FILTER (WHERE o_orderstatus <> 'P') AS b,
         count(DISTINCT (o_custkey, o_orderstatus)) FILTER (WHERE o_orderstatus <> 'P') AS c,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS open FROM sales GROUP BY run
  UNION ALL
  SELECT run, 'web', 'site', 'clicks', count(*), count(*),
         count(DISTINCT (user_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END)), NULL
  FROM clicks GROUP BY run)
SELECT 'metric' AS kind, run, source, lob, domain, stage, metric_name, metric_value, status, record_count
FROM (
  SELECT run, source, lob, domain, 'silver_b' AS stage, 'transformation_success' AS metric_name,
         1.0::DOUBLE AS metric_value, 'PASS' AS status, b AS record_count FROM counts
  UNION ALL SELECT run, source, lob, domain, 'silver_c', 'silver_c_completeness', 1.0, 'PASS', c FROM counts
  UNION ALL SELECT run, source, lob, domain, 'silver_c', 'rows_removed', (b - c)::DOUBLE, 'PASS', c FROM counts
  UNION ALL SELECT run, source, lob, domain, 'silver_b', 'not_open', open::DOUBLE, 'WARN', b
            FROM counts WHERE domain = 'sales')
UNION ALL
SELECT 'error', '202407', 'tpch', 'retail', 'lines', 'silver_a', 'ValueError', NULL, NULL, NULL"""
)
def full_run_history(t):
    """What the stored history holds after two months, of which the second is run again for one
    combination, and a combination that fails in both and is mended in the second."""
    where = tuple(_fresh(t, "oreworks_history", "metrics", "errors"))
    july, august, again = _months(t)
    checks = {"silver_b": lambda df: {"not_open": F.col("o_orderstatus") != "O"} if "o_orderstatus" in df.columns else {}}
    broken = {LINES: t.lineitem.select(F.col("l_orderkey").alias("no_rule_names_this"))}
    options = {"store": where, "expectations": checks, "raise_failures": False}
    names = [SALES, CLICKS, LINES]
    refine(t, names, "oreworks_history", month="202407", frames={**july, **broken}, **options)
    refine(t, names, "oreworks_history", month="202408", frames={**august, **broken}, **options)
    refine(t, [SALES, LINES], "oreworks_history", month="202408", frames=again, **options)
    metrics, errors = (t.spark.table(name) for name in where)
    told = ("transformation_success", "silver_c_completeness", "rows_removed", "not_open")
    kept = metrics.where(F.col("metric_name").isin(*told) & (F.col("domain") != "lines"))
    key = ["run", "source", "lob", "domain", "stage"]
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return kept.select(
        F.lit("metric").alias("kind"), *key, "metric_name", "metric_value", "status", "record_count"
    ).unionByName(
        errors.select(
            F.lit("error").alias("kind"), *key, F.col("error_type").alias("metric_name"),
            nothing("double", "metric_value"), nothing("string", "status"), nothing("bigint", "record_count"),
        )
    )


@query(
    f"""WITH {_MONTH_ROWS}
SELECT run AS year_month, o_custkey, o_orderstatus, min(o_totalprice) AS o_totalprice
FROM sales WHERE o_orderstatus <> 'P' GROUP BY ALL"""
)
def full_run_months(t):
    """A yearly table of two months, of which one is run twice: the rows of both."""
    july, august, again = _months(t)
    options = {"changes": {"monthly": True, "dedup_order": {"sales": ("o_totalprice",)}}}
    for month, frames in (("202407", july), ("202408", august), ("202408", again)):
        result = refine(t, [SALES], "oreworks_months", month=month, frames=frames, **options)
    whole = t.spark.table(result.written[SALES, "silver_c"])
    return whole.select("year_month", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    """WITH months(run, part) AS (VALUES ('202312', 0), ('202407', 1), ('202408', 2))
SELECT run AS year_month, o_custkey, o_orderstatus, min(o_totalprice) AS o_totalprice
FROM orders, months WHERE o_orderkey % 3 = part AND o_orderstatus <> 'P'
GROUP BY run, o_custkey, o_orderstatus
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY run) = 1"""
)
def full_run_keys_once(t):
    """Three months in tables of two years, one run twice: a key stays in its first month."""
    options = {"changes": {"monthly": True, "keys_once": True, "dedup_order": {"sales": ("o_totalprice",)}}}
    names = []
    for month, part in (("202312", 0), ("202407", 1), ("202407", 1), ("202408", 2)):
        frames = {SALES: t.orders.where(F.col("o_orderkey") % 3 == part)}
        result = refine(t, [SALES], "oreworks_keys_once", month=month, frames=frames, **options)
        names.append(result.written[SALES, "silver_c"])
    whole = reduce(DataFrame.unionByName, map(t.spark.table, dict.fromkeys(names)))
    return whole.select("year_month", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    """SELECT o_custkey, o_orderstatus, min(o_totalprice) AS o_totalprice
FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'P' GROUP BY ALL"""
)
def full_run_rollback(t):
    """After a second run has replaced the table, rolling back gives the rows of the first."""
    july, august, _ = _months(t)
    options = {"changes": {"dedup_order": {"sales": ("o_totalprice",)}}}
    refine(t, [SALES], "oreworks_rollback", frames=july, **options)
    result = refine(t, [SALES], "oreworks_rollback", frames=august, **options)
    versions.rollback(t.spark, result.written[SALES, "silver_c"])
    return result.table(SALES, "silver_c").select("o_custkey", "o_orderstatus", "o_totalprice")


@query(
    """WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
judged AS (SELECT *, concat_ws(',', CASE WHEN NOT o_totalprice < 200000 THEN 'price_in_range' END,
                               CASE WHEN o_custkey % 3 = 0 THEN 'known_customer' END) AS broken_checks FROM b)
SELECT CASE broken_checks WHEN '' THEN 'kept' ELSE 'dropped' END AS side, * FROM judged"""
)
def full_run_quarantine(t):
    """What stage B keeps, and what its expectations drop, with the names of the broken checks."""
    expected = {
        "silver_b": lambda df: {
            "price_in_range": Expectation(F.col("o_totalprice") < 200000, "drop"),
            "known_customer": Expectation(F.col("o_custkey") % 3 != 0, "drop"),
        }
    }
    result = refine(t, [SALES], "oreworks_quarantine", expectations=expected, quarantine=True)
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    kept = result.table(SALES, "silver_b").select(F.lit("kept").alias("side"), *columns, F.lit("").alias("broken_checks"))
    why = F.array_join("broken_checks", ",").alias("broken_checks")
    return kept.unionByName(result.dropped(SALES, "silver_b").select(F.lit("dropped").alias("side"), *columns, why))


@query(
    """SELECT o_custkey, o_orderstatus, count(*) AS row_count FROM orders
WHERE o_orderstatus <> 'P' AND o_totalprice < 200000 GROUP BY ALL"""
)
def full_run_final_only(t):
    """Expectations of stage B hold, too, if only stage C is written."""
    expected = {"silver_b": lambda df: {"price_in_range": Expectation(F.col("o_totalprice") < 200000, "drop")}}
    changes = {"dedup_keys": {"sales": ("o_orderkey",)}}
    result = refine(
        t, [SALES], "oreworks_final_only", changes=changes, materialize=("silver_c",), expectations=expected
    )
    final = result.table(SALES, "silver_c")
    return final.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


_VERSIONS = {
    (*SALES, "o_orderstatus", "NULLIF(o_orderstatus, 'P')", "FUNCTION", 1): "2024-01-01",
    (*SALES, "o_orderstatus", "NULLIF(o_orderstatus, 'O')", "FUNCTION", 1): "2024-08-05",
    (*SALES, "o_totalprice", "ROUND(o_totalprice)", "FUNCTION", 2): "2024-02-01",
    (*SALES, "o_totalprice", None, "FUNCTION", 2): "2024-07-31",
    (*SALES, "o_custkey", "-o_custkey", "FUNCTION", 1): "2024-09-01",
}


@query(
    f"""WITH {_MONTH_ROWS}
SELECT run AS year_month, o_custkey, o_orderstatus, o_totalprice FROM sales
WHERE o_orderstatus <> CASE run WHEN '202407' THEN 'P' ELSE 'O' END"""
)
def full_run_rules_of_month(t):
    """Rules change in August and September; July, run again after that, keeps its own: the rows of
    stage B by month."""
    july, august, again = _months(t)
    transforms = dated(rules.transform_rules(t.spark, list(_VERSIONS)), {r[4]: d for r, d in _VERSIONS.items()})
    options = {"changes": {"monthly": True}, "transforms": transforms, "rules_of_month": True}
    for month, frames in (("202407", august), ("202408", again), ("202407", july)):
        result = refine(t, [SALES], "oreworks_rules_of_month", month=month, frames=frames, **options)
    whole = t.spark.table(result.written[SALES, "silver_b"])
    return whole.select("year_month", "o_custkey", "o_orderstatus", "o_totalprice")


_CHAIN = [
    (*SALES, "o_orderstatus", "CONCAT(o_orderstatus, '-', o_custkey)", "FUNCTION", 1),
    (*SALES, "o_totalprice", "o_totalprice * 2", "FUNCTION", 1),
    (*SALES, "o_totalprice", "IF(o_orderstatus LIKE 'P%', 0, o_totalprice)", "FUNCTION", 2),
    (*SALES, "o_orderkey", "MAX(o_orderkey)", "FUNCTION", 3),
    (*SALES, "o_clerk", "UPPER(o_clerk)", "FUNCTION", 3),
    (*LINES, "l_quantity", "COALESCE(l_quantity, l_linenumber)", "FUNCTION", 1),
    (*LINES, "l_returnflag", "LOWER(\"X\")", "FUNCTION", 1),
]


@query(
    """WITH steps(domain, step, output_column, expression, status, reason, input_columns, source_columns) AS (VALUES
  ('sales', 1, 'o_clerk', 'UPPER(o_clerk)', 'unknown_field', NULL, '', ''),
  ('sales', 2, 'o_orderstatus', 'CONCAT(o_orderstatus, ''-'', o_custkey)', 'applied', NULL,
   'o_custkey,o_orderstatus', 'o_custkey,o_orderstatus'),
  ('sales', 3, 'o_totalprice', 'o_totalprice * 2', 'applied', NULL, 'o_totalprice', 'o_totalprice'),
  ('sales', 4, 'o_totalprice', 'IF(o_orderstatus LIKE ''P%'', 0, o_totalprice)', 'applied', NULL,
   'o_orderstatus,o_totalprice', 'o_custkey,o_orderstatus,o_totalprice'),
  ('sales', 5, 'o_orderkey', 'MAX(o_orderkey)', 'rejected', 'MISSING_GROUP_BY', '', ''),
  ('lines', 1, 'l_quantity', 'COALESCE(l_quantity, l_linenumber)', 'applied', NULL,
   'l_linenumber,l_quantity', 'l_linenumber,l_quantity'),
  ('lines', 2, 'l_returnflag', 'LOWER("X")', 'applied', NULL, '', '')),
sizes AS (SELECT 'sales' AS domain, count(*) AS record_count FROM orders
          UNION ALL SELECT 'lines', count(*) FROM lineitem)
SELECT steps.*, record_count FROM steps JOIN sizes USING (domain)"""
)
def full_run_lineage(t):
    """What each transform rule of a run read, wrote and became, through a chain of rules, with the
    rows of the table it went into."""
    transforms = rules.transform_rules(t.spark, _CHAIN)
    result = refine(t, [SALES, LINES], "oreworks_lineage", transforms=transforms, trace=True)
    sizes = run_summary({k: result.table(*k) for k in result.written if k[1] == "silver_b"})
    told = result.lineage.join(sizes, ["source", "lob", "domain", "stage"])
    names = ["domain", "step", "output_column", "expression", "status", "reason"]
    lists = [F.array_join(c, ",").alias(c) for c in ("input_columns", "source_columns")]
    return told.select(*names, *lists, F.col("row_count").alias("record_count"))
