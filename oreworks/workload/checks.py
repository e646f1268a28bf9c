"""Validators, expectations and summaries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreworks.model import Combination, Settings
from oreworks.operators import checks, expectations, report, summary
from oreworks.operators.dedup import duplicate_groups as groups_of_duplicates
from oreworks.operators.score import add_metadata, add_quality_score
from oreworks.operators.selection import rule_fields
from oreworks.operators.transform import transform_by_rules
from oreworks.plans.quality import quality_run
from oreworks.sources import rules
from oreworks.sources.rules import schema_rule_list, transform_rule_list
from oreworks.workload.catalog import (
    COLUMN_CATALOG,
    SCHEMA_CATALOG,
    column_catalog,
    schema_catalog,
)
from oreworks.workload.registry import query
from oreworks.workload.runs import refine
from oreworks.workload.stages import (
    LINE_KEYS,
    ORDER_FIELDS,
    ORDER_GAPS_SQL,
    ORDER_SCORE_SQL,
    fixed_now,
    orders_with_gaps,
)

SALES = Combination("tpch", "retail", "sales")
LINES = Combination("tpch", "retail", "lines")
LABEL_SQL = "'tpch' AS source, 'retail' AS lob, 'sales' AS domain"

# --------------------------------------------------------------------------
# Schema and types
# --------------------------------------------------------------------------

_MATCHED = f"""{SCHEMA_CATALOG},
{COLUMN_CATALOG},
ruled AS (
  SELECT source, lob, domain, field_name, bool_or(is_required) AS required,
         min(data_type) AS expected_type
  FROM schema_catalog GROUP BY ALL),
found AS (
  SELECT source, lob, domain, field_name, min(actual_type) AS actual_type
  FROM column_catalog GROUP BY ALL)"""


@query(
    f"""WITH {_MATCHED}
SELECT source, lob, domain, 'missing_required_field' AS check_type, field_name, 'FAIL' AS status,
       'Required field ' || field_name || ' is missing' AS message
FROM ruled ANTI JOIN found USING (source, lob, domain, field_name) WHERE required
UNION ALL
SELECT source, lob, domain, 'extra_field', field_name, 'WARN',
       'Unexpected field ' || field_name || ' found'
FROM found ANTI JOIN ruled USING (source, lob, domain, field_name)"""
)
def schema_findings(t):
    return checks.schema_findings(schema_catalog(t), column_catalog(t))


@query(
    f"""WITH {_MATCHED},
every AS (
  SELECT source, lob, domain, required, r.field_name AS ruled, f.field_name AS found
  FROM ruled r FULL JOIN found f USING (source, lob, domain, field_name))
SELECT source, lob, domain, count(*) FILTER (WHERE required AND found IS NULL) AS missing_required,
       count(*) FILTER (WHERE ruled IS NULL) AS extra_fields,
       CASE WHEN count(*) FILTER (WHERE required AND found IS NULL) > 0 THEN 'FAIL'
            WHEN count(*) FILTER (WHERE ruled IS NULL) > 0 THEN 'WARN' ELSE 'PASS' END
         AS overall_status
FROM every GROUP BY ALL"""
)
def schema_compliance(t):
    return checks.schema_compliance(schema_catalog(t), column_catalog(t))


@query(
    f"""WITH {_MATCHED}
SELECT source, lob, domain, field_name, expected_type, actual_type,
       (expected_type = 'INTEGER' AND actual_type = 'bigint')
         OR (expected_type = 'DATE' AND actual_type = 'date') AS matches,
       CASE WHEN (expected_type = 'INTEGER' AND actual_type = 'bigint')
              OR (expected_type = 'DATE' AND actual_type = 'date')
            THEN 'PASS' ELSE 'FAIL' END AS status
FROM ruled JOIN found USING (source, lob, domain, field_name)"""
)
def data_types(t):
    return checks.type_checks(schema_catalog(t), column_catalog(t))


# --------------------------------------------------------------------------
# Completeness and duplicates
# --------------------------------------------------------------------------


@query(
    f"""WITH {ORDER_GAPS_SQL},
n AS (SELECT count(*) AS total, count(*) - count(o_custkey) AS cust,
             count(*) - count(o_orderkey) AS okey, count(*) - count(o_orderstatus) AS stat FROM gaps),
f AS (
  SELECT 'field' AS level, 'o_custkey' AS field_name, total, cust AS null_count FROM n
  UNION ALL SELECT 'field', 'o_orderkey', total, okey FROM n
  UNION ALL SELECT 'field', 'o_orderstatus', total, stat FROM n),
p AS (SELECT *, (total - null_count) / total * 100 AS completeness_percent FROM f)
SELECT {LABEL_SQL}, total AS total_records, level, field_name, null_count, completeness_percent,
       CASE WHEN completeness_percent >= 95 THEN 'PASS' ELSE 'FAIL' END AS status,
       'o_not_there' AS missing_fields
FROM p
UNION ALL
SELECT {LABEL_SQL}, total, 'overall', NULL, cust + okey + stat,
       (total * 4 - (cust + okey + stat)) / (total * 4) * 100,
       CASE WHEN (SELECT min(completeness_percent) FROM p) >= 95 THEN 'PASS' ELSE 'FAIL' END,
       'o_not_there'
FROM n"""
)
def completeness_orders(t):
    required = ["o_custkey", "o_not_there", "o_orderkey", "o_orderstatus"]
    found = checks.completeness(orders_with_gaps(t), SALES, required)
    return found.withColumn("missing_fields", F.array_join("missing_fields", ","))


_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


@query(
    f"""WITH n AS (SELECT count(*) AS total, unnest(['{"', '".join(_LINE_COLUMNS)}']) AS f,
  unnest([{", ".join(f"count(*) - count({c})" for c in _LINE_COLUMNS)}]) AS gaps
  FROM (SELECT * REPLACE (nullif(l_quantity, 50) AS l_quantity,
                          nullif(l_returnflag, 'N') AS l_returnflag) FROM lineitem))
SELECT 'tpch' AS source, 'retail' AS lob, 'lines' AS domain, total AS total_records,
       'field' AS level, f AS field_name, gaps AS null_count,
       (total - gaps) / total * 100 AS completeness_percent,
       CASE WHEN (total - gaps) / total * 100 >= 95 THEN 'PASS' ELSE 'FAIL' END AS status,
       '' AS missing_fields FROM n
UNION ALL
SELECT 'tpch', 'retail', 'lines', max(total), 'overall', NULL, CAST(sum(gaps) AS BIGINT),
       (max(total) * 11 - sum(gaps)) / (max(total) * 11) * 100,
       CASE WHEN min((total - gaps) / total * 100) >= 95 THEN 'PASS' ELSE 'FAIL' END, '' FROM n"""
)
def completeness_lineitem(t):
    """Every column of the widest table in one aggregate; two have gaps."""
    gaps = transform_rule_list(
        [("l_quantity", "NULLIF(l_quantity, 50)", 1), ("l_returnflag", "NULLIF(l_returnflag, 'N')", 1)]
    )
    found = checks.completeness(transform_by_rules(t.lineitem, gaps), LINES, _LINE_COLUMNS)
    return found.withColumn("missing_fields", F.array_join("missing_fields", ","))


_KEY_COUNTS = (
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber"
)


@query(
    f"""WITH k AS ({_KEY_COUNTS}),
n AS (SELECT CAST(sum(row_count) AS BIGINT) AS total, count(*) AS uniq,
             count(*) FILTER (WHERE row_count > 1) AS dup FROM k)
SELECT {LABEL_SQL}, total AS total_records, uniq AS unique_records, total - uniq AS duplicate_count,
       (total - uniq) / total * 100 AS duplicate_percentage, dup AS duplicate_groups,
       CASE WHEN total = uniq THEN 'PASS' ELSE 'WARN' END AS status,
       CAST(NULL AS VARCHAR) AS message
FROM n"""
)
def duplicates_lineitem(t):
    return checks.duplicates(t.lineitem, SALES, [*LINE_KEYS, "l_not_there"])


@query(
    f"""WITH g AS (SELECT user_id, nullif(event_type, 'error') AS event_type FROM events),
d AS (SELECT count(*) AS uniq FROM (SELECT DISTINCT * FROM g)),
n AS (SELECT count(*) AS total FROM g),
r AS (SELECT count(*) AS dup FROM (SELECT 1 FROM g GROUP BY user_id, event_type HAVING count(*) > 1))
SELECT {LABEL_SQL}, total AS total_records, uniq AS unique_records, total - uniq AS duplicate_count,
       (total - uniq) / total * 100 AS duplicate_percentage, dup AS duplicate_groups,
       'WARN' AS status, CAST(NULL AS VARCHAR) AS message
FROM n, d, r"""
)
def duplicates_with_null_keys(t):
    """NULL is one key value, where a plain distinct count over columns would skip it."""
    events = t.events.withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return checks.duplicates(events, SALES, ["user_id", "event_type"])


@query(_KEY_COUNTS + " HAVING count(*) > 1")
def duplicate_groups(t):
    return groups_of_duplicates(t.lineitem, LINE_KEYS)


# --------------------------------------------------------------------------
# Report and history
# --------------------------------------------------------------------------

_REPORT_RULES = [
    (*SALES, "o_orderkey", "BIGINT", True),
    (*SALES, "o_custkey", "BIGINT", True),
    (*SALES, "o_orderstatus", "STRING", True),
    (*SALES, "o_clerk", "STRING", True),
    (*SALES, "o_totalprice", "INTEGER", False),
    (*LINES, "l_orderkey", "BIGINT", True),
    (*LINES, "l_linenumber", "INTEGER", True),
    (*LINES, "l_shipdate", "TIMESTAMP", True),
]

_REPORT_COLUMNS = (
    "source, lob, domain, stage, source || '_' || lob || '_' || domain AS table_name, "
    "metric_name, metric_value, threshold, status, record_count"
)


def _report(t, include_types=False):
    return quality_run(
        {SALES: orders_with_gaps(t), LINES: t.lineitem},
        rules.schema_rules(t.spark, _REPORT_RULES),
        Settings(dedup_keys={"lines": LINE_KEYS, "sales": ["o_orderkey"]}),
        include_types=include_types,
        now=F.to_timestamp(F.lit("2024-08-01 00:00:00")),
    )


_REPORT_BASE = f"""{ORDER_GAPS_SQL},
sales AS (SELECT count(*) AS n, count(o_orderkey) AS a, count(o_custkey) AS b,
                 count(o_orderstatus) AS c, count(DISTINCT o_orderkey) AS u FROM gaps),
lines AS (SELECT count(*) AS n, count(l_orderkey) AS a, count(l_linenumber) AS b,
                 count(l_shipdate) AS c, count(DISTINCT (l_orderkey, l_linenumber)) AS u
          FROM lineitem),
filled AS (
  SELECT 'sales' AS domain, 'o_orderkey' AS f, n, a AS k FROM sales
  UNION ALL SELECT 'sales', 'o_custkey', n, b FROM sales
  UNION ALL SELECT 'sales', 'o_orderstatus', n, c FROM sales
  UNION ALL SELECT 'lines', 'l_orderkey', n, a FROM lines
  UNION ALL SELECT 'lines', 'l_linenumber', n, b FROM lines
  UNION ALL SELECT 'lines', 'l_shipdate', n, c FROM lines),
dups AS (SELECT 'sales' AS domain, n, n - u AS d FROM sales
         UNION ALL SELECT 'lines', n, n - u FROM lines),
fields AS (
  SELECT 'sales' AS domain, unnest(['o_orderdate', 'o_orderpriority']) AS f
  UNION ALL
  SELECT 'lines', unnest(['l_partkey', 'l_suppkey', 'l_quantity', 'l_extendedprice', 'l_discount',
                          'l_tax', 'l_returnflag', 'l_linestatus'])),
report AS (
  SELECT 'tpch' AS source, 'retail' AS lob, domain, 'schema_validation' AS stage,
         'extra_field' AS metric_name, 0.0::DOUBLE AS metric_value, 1.0::DOUBLE AS threshold,
         'WARN' AS status, CAST(NULL AS BIGINT) AS record_count
  FROM fields
  UNION ALL
  SELECT 'tpch', 'retail', 'sales', 'schema_validation', 'missing_required_field', 0.0, 1.0,
         'FAIL', NULL
  UNION ALL
  SELECT 'tpch', 'retail', domain, 'completeness_validation', 'completeness_' || f, k / n * 100,
         95.0, CASE WHEN k / n * 100 >= 95 THEN 'PASS' ELSE 'FAIL' END, n
  FROM filled
  UNION ALL
  SELECT 'tpch', 'retail', domain, 'duplicate_detection', 'duplicate_percentage', d / n * 100,
         0.0, CASE WHEN d = 0 THEN 'PASS' ELSE 'WARN' END, n
  FROM dups)"""


@query(f"WITH {_REPORT_BASE} SELECT {_REPORT_COLUMNS} FROM report")
def quality_report(t):
    return _report(t).drop("created_timestamp")


@query(
    f"""WITH {_REPORT_BASE},
typed(domain, f, ok) AS (VALUES
  ('sales', 'o_orderkey', true), ('sales', 'o_custkey', true), ('sales', 'o_orderstatus', true),
  ('sales', 'o_totalprice', false), ('lines', 'l_orderkey', true), ('lines', 'l_linenumber', true),
  ('lines', 'l_shipdate', true))
SELECT {_REPORT_COLUMNS} FROM report
UNION ALL
SELECT 'tpch', 'retail', domain, 'type_validation', 'tpch_retail_' || domain, 'type_' || f,
       ok::INTEGER::DOUBLE, 1.0, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END, NULL
FROM typed"""
)
def quality_report_with_types(t):
    return _report(t, include_types=True).drop("created_timestamp")


@query(
    """SELECT event_type AS source, 'web' AS lob, 'day' || day(ts) AS domain, 'ingest' AS stage,
       event_type || '_web_day' || day(ts) AS table_name, 'mean_value' AS metric_name,
       count(value) / count(*) * 100 AS metric_value, 95.0::DOUBLE AS threshold, 'PASS' AS status,
       count(*) AS record_count, max(ts) AS created_timestamp
FROM events WHERE event_type = 'click' AND day(ts) = 7 GROUP BY ALL"""
)
def quality_history(t):
    metrics = (
        t.events.groupBy(
            F.col("event_type").alias("source"),
            F.concat(F.lit("day"), F.dayofmonth("ts").cast("string")).alias("domain"),
        )
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count("value").alias("filled"),
            F.max("ts").alias("created_timestamp"),
        )
        .select(
            "source",
            F.lit("web").alias("lob"),
            "domain",
            F.lit("ingest").alias("stage"),
            F.concat_ws("_web_", "source", "domain").alias("table_name"),
            F.lit("mean_value").alias("metric_name"),
            (F.col("filled") / F.col("record_count") * 100).alias("metric_value"),
            F.lit(95.0).alias("threshold"),
            F.lit("PASS").alias("status"),
            "record_count",
            "created_timestamp",
        )
    )
    return report.quality_history(metrics, "click", "day7")


# --------------------------------------------------------------------------
# Expectations
# --------------------------------------------------------------------------


def _expected_events(t):
    """Events as a stage C table: scored and stamped, with a gap in one column."""
    gaps = t.events.select(
        "event_id",
        F.col("ts").alias("service_date"),
        F.nullif("user_id", F.lit(7)).alias("patient_id"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("amount"),
        F.col("props"),
    )
    return add_metadata(add_quality_score(gaps), now=F.col("service_date"))


_EXPECTED_EVENTS = """e AS (
  SELECT event_id, ts AS service_date, nullif(user_id, 7) AS patient_id,
         CASE WHEN event_type <> 'error' THEN value END AS amount, props FROM events),
s AS (
  SELECT *, CAST((3 + (patient_id IS NOT NULL)::INTEGER + (amount IS NOT NULL)::INTEGER)
                 / 5.0::DOUBLE AS DECIMAL(3,2)) AS quality_score,
         service_date AS processed_timestamp, 'silver_c' AS pipeline_stage FROM e)"""


def _counted(name: str, predicate: str) -> str:
    bad = f"count(*) FILTER (WHERE NOT coalesce({predicate}, false))"
    return (
        f"SELECT '{name}' AS expectation, count(*) AS total_records, {bad} AS violations, "
        f"CASE WHEN {bad} = 0 THEN 'PASS' ELSE 'WARN' END AS status FROM s"
    )


_PREDICATES = {
    "no_null_required_fields": "patient_id IS NOT NULL AND event_id IS NOT NULL",
    "patient_id_not_null": "patient_id IS NOT NULL",
    "valid_date_format": r"regexp_matches(CAST(CAST(service_date AS DATE) AS VARCHAR), '^\d{4}-\d{2}-\d{2}$')",
    "valid_amount_range": "amount BETWEEN 0 AND 999999.99",
    "acceptable_quality_scores": "quality_score >= 0.5",
    "correct_pipeline_stage": "pipeline_stage = 'silver_c'",
}


def _checks(df):
    return {
        **expectations.no_null_required_fields(df, ["patient_id", "event_id", "not_there"]),
        **expectations.not_null("patient_id"),
        **expectations.valid_date_format("service_date"),
        **expectations.valid_amount_range("amount"),
        **expectations.acceptable_quality_scores(df),
        **expectations.correct_pipeline_stage(df),
    }


def _dated_events(t):
    return _expected_events(t).withColumn("service_date", F.to_date("service_date"))


@query(
    f"WITH {_EXPECTED_EVENTS}\nSELECT 'valid_record_count' AS expectation, count(*) AS total_records, "
    "(count(*) < 100)::BIGINT AS violations, "
    "CASE WHEN count(*) >= 100 THEN 'PASS' ELSE 'WARN' END AS status FROM s\nUNION ALL\n"
    + "\nUNION ALL\n".join(_counted(n, p) for n, p in _PREDICATES.items())
)
def expect_warn_counts(t):
    df = _dated_events(t)
    return expectations.expectation_counts(df, _checks(df), min_records=100)


@query(
    f"WITH {_EXPECTED_EVENTS}\nSELECT * REPLACE (CAST(service_date AS DATE) AS service_date) FROM s "
    "WHERE patient_id IS NOT NULL AND amount BETWEEN 0 AND 999999.99"
)
def expect_drop(t):
    df = _dated_events(t)
    return expectations.expect(df, _checks(df), "drop")


@query("SELECT * FROM orders")
def expect_fail(t):
    """Every order passes, so the guarded table comes through whole."""
    required = expectations.no_null_required_fields(t.orders, ["o_orderkey", "o_custkey"])
    return expectations.expect(t.orders, required, "fail")


@query(
    f"WITH {_EXPECTED_EVENTS}\n"
    + _counted(
        "recent_processing_timestamp",
        "processed_timestamp >= CAST(DATE '2024-01-20' - 1 AS TIMESTAMP)",
    )
)
def expect_recent(t):
    df = _expected_events(t)
    now = F.to_timestamp_ntz(F.lit("2024-01-20 15:30:00"))
    return expectations.expectation_counts(df, expectations.recent_processing_timestamp(df, now))


@query(
    """WITH v AS (SELECT doc_id, source, replace(source, 'src', '') AS code,
               nullif(lang, 'en') AS lang, nullif(source, 'src1') AS kind,
               CASE WHEN n_chars > 500 THEN n_chars::DOUBLE END AS size FROM documents)
SELECT 'valid_data_types_' || f AS expectation, n AS total_records, bad AS violations,
       CASE WHEN bad = 0 THEN 'PASS' ELSE 'WARN' END AS status
FROM (SELECT unnest(['doc_id', 'source', 'code', 'lang', 'size', 'kind']) AS f,
             unnest([0, 0, count(*) FILTER (WHERE TRY_CAST(code AS INTEGER) IS NULL),
                     count(*) FILTER (WHERE lang IS NOT NULL), count(size), count(kind)]) AS bad,
             count(*) AS n FROM v)"""
)
def expect_valid_types(t):
    """Values that do not convert to their rule's type; ``lang`` is declared a date, and so is
    the number ``size``, which Spark never converts; the type of ``kind`` is none."""
    df = t.documents.select(
        "doc_id",
        "source",
        F.replace("source", F.lit("src"), F.lit("")).alias("code"),
        F.nullif("lang", F.lit("en")).alias("lang"),
        F.when(F.col("n_chars") > 500, F.col("n_chars").cast("double")).alias("size"),
        F.nullif("source", F.lit("src1")).alias("kind"),
    )
    fields = schema_rule_list(
        [("doc_id", "INTEGER", True), ("source", "STRING", True), ("code", "INTEGER", False),
         ("lang", "DATE", False), ("size", "DATE", False), ("kind", "VARCHR", False),
         ("not_there", "DATE", False)]
    )
    return expectations.expectation_counts(df, expectations.valid_data_types(df, fields))


@query(
    f"""WITH k AS ({_KEY_COUNTS})
SELECT 'no_duplicates_on_business_keys' AS expectation, CAST(sum(row_count) AS BIGINT)
         AS total_records, count(*) FILTER (WHERE row_count > 1) AS violations,
       CASE WHEN count(*) FILTER (WHERE row_count > 1) = 0 THEN 'PASS' ELSE 'WARN' END AS status
FROM k"""
)
def expect_no_duplicates(t):
    return expectations.no_duplicates_on_business_keys(t.lineitem, LINE_KEYS)


# --------------------------------------------------------------------------
# Stage checks and summaries
# --------------------------------------------------------------------------


@query(
    f"""WITH b AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')
SELECT {LABEL_SQL}, 'silver_b' AS stage, 'transformation_success' AS metric_name,
       0.0::DOUBLE AS metric_value, 1.0::DOUBLE AS threshold, 'WARN' AS status,
       count(*) AS record_count FROM b
UNION ALL
SELECT {LABEL_SQL}, 'silver_c', 'silver_c_completeness', 1.0, 1.0, 'PASS',
       count(DISTINCT (o_custkey, o_orderstatus)) FROM b"""
)
def stage_checks(t):
    """Over written tables; the rules name a field that no table has."""
    written = written_stages(t, "oreworks_stage_checks")
    b, c = written[SALES, "silver_b"], written[SALES, "silver_c"]
    return checks.transformation_check(b, SALES, rule_fields(ORDER_FIELDS)).unionByName(
        checks.completion_check(c, SALES)
    )


@query(
    f"""WITH {ORDER_GAPS_SQL}, s AS (SELECT {ORDER_SCORE_SQL} AS q FROM gaps)
SELECT CAST(sum(q) AS DOUBLE) / count(*) AS avg_quality, CAST(min(q) AS DOUBLE) AS min_quality,
       CAST(max(q) AS DOUBLE) AS max_quality FROM s"""
)
def quality_stats(t):
    stats = summary.quality_stats(add_quality_score(orders_with_gaps(t)))
    return stats


def written_stages(t, schema: str):
    """The stage tables of the orders, as a run writes them."""
    result = refine(t, [SALES], schema)
    return {key: result.table(*key) for key in result.written}


_WRITTEN_SQL = """stages AS (
  SELECT 'silver_a' AS stage, o_totalprice, o_orderstatus FROM orders
  UNION ALL
  SELECT 'silver_b', o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT 'silver_c', min(o_totalprice), o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
  GROUP BY o_custkey, o_orderstatus)"""
_SUMMARY_LABELS = "'tpch' AS source, 'retail' AS lob, 'sales' AS domain"


@query(
    f"WITH {_WRITTEN_SQL}\nSELECT {_SUMMARY_LABELS}, stage, count(*) AS row_count "
    "FROM stages GROUP BY stage"
)
def run_summary(t):
    return summary.run_summary(written_stages(t, "oreworks_run_summary"))


@query(
    f"WITH {_WRITTEN_SQL}\nSELECT {_SUMMARY_LABELS}, stage, count(*) AS row_count FROM stages "
    "WHERE o_totalprice > 0 AND o_orderstatus IS NOT NULL GROUP BY stage"
)
def validation_counts(t):
    """Rows of the written tables with no NULL in the fields asked for."""
    written = written_stages(t, "oreworks_validation_counts")
    return summary.validation_counts(written, {SALES: ["o_totalprice", "o_orderstatus"]})


@query(
    f"""WITH {ORDER_GAPS_SQL}, s AS (SELECT {ORDER_SCORE_SQL} AS q FROM gaps),
k AS ({_KEY_COUNTS}),
r AS (
  SELECT 'deduplication' AS step, CAST(sum(row_count) AS BIGINT) AS rows_before,
         count(*) AS rows_after FROM k
  UNION ALL
  SELECT 'quality_filter', count(*), count(*) FILTER (WHERE q >= 0.7) FROM s)
SELECT *, rows_before - rows_after AS rows_removed FROM r"""
)
def rows_removed(t):
    return summary.removed_by_dedup(t.lineitem, LINE_KEYS).unionByName(
        summary.removed_by_quality(add_quality_score(orders_with_gaps(t)))
    )


def error_log(t):
    """Each event as an error log row of the type its event has."""
    return t.events.select(
        F.col("event_id").cast("string").alias("error_id"),
        F.col("ts").alias("timestamp"),
        F.lit("web").alias("source"),
        F.nullif("event_type", F.lit("view")).alias("lob"),
        F.lit(None).cast("string").alias("domain"),
        F.lit("silver_a").alias("stage"),
        F.col("event_type").alias("error_type"),
        F.concat(F.lit("value "), F.get_json_object("props", "$.k")).alias("error_message"),
        F.lit(None).cast("string").alias("stack_trace"),
        F.lit(None).cast("bigint").alias("record_count"),
        F.to_json(F.struct("user_id")).alias("additional_context"),
    )


@query(
    """SELECT event_type AS error_type, count(*) AS error_count FROM events GROUP BY event_type
UNION ALL SELECT NULL, count(*) FROM events"""
)
def error_summary(t):
    return summary.error_summary(error_log(t))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS error_id,
       CAST(to_json({'user_id': user_id}) AS VARCHAR) AS additional_context FROM events"""
)
def error_contexts(t):
    return error_log(t).select("error_id", "additional_context")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS error_id, ts AS timestamp, event_type AS error_type,
       'value ' || json_extract_string(props, '$.k') AS error_message,
       'web/' || coalesce(nullif(event_type, 'view'), 'None') || '/None/silver_a' AS context
FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) LIMIT 5"""
)
def latest_errors(t):
    return summary.latest_errors(error_log(t))


@query(
    """WITH r AS (
  SELECT event_type AS source, 'web' AS lob, CAST(user_id AS VARCHAR) AS domain,
         'silver_a' AS stage, count(*) AS record_count,
         date_diff('microsecond', min(ts), max(ts)) / 1000000 AS seconds
  FROM events GROUP BY event_type, user_id)
SELECT *, CASE WHEN seconds > 0 THEN record_count / seconds ELSE 0 END AS records_per_second FROM r"""
)
def throughput_metrics(t):
    """Each user and event type as a stage run from its first event to its last."""
    run_log = (
        t.events.groupBy("event_type", "user_id")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            (F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / 1000000).alias("seconds"),
        )
        .select(
            F.col("event_type").alias("source"),
            F.lit("web").alias("lob"),
            F.col("user_id").cast("string").alias("domain"),
            F.lit("silver_a").alias("stage"),
            "record_count",
            "seconds",
        )
    )
    return summary.throughput(run_log)
