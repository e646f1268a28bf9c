"""Rule tables, names and inventories. The rule catalogue is drawn from ``part``."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from oreworks.model import Combination
from oreworks.sources import rules, tables
from oreworks.workload.registry import TABLES, query

ONE = Combination("Brand#3", "PROMO", "medical")


def schema_catalog(t):
    """Each part as a schema rule of the combination (brand, type, size class)."""
    return t.part.select(
        F.col("p_brand").alias("source"),
        F.col("p_type").alias("lob"),
        F.expr(
            "CASE WHEN p_size < 15 THEN 'pharmacy' WHEN p_size < 30 THEN 'medical' "
            "WHEN p_size < 45 THEN 'member' ELSE 'vision' END"
        ).alias("domain"),
        F.regexp_replace("p_name", " ", "_").alias("field_name"),
        F.expr(
            "CASE WHEN p_size < 20 THEN 'STRING' WHEN p_size < 35 THEN 'INTEGER' "
            "ELSE 'DATE' END"
        ).alias("data_type"),
        (F.col("p_size") % 2 == 0).alias("is_required"),
        F.current_timestamp().alias("created_date"),
        F.current_timestamp().alias("updated_date"),
    )


SCHEMA_CATALOG = """schema_catalog AS (
  SELECT p_brand AS source, p_type AS lob,
         CASE WHEN p_size < 15 THEN 'pharmacy' WHEN p_size < 30 THEN 'medical'
              WHEN p_size < 45 THEN 'member' ELSE 'vision' END AS domain,
         replace(p_name, ' ', '_') AS field_name,
         CASE WHEN p_size < 20 THEN 'STRING' WHEN p_size < 35 THEN 'INTEGER'
              ELSE 'DATE' END AS data_type,
         p_size % 2 = 0 AS is_required
  FROM part)"""


def transform_catalog(t):
    return schema_catalog(t).select(
        "source",
        "lob",
        "domain",
        "field_name",
        F.format_string("UPPER(%s)", "field_name").alias("transform"),
        F.lit("FUNCTION").alias("transform_type"),
        F.when(F.col("is_required"), 1).otherwise(2).alias("priority"),
        "created_date",
        "updated_date",
    )


TRANSFORM_CATALOG = (
    SCHEMA_CATALOG
    + """,
transform_catalog AS (
  SELECT source, lob, domain, field_name, 'UPPER(' || field_name || ')' AS transform,
         'FUNCTION' AS transform_type, CASE WHEN is_required THEN 1 ELSE 2 END AS priority
  FROM schema_catalog)"""
)


def column_catalog(t):
    """The columns the combinations' tables have: large parts in another letter case."""
    return schema_catalog(t).select(
        "source",
        "lob",
        "domain",
        F.when(F.col("data_type") == "DATE", F.upper("field_name"))
        .otherwise(F.col("field_name"))
        .alias("field_name"),
        F.when(F.col("data_type") == "INTEGER", F.lit("bigint"))
        .otherwise(F.lit("date"))
        .alias("actual_type"),
    )


COLUMN_CATALOG = """column_catalog AS (
  SELECT source, lob, domain,
         CASE WHEN data_type = 'DATE' THEN upper(field_name) ELSE field_name END AS field_name,
         CASE WHEN data_type = 'INTEGER' THEN 'bigint' ELSE 'date' END AS actual_type
  FROM schema_catalog)"""


@query(
    f"""WITH {SCHEMA_CATALOG}
SELECT field_name, data_type, is_required FROM schema_catalog
WHERE source = 'Brand#3' AND lob = 'PROMO' AND domain = 'medical'"""
)
def schema_rules_lookup(t):
    return rules.lookup_schema_rules(schema_catalog(t), ONE)


@query(
    f"""WITH {TRANSFORM_CATALOG}
SELECT field_name, transform, transform_type, priority FROM transform_catalog
WHERE source = 'Brand#3' AND lob = 'PROMO' AND domain = 'medical'"""
)
def transform_rules_lookup(t):
    return rules.lookup_transform_rules(transform_catalog(t), ONE)


def document_config(t):
    """Each document source as a configured source with two lines of business."""
    return (
        t.documents.select(F.col("source").alias("name"))
        .distinct()
        .select(
            "name",
            F.array(F.lit("lob1"), F.lit("lob2")).alias("lobs"),
            F.array(*map(F.lit, ("pharmacy", "medical", "member", "vision"))).alias("domains"),
        )
    )


_COMBINATIONS = """combinations AS (
  SELECT source, lob, domain
  FROM (SELECT DISTINCT source FROM documents)
  CROSS JOIN (VALUES ('lob1'), ('lob2')) AS l(lob)
  CROSS JOIN (VALUES ('pharmacy'), ('medical'), ('member'), ('vision')) AS d(domain))"""


@query(f"WITH {_COMBINATIONS} SELECT source, lob, domain FROM combinations")
def source_combinations(t):
    return rules.combinations(document_config(t))


@query(
    f"""WITH {_COMBINATIONS}
SELECT source, lob, domain,
       'bronze.' || source || '_' || lob || '_' || domain || '_202407_bronze' AS bronze_table,
       'silver.' || source || '_' || lob || '_' || domain || '_silver_a' AS silver_table,
       'silver.' || source || '_' || lob || '_' || domain || '_2024_silver_c' AS yearly_table
FROM combinations"""
)
def table_names(t):
    return rules.combinations(document_config(t)).select(
        "*",
        tables.bronze_table_name("202407").alias("bronze_table"),
        tables.silver_table_name("silver_a").alias("silver_table"),
        tables.silver_table_name("silver_c", year="2024").alias("yearly_table"),
    )


@query(
    f"""WITH {_COMBINATIONS}
SELECT source, lob, domain,
       CASE domain WHEN 'pharmacy' THEN 'patient_id,ndc,service_date'
                   WHEN 'medical' THEN 'patient_id,procedure_code,service_date'
                   WHEN 'member' THEN 'member_id,effective_date'
                   ELSE 'patient_id,service_date' END AS deduplication_keys
FROM combinations"""
)
def dedup_key_lookup(t):
    return rules.combinations(document_config(t)).select(
        "*",
        F.array_join(rules.dedup_keys(F.col("domain")), ",").alias("deduplication_keys"),
    )


@query(
    f"""WITH {SCHEMA_CATALOG}
SELECT source, lob, domain, count(*) AS rule_count FROM schema_catalog GROUP BY ALL"""
)
def rule_counts(t):
    return rules.rule_counts(schema_catalog(t))


_LINT_GROUPS = """grouped AS (
  SELECT source, lob, domain, field_name, count(*) AS occurrences FROM keyed GROUP BY ALL)"""


@query(
    f"""WITH {SCHEMA_CATALOG},
keyed AS (
  SELECT source, lob, domain, nullif(field_name, 'red_widget') AS field_name FROM schema_catalog),
{_LINT_GROUPS},
{COLUMN_CATALOG}
SELECT *, 'invalid_domain' AS finding FROM grouped WHERE domain = 'vision'
UNION ALL
SELECT *, 'null_key' FROM grouped WHERE field_name IS NULL
UNION ALL
SELECT *, 'duplicate_rule' FROM grouped WHERE occurrences > 1
UNION ALL
SELECT g.*, 'case_mismatch' FROM grouped g
WHERE EXISTS (SELECT 1 FROM column_catalog c WHERE c.source = g.source AND c.lob = g.lob
              AND c.domain = g.domain AND lower(c.field_name) = lower(g.field_name))
  AND NOT EXISTS (SELECT 1 FROM column_catalog c WHERE c.source = g.source AND c.lob = g.lob
                  AND c.domain = g.domain AND c.field_name = g.field_name)"""
)
def rule_lint(t):
    catalog = schema_catalog(t).withColumn("field_name", F.expr("nullif(field_name, 'red_widget')"))
    return rules.lint_rules(catalog, table_columns=column_catalog(t))


@query(
    f"""WITH {TRANSFORM_CATALOG},
keyed AS (
  SELECT source, lob, domain, field_name, count(*) AS occurrences
  FROM transform_catalog GROUP BY source, lob, domain, field_name, transform, priority)
SELECT *, 'invalid_domain' AS finding FROM keyed WHERE domain = 'vision'
UNION ALL
SELECT *, 'duplicate_rule' FROM keyed WHERE occurrences > 1"""
)
def transform_rule_lint(t):
    return rules.lint_rules(transform_catalog(t))


@query(
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, true AS exists, "
        f"(SELECT count(*) FROM (DESCRIBE {name}))::INTEGER AS column_count, "
        f"(SELECT count(*) FROM {name}) AS row_count"
        for name in TABLES
    )
)
def table_inventory(t):
    with ThreadPoolExecutor(len(TABLES)) as pool:  # opening a table reads its schema
        return tables.inventory(dict(zip(TABLES, pool.map(lambda name: getattr(t, name), TABLES))))


@query("SELECT * FROM documents ORDER BY doc_id LIMIT 5")
def sample_documents(t):
    return tables.sample_rows(t.documents, 5, "doc_id")
