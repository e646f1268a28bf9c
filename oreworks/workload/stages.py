"""The three refinement stages over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreworks.operators.dedup import deduplicate, deduplicate_month
from oreworks.operators.required import drop_low_quality
from oreworks.operators.score import add_quality_score
from oreworks.operators.transform import transform_by_rules
from oreworks.plans.silver import silver, silver_a, silver_b, silver_c
from oreworks.sources.rules import schema_rule_list, transform_rule_list
from oreworks.workload.registry import query



def fixed_now():
    """A fixed processing time, so that results can be compared."""
    return F.to_timestamp_ntz(F.lit("2024-08-01 00:00:00"))


NOW_SQL = "TIMESTAMP '2024-08-01 00:00:00'"

ORDER_FIELDS = schema_rule_list(
    [
        ("o_orderkey", "BIGINT", True),
        ("o_custkey", "BIGINT", True),
        ("o_orderstatus", "STRING", True),
        ("o_totalprice", "DOUBLE", False),
        ("o_orderdate", "TIMESTAMP", None),
        ("o_not_there", "STRING", False),
    ]
)

# The test tables hold no NULL; these rules put some in.
ORDER_GAPS = transform_rule_list(
    [
        ("o_orderstatus", "NULLIF(o_orderstatus, 'P')", 1),
        ("o_orderpriority", "NULLIF(o_orderpriority, '5-LOW')", 1),
        ("o_custkey", "CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_custkey END", 1),
    ]
)
ORDER_GAPS_SQL = """gaps AS (
  SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_custkey END AS o_custkey,
         nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate,
         nullif(o_orderpriority, '5-LOW') AS o_orderpriority
  FROM orders)"""


def orders_with_gaps(t):
    return transform_by_rules(t.orders, ORDER_GAPS)


def non_null_terms(*names: str) -> str:
    return " + ".join(f"({n} IS NOT NULL)::INTEGER" for n in names)


ORDER_SCORE_SQL = (
    "CAST(("
    + non_null_terms(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    + ") / 6.0::DOUBLE AS DECIMAL(3,2))"
)


# --------------------------------------------------------------------------
# Stage A
# --------------------------------------------------------------------------


@query(
    """SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL AND o_orderstatus IS NOT NULL"""
)
def silver_a_orders(t):
    return silver_a(t.orders, ORDER_FIELDS)


@query("SELECT * FROM conversations")
def silver_a_without_rules(t):
    return silver_a(t.conversations)


@query("SELECT * FROM supplier")
def silver_a_fail_open(t):
    return silver_a(t.supplier, ORDER_FIELDS, on_error="passthrough")


# --------------------------------------------------------------------------
# Stage B
# --------------------------------------------------------------------------


@query(
    """SELECT upper(trim(c_name)) AS c_name, CAST(floor(c_acctbal) AS INTEGER) AS c_acctbal,
       CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'HOME' ELSE c_mktsegment END
         AS c_mktsegment,
       coalesce(nullif(c_nationkey, 0), -1) AS c_nationkey, c_custkey
FROM customer"""
)
def silver_b_customer(t):
    """Includes a rule that does not parse, one that does not resolve, and one without a column."""
    rules = transform_rule_list(
        [
            ("c_name", "UPPER(TRIM(c_name))", 1),
            ("c_acctbal", "CAST(FLOOR(c_acctbal) AS INTEGER)", 1),
            (
                "c_mktsegment",
                "CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'HOME' "
                "ELSE c_mktsegment END",
                2,
            ),
            ("c_nationkey", "COALESCE(NULLIF(c_nationkey, 0), -1)", 2),
            ("c_name", "UPPER(c_name", 3),
            ("c_acctbal", "c_acctbal + no_such_column", 3),
            ("c_not_there", "UPPER(c_not_there)", 1),
        ]
    )
    return silver_b(t.customer, rules)


@query(
    """SELECT p_partkey, upper(p_name) || '-' || replace(p_brand, 'Brand#', 'B') AS p_name,
       replace(p_brand, 'Brand#', 'B') AS p_brand, p_type || '/' || (p_size * 2) AS p_type,
       p_size * 2 AS p_size, p_retailprice
FROM part"""
)
def silver_b_chained_transforms(t):
    """Field by field: both p_name rules run, and see p_brand and p_size already rewritten."""
    rules = transform_rule_list(
        [
            ("p_name", "UPPER(p_name)", 1),
            ("p_name", "CONCAT(p_name, '-', p_brand)", 2),
            ("p_brand", "REPLACE(p_brand, 'Brand#', 'B')", 1),
            ("p_size", "p_size * 2", 2),
            ("p_type", "CONCAT(p_type, '/', p_size)", 3),
        ]
    )
    return silver_b(t.part, rules)


@query(f"WITH {ORDER_GAPS_SQL} SELECT * FROM gaps WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL")
def required_filter_after_transform(t):
    return silver_b(t.orders, ORDER_GAPS, ORDER_FIELDS)


@query(
    """SELECT doc_id, trim(lower(text)) AS text, nullif(lang, 'en') AS lang,
       upper(source) AS source, n_chars FROM documents WHERE nullif(lang, 'en') IS NOT NULL"""
)
def silver_b_documents(t):
    rules = transform_rule_list(
        [
            ("text", "TRIM(LOWER(text))", 1),
            ("lang", "NULLIF(lang, 'en')", 1),
            ("source", "UPPER(source)", 1),
        ]
    )
    return silver_b(t.documents, rules, schema_rule_list([("lang", "STRING", True)]))


@query("SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def silver_b_rejected_rules(t):
    """Rules that would make, drop or mix rows are rejected; the scalar one runs."""
    rules = transform_rule_list(
        [
            ("c_acctbal", "EXPLODE(ARRAY(c_acctbal, c_acctbal))", 1),
            ("c_custkey", "MAX(c_custkey)", 1),
            ("c_mktsegment", "EXPLODE(FILTER(ARRAY(c_mktsegment), x -> false))", 1),
            ("c_nationkey", "ROW_NUMBER() OVER (ORDER BY c_nationkey)", 1),
            ("c_nationkey", "(SELECT MAX(id) FROM RANGE(9))", 2),
            ("c_name", "UPPER(c_name)", 2),
        ]
    )
    return silver_b(t.customer, rules)


# --------------------------------------------------------------------------
# Stage C and its parts
# --------------------------------------------------------------------------


def survivors_sql(table: str, keys: list[str], rest: list[str], columns: str = "*") -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in rest)
    return (
        f"SELECT {columns} FROM {table} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"
    )


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(survivors_sql("lineitem", LINE_KEYS, LINE_REST))
def dedup_lineitem(t):
    return deduplicate(t.lineitem, LINE_KEYS)


@query(
    survivors_sql("events", ["user_id", "event_type"], ["event_id", "ts", "value", "props"])
)
def dedup_events(t):
    return deduplicate(t.events, ["user_id", "event_type"])


@query(
    """SELECT * FROM events QUALIFY row_number() OVER
(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
)
def dedup_keep_latest(t):
    return deduplicate(t.events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query(survivors_sql("documents", ["text"], ["doc_id", "n_chars", "lang", "source"]))
def dedup_documents(t):
    return deduplicate(t.documents, ["text"])


@query(
    """WITH gaps AS (SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type,
                     value, props FROM events)
SELECT * FROM gaps QUALIFY row_number() OVER
(PARTITION BY event_type ORDER BY event_id NULLS FIRST) = 1"""
)
def dedup_hot_null_key(t):
    """Five keys for the whole table, NULL being one of them."""
    rules = transform_rule_list([("event_type", "NULLIF(event_type, 'error')", 1)])
    return deduplicate(transform_by_rules(t.events, rules), ["event_type"])


@query(
    survivors_sql(
        "orders",
        ["o_custkey"],
        ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    )
)
def dedup_partial_keys(t):
    return deduplicate(t.orders, ["o_custkey", "o_not_there"])


@query(
    """WITH months AS (SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 1
    WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 2 ELSE 3 END AS part FROM orders)
SELECT * FROM months QUALIFY row_number() OVER
(PARTITION BY o_custkey, o_orderpriority ORDER BY part, o_orderdate, o_orderkey) = 1"""
)
def dedup_month_by_month(t):
    """Three periods, each without the keys that those before have kept."""
    when = F.col("o_orderdate")
    early, middle = F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1997-01-01").cast("timestamp_ntz")
    number = F.when(when < early, 1).when(when < middle, 2).otherwise(3)
    orders = t.orders.withColumn("part", number)
    keys, order = ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    kept = None
    for part in (1, 2, 3):
        fresh = deduplicate_month(orders.where(F.col("part") == part), kept, keys, order)
        kept = fresh if kept is None else kept.unionAll(fresh)
    return kept


@query("SELECT DISTINCT * FROM orders")
def dedup_whole_rows(t):
    """Every order twice; the key is the whole row."""
    return deduplicate(t.orders.unionAll(t.orders), t.orders.columns)


@query(f"WITH {ORDER_GAPS_SQL} SELECT *, {ORDER_SCORE_SQL} AS quality_score FROM gaps")
def quality_score_orders(t):
    return add_quality_score(orders_with_gaps(t))


@query(
    f"""WITH {ORDER_GAPS_SQL}, scored AS (SELECT *, {ORDER_SCORE_SQL} AS quality_score FROM gaps)
SELECT * FROM scored WHERE quality_score >= 0.7"""
)
def quality_filter_orders(t):
    return drop_low_quality(add_quality_score(orders_with_gaps(t)))


LINE_RULES = schema_rule_list(
    [
        ("l_orderkey", "BIGINT", True),
        ("l_linenumber", "INTEGER", True),
        ("l_partkey", "BIGINT", False),
        ("l_quantity", "INTEGER", True),
        ("l_extendedprice", "DOUBLE", False),
        ("l_discount", "DOUBLE", False),
        ("l_returnflag", "STRING", False),
        ("l_shipdate", "DATE", True),
    ]
)
LINE_TRANSFORMS = transform_rule_list(
    [
        ("l_quantity", "CAST(NULLIF(l_quantity, 50) AS INTEGER)", 1),
        ("l_discount", "NULLIF(l_discount, 0)", 1),
        ("l_returnflag", "LOWER(NULLIF(l_returnflag, 'N'))", 1),
        ("l_shipdate", "CAST(l_shipdate AS DATE)", 1),
        ("l_extendedprice", "l_extendedprice * (1 - COALESCE(l_discount, 0))", 2),
    ]
)


@query(
    f"""WITH a AS (
  SELECT l_discount, l_extendedprice, l_linenumber, l_orderkey, l_partkey, l_quantity,
         l_returnflag, l_shipdate FROM lineitem
  WHERE l_linenumber IS NOT NULL AND l_orderkey IS NOT NULL AND l_quantity IS NOT NULL
    AND l_shipdate IS NOT NULL),
b1 AS (
  SELECT nullif(l_discount, 0) AS l_discount, l_extendedprice, l_linenumber, l_orderkey,
         l_partkey, CAST(nullif(l_quantity, 50) AS INTEGER) AS l_quantity,
         lower(nullif(l_returnflag, 'N')) AS l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
  FROM a),
b AS (
  SELECT * REPLACE (l_extendedprice * (1 - coalesce(l_discount, 0)) AS l_extendedprice) FROM b1
  WHERE l_quantity IS NOT NULL),
c AS (
  SELECT * FROM b QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_discount NULLS FIRST, l_extendedprice NULLS FIRST, l_partkey NULLS FIRST,
             l_quantity NULLS FIRST, l_shipdate NULLS FIRST, l_returnflag NULLS FIRST) = 1)
SELECT *,
  CAST(({non_null_terms('l_discount', 'l_extendedprice', 'l_linenumber', 'l_orderkey',
                        'l_partkey', 'l_quantity', 'l_returnflag', 'l_shipdate')})
       / 8.0::DOUBLE AS DECIMAL(3,2)) AS quality_score,
  {NOW_SQL} AS processed_timestamp, 'silver_c' AS pipeline_stage
FROM c"""
)
def silver_c_lineitem(t):
    """The flagship: all three stages as one plan with one shuffle."""
    return silver(t.lineitem, LINE_KEYS, LINE_RULES, LINE_TRANSFORMS, now=fixed_now())


@query(f"WITH {ORDER_GAPS_SQL} SELECT * FROM gaps WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL")
def silver_c_pass_through(t):
    b = silver_b(t.orders, ORDER_GAPS, ORDER_FIELDS)
    return silver_c(b, ["o_orderkey"], ORDER_FIELDS, finalize=False)


@query(
    f"""WITH {ORDER_GAPS_SQL},
c AS ({survivors_sql('gaps', ['o_custkey', 'o_orderstatus'], ['o_orderkey'])}),
scored AS (SELECT *, {ORDER_SCORE_SQL} AS quality_score FROM c)
SELECT *, {NOW_SQL} AS processed_timestamp, 'silver_c' AS pipeline_stage FROM scored
WHERE quality_score >= 0.7 AND o_orderkey IS NOT NULL"""
)
def silver_c_min_score(t):
    return silver_c(
        orders_with_gaps(t),
        ["o_custkey", "o_orderstatus"],
        schema_rule_list([("o_orderkey", "BIGINT", True)]),
        min_score=0.7,
        now=fixed_now(),
    )


@query(
    f"""WITH c AS ({survivors_sql('embeddings', ['label'], ['vec_id'])})
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dimensions,
       CAST(list_sum(list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1048576) AS BIGINT)))
            AS BIGINT) AS component_sum,
       CAST(1 AS DECIMAL(3,2)) AS quality_score,
       {NOW_SQL} AS processed_timestamp, 'silver_c' AS pipeline_stage
FROM c"""
)
def silver_c_embeddings(t):
    """Arrays pass through every stage untouched."""
    return silver(t.embeddings, ["label"], now=fixed_now()).select(
        "vec_id",
        "label",
        F.size("embedding").alias("dimensions"),
        F.aggregate(
            F.transform("embedding", lambda x: F.floor(x.cast("double") * 1048576)),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        ).alias("component_sum"),
        "quality_score",
        "processed_timestamp",
        "pipeline_stage",
    )


@query(
    f"""WITH a AS (
  SELECT conv_id, nullif(role, 'system') AS role, trim(text) AS text, turn FROM conversations),
c AS ({survivors_sql('a', ['conv_id', 'role'], ['turn', 'text'])})
SELECT *, CAST(({non_null_terms('conv_id', 'role', 'text', 'turn')}) / 4.0::DOUBLE
               AS DECIMAL(3,2)) AS quality_score,
       {NOW_SQL} AS processed_timestamp, 'silver_c' AS pipeline_stage FROM c"""
)
def silver_c_conversations(t):
    fields = schema_rule_list(
        [("conv_id", "INTEGER", True), ("turn", "INTEGER", True), ("role", "STRING", False),
         ("text", "STRING", True)]
    )
    rules = transform_rule_list(
        [("role", "NULLIF(role, 'system')", 1), ("text", "TRIM(text)", 1)]
    )
    return silver(t.conversations, ["conv_id", "role"], fields, rules, now=fixed_now())


@query(
    f"""WITH a AS (SELECT html, page_id, lower(trim(url)) AS url FROM pages),
c AS ({survivors_sql('a', ['url'], ['page_id', 'html'])})
SELECT *, CAST(1 AS DECIMAL(3,2)) AS quality_score,
       {NOW_SQL} AS processed_timestamp, 'silver_c' AS pipeline_stage FROM c"""
)
def silver_c_pages(t):
    fields = schema_rule_list(
        [("page_id", "INTEGER", True), ("url", "STRING", True), ("html", "STRING", True)]
    )
    rules = transform_rule_list([("url", "LOWER(TRIM(url))", 1)])
    return silver(t.pages, ["url"], fields, rules, now=fixed_now())
