"""Change application, selection, checks and profiles of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.casts import typed_projection
from ..operators import changes, profile, quality, selection
from ..operators.selection import ColumnSelection, TableSelector
from . import fixtures as fx
from .fixtures import load
from .registry import LATEST_EVENTS, query


@query(LATEST_EVENTS)
def apply_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current row per user from the change log."""
    return changes.apply_latest(fx.change_log(spark, sf_dir), ["user_id"], ["ts", "event_id"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
        FROM lineitem
    ) WHERE rn = 1
""")
def apply_latest_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest version of each order line, keyed by two columns."""
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *order).withColumn("op", F.lit("u"))
    return changes.apply_latest(lines, ["l_orderkey", "l_linenumber"], order)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_type <> 'error'")
def force_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert feed as an append-only one."""
    return changes.to_append_only(fx.change_log(spark, sf_dir))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def project_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Included columns only; balances and segments are never read."""
    return selection.project_columns(load(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_nationkey"])


@query("SELECT c_custkey, c_mktsegment FROM customer")
def project_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Included columns minus excluded ones."""
    include = ["c_custkey", "c_acctbal", "c_mktsegment"]
    return selection.project_columns(load(spark, sf_dir, "customer"), include, ["c_acctbal", "c_name"])


@query("SELECT * FROM supplier")
def project_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.project_columns(load(spark, sf_dir, "supplier"))


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CASE WHEN o_custkey <= 32767 THEN CAST(o_custkey AS SMALLINT) END AS o_custkey,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN length(o_orderpriority) <= 6 THEN o_orderpriority END AS o_orderpriority,
           nullif(concat_ws(',', CASE WHEN o_custkey > 32767 THEN 'o_custkey' END,
                                 CASE WHEN length(o_orderpriority) > 6 THEN 'o_orderpriority' END), '') AS failed
    FROM orders
""")
def project_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type overrides; values that do not fit are named."""
    types = {"o_orderkey": "INT", "o_custkey": "SMALLINT", "o_orderdate": "DATE", "o_orderpriority": "VARCHAR(6)"}
    cast = typed_projection(load(spark, sf_dir, "orders"), types)
    failed = F.regexp_replace("reject_reason", "^cast failed: ", "")
    return cast.withColumn("failed", failed).drop("reject_reason", "reject_row")


@query("""
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
           CASE WHEN o_totalprice < 99999.995 THEN o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority,
           o_totalprice >= 99999.995 AS rejected
    FROM orders
""")
def typemap_postgres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns under their PostgreSQL types; prices too long for the declared precision are rejected."""
    types = {
        "o_orderkey": "bigint",
        "o_custkey": "int4",
        "o_orderstatus": "character varying(1)",
        "o_totalprice": "numeric(7,2)",
        "o_orderdate": "timestamp(6) without time zone",
        "o_orderpriority": "text",
    }
    rows = typed_projection(fx.as_text(load(spark, sf_dir, "orders")), types, "postgres")
    return rows.select(
        *[F.col(c).cast("double").alias(c) if c == "o_totalprice" else F.col(c) for c in types],
        F.col("reject_reason").isNotNull().alias("rejected"),
    )


@query("""
    SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey,
           CAST(l_suppkey AS INTEGER) AS l_suppkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
           l_quantity, l_extendedprice, CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS l_discount, l_tax,
           l_returnflag, l_linestatus, l_shipdate, false AS rejected
    FROM lineitem
""")
def typemap_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns under their MySQL types."""
    types = {
        "l_orderkey": "BIGINT UNSIGNED",
        "l_partkey": "INT UNSIGNED",
        "l_suppkey": "MEDIUMINT",
        "l_linenumber": "TINYINT",
        "l_quantity": "DECIMAL",
        "l_extendedprice": "DOUBLE",
        "l_discount": "FLOAT",
        "l_tax": "DOUBLE",
        "l_returnflag": "ENUM",
        "l_linestatus": "CHAR",
        "l_shipdate": "DATETIME",
    }
    rows = typed_projection(fx.as_text(load(spark, sf_dir, "lineitem")), types, "mysql")
    double = ("l_orderkey", "l_quantity", "l_discount")
    return rows.select(
        *[F.col(c).cast("double").alias(c) if c in double else F.col(c) for c in types],
        F.col("reject_reason").isNotNull().alias("rejected"),
    )


@query("""
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS SMALLINT) AS c_nationkey, c_acctbal,
           c_mktsegment, false AS rejected
    FROM customer
""")
def typemap_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns under their SQL Server types."""
    types = {
        "c_custkey": "int",
        "c_name": "nvarchar",
        "c_nationkey": "tinyint",
        "c_acctbal": "money",
        "c_mktsegment": "sql_variant",
    }
    rows = typed_projection(fx.as_text(load(spark, sf_dir, "customer")), types, "sqlserver")
    return rows.withColumn("c_acctbal", F.col("c_acctbal").cast("double")).select(
        *types, F.col("reject_reason").isNotNull().alias("rejected")
    )


_DIRTY = """
    SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 10 = 3 THEN c_custkey - 1 ELSE c_custkey END AS c_custkey,
           CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name,
           CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM customer
"""


@query(f"""
    WITH d AS ({_DIRTY}), t AS (
        SELECT count(*) AS n, count(*) - count(c_custkey) AS no_key, count(*) - count(c_name) AS no_name,
               count(*) - count(c_mktsegment) AS no_segment FROM d
    )
    SELECT 'unknown column' AS rule, 'c_phone' AS "column", 'error' AS severity, n AS violating_rows FROM t
    UNION ALL SELECT 'not an upstream key', 'c_name', 'error', n FROM t
    UNION ALL SELECT 'nullability override', 'c_mktsegment', 'warning', no_segment FROM t
    UNION ALL SELECT 'upstream key not marked', 'c_custkey', 'warning', n FROM t
    UNION ALL SELECT 'null in NOT NULL column', 'c_mktsegment', 'error', no_segment FROM t
    UNION ALL SELECT 'null in NOT NULL column', 'c_name', 'error', no_name FROM t
    UNION ALL SELECT 'duplicate key', 'c_name', 'error', CAST(sum(n) AS BIGINT) FROM (
        SELECT c_name, count(*) AS n FROM d WHERE c_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0
""")
def selection_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column selection with one mistake of each kind, checked against the rows."""
    picked = [
        ColumnSelection("c_custkey"),
        ColumnSelection("c_name", primary_key=True),
        ColumnSelection("c_mktsegment", nullable=False),
        ColumnSelection("c_phone"),
    ]
    return quality.selection_findings(fx.dirty_customers(spark, sf_dir), picked, upstream_pk=["c_custkey"])


@query(f"""
    WITH d AS ({_DIRTY})
    SELECT 'c_custkey' AS "column", count(*) - count(c_custkey) AS violations FROM d
    UNION ALL SELECT 'c_name', count(*) - count(c_name) FROM d
    UNION ALL SELECT 'c_mktsegment', count(*) - count(c_mktsegment) FROM d
""")
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null_violations(fx.dirty_customers(spark, sf_dir), ["c_custkey", "c_name", "c_mktsegment"])


@query(f"""
    SELECT c_custkey, count(*) AS "rows", CASE WHEN c_custkey IS NULL THEN 'null key' ELSE 'duplicate' END AS reason
    FROM ({_DIRTY}) GROUP BY 1 HAVING count(*) > 1 OR c_custkey IS NULL
""")
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.pk_violations(fx.dirty_customers(spark, sf_dir), ["c_custkey"])


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS "rows", 'duplicate' AS reason FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
""")
def pk_violations_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines are not unique by order and line number."""
    return quality.pk_violations(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_FEED = """
    SELECT 'sales' AS "schema", 'orders' AS "table", o_orderkey AS k FROM orders
    UNION ALL SELECT 'sales', 'customer', c_custkey FROM customer
    UNION ALL SELECT 'stock', 'part', p_partkey FROM part
    UNION ALL SELECT 'stock', 'supplier', s_suppkey FROM supplier
    UNION ALL SELECT 'web', 'events', event_id FROM events
"""
_FEED_SUMMARY = f"""
    SELECT "schema", "table", count(*) AS "rows", CAST(sum(k) AS BIGINT) AS key_sum FROM ({_FEED}) WHERE {{}}
    GROUP BY 1, 2
"""


def _feed_summary(feed: DataFrame) -> DataFrame:
    return feed.groupBy("schema", "table").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("order_key").alias("key_sum")
    )


@query(_FEED_SUMMARY.format(""""table" IN ('orders', 'part', 'events')"""))
def select_tables_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that include globs take and exclude globs leave."""
    picked = TableSelector(include=("SALES.*", "p?rt", "*event[s]", "stock.supp*"), exclude=("*customer", "s[!a]*.supplier"))
    return _feed_summary(picked.select(fx.multi_feed(spark, sf_dir)))


@query(_FEED_SUMMARY.format(""""table" <> 'events'"""))
def select_tables_all_but(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything except excluded globs."""
    return _feed_summary(TableSelector(include_all=True, exclude=("web.*",)).select(fx.multi_feed(spark, sf_dir)))


@query(f"""
    WITH c AS (SELECT "schema", "table", count(*) AS n FROM ({_FEED}) GROUP BY 1, 2)
    SELECT 0 AS position, 'events' AS requested, 'web' AS "schema", 'events' AS "table", n AS "rows", true AS found
        FROM c WHERE "table" = 'events'
    UNION ALL SELECT 1, 'sales.orders', 'sales', 'orders', n, true FROM c WHERE "table" = 'orders'
    UNION ALL SELECT 2, 'hr.staff.old', 'hr', 'staff.old', 0, false
    UNION ALL SELECT 3, 'audit', 'public', 'audit', 0, false
    UNION ALL SELECT 4, 'events', 'web', 'events', n, true FROM c WHERE "table" = 'events'
""")
def select_tables_specific(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named tables in the order asked for, repeats kept, placeholders for those that are missing."""
    names = ["events", "sales.orders", "hr.staff.old", "audit", "events"]
    return selection.resolve_specific(fx.multi_feed(spark, sf_dir), names)


@query(_FEED_SUMMARY.format(""""table" IN ('events', 'orders')"""))
def select_rows_specific(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of named tables; excludes do not apply to them."""
    picked = TableSelector(specific=("events", "sales.orders", "hr.staff"), exclude=("*",))
    return _feed_summary(picked.select(fx.multi_feed(spark, sf_dir)))


@query("""
    SELECT r AS requested FROM (VALUES ('sales.orders'), ('stock.orders'), ('audit'), ('part')) AS v(r)
    WHERE r NOT IN ('sales.orders', 'part') AND (SELECT count(*) FROM orders) > 0
""")
def missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["sales.orders", "stock.orders", "audit", "part"]
    return selection.missing_tables(fx.multi_feed(spark, sf_dir), names)


@query(_FEED_SUMMARY.format(""""schema" = 'sales' OR "table" IN ('part', 'events')"""))
def select_patterns_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comma-separated pattern string: a whole schema, one table, a bare name in the default schema."""
    wanted = selection.pattern_condition("sales.*, stock.part,events", default_schema="web")
    return _feed_summary(fx.multi_feed(spark, sf_dir).filter(wanted))


_TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders",
    "pages", "part", "region", "supplier",
)


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS \"rows\" FROM {t}" for t in _TABLES))
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table; file bytes are part of the profile but not of this comparison."""
    return profile.table_profile({t: load(spark, sf_dir, t) for t in _TABLES}).drop("bytes")


_CUSTOMER_COLUMNS = (("c_custkey", "bigint"), ("c_name", "string"), ("c_acctbal", "string"), ("c_mktsegment", "string"))


@query(
    f"WITH d AS ({_DIRTY}), e AS (SELECT *, '' AS c_acctbal FROM d) "
    + " UNION ALL ".join(
        f"SELECT 'customer' AS \"table\", '{c}' AS \"column\", {i} AS ordinal, '{t}' AS data_type, "
        f"{'true' if i == 1 else 'false'} AS is_pk, count(*) AS \"rows\", count(*) - count({c}) AS nulls FROM e"
        for i, (c, t) in enumerate(_CUSTOMER_COLUMNS, 1)
    )
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per column with its type, key flag and nulls."""
    return profile.column_profile("customer", fx.dirty_customers(spark, sf_dir), pk=["c_custkey"])


@query("""
    SELECT 'lineitem' AS "table", 'l_orderkey,l_linenumber' AS "columns", count(*) AS "rows",
           count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, 0::BIGINT AS null_rows,
           count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS is_key FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber,l_partkey,l_suppkey', count(*),
           count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)), 0,
           count(*) = count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_returnflag', count(*), count(DISTINCT l_returnflag), 0,
           count(*) = count(DISTINCT l_returnflag) FROM lineitem
""")
def candidate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which column lists identify an order line."""
    lists = [
        ["l_orderkey", "l_linenumber"],
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        ["l_returnflag"],
    ]
    return profile.candidate_keys("lineitem", load(spark, sf_dir, "lineitem"), lists)


@query("""
    SELECT event_type AS collection, count(*) AS documents, CAST(sum(strlen(props)) AS BIGINT) AS bytes
    FROM events WHERE event_type <> 'error' GROUP BY 1
""")
def collection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and bytes per collection; errors stand for a system collection."""
    name = F.when(F.col("event_type") == "error", F.lit("system.errors")).otherwise(F.col("event_type"))
    feed = load(spark, sf_dir, "events").select(name.alias("collection"), F.col("props").alias("payload"))
    return profile.collection_stats(feed)
