"""Reports over ingested tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.changes import apply_latest
from ..sinks.fanout import sink_input
from ..sources import PostgresSource, accepted, decode_changes, decode_json, metadata_columns, with_metadata
from . import fixtures as fx
from .fixtures import EVENT_COLUMNS, load
from .registry import LATEST_EVENTS, query


@query("SELECT count(*) AS n FROM events")
def count_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, ts AS kafka_timestamp, event_type
    FROM events ORDER BY ts DESC, event_id DESC LIMIT 100
""")
def recent_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred latest messages with their metadata."""
    feed = fx.kafka_log(spark, sf_dir).orderBy(F.desc("timestamp"), F.desc("offset")).limit(100)
    meta = metadata_columns(partition=True, offset=True, timestamp=True)
    rows = accepted(decode_json(feed, EVENT_COLUMNS, meta))
    return rows.select(
        "kafka_partition",
        "kafka_offset",
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
        "event_type",
    )


def _money(expr: str) -> str:
    return f"sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(14,2))) {expr}"


@query(f"""
    SELECT l_partkey, CAST({_money('')} AS DOUBLE) AS revenue FROM lineitem
    GROUP BY 1 ORDER BY revenue DESC, l_partkey LIMIT 10
""")
def top10_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten products with the most revenue."""
    lines = load(spark, sf_dir, "lineitem")
    revenue = lines.groupBy("l_partkey").agg(F.expr(_money("")).cast("double").alias("revenue"))
    return revenue.orderBy(F.desc("revenue"), "l_partkey").limit(10)


@query(LATEST_EVENTS + " ORDER BY ts DESC, event_id DESC")
def latest_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole current state, last change first."""
    state = apply_latest(fx.change_log(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return state.orderBy(F.desc("ts"), F.desc("event_id"))


@query("""
    SELECT user_id, event_type, value, ts, event_id FROM events
    WHERE user_id = (SELECT min(user_id) FROM events) ORDER BY ts, event_id
""")
def key_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes of one key in order; only the log has them, the table keeps the last."""
    fx.change_log(spark, sf_dir).createOrReplaceTempView("tidegate_changes")
    return spark.sql("""
        SELECT user_id, event_type, value, ts, event_id FROM tidegate_changes
        WHERE user_id = (SELECT min(user_id) FROM tidegate_changes) ORDER BY ts, event_id
    """)


@query("""
    SELECT user_id || '_' || CAST(date_trunc('hour', ts) AS VARCHAR) AS summary_id, user_id,
           CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_bucket, count(*) AS event_count,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_value, max(value) AS max_value
    FROM events GROUP BY ALL
""")
def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user and hour."""
    events = load(spark, sf_dir, "events")
    return rollup(events)


def rollup(events: DataFrame, as_of: str | None = None, hours: int = 24) -> DataFrame:
    """Per user and hour; with ``as_of`` only the hours up to that time."""
    if as_of:
        now = F.lit(as_of).cast("timestamp_ntz")
        events = events.filter(F.col("ts") >= now - F.expr(f"INTERVAL {hours} HOURS"))
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    count = F.count(F.lit(1))
    return (
        events.groupBy("user_id", hour.alias("hour_bucket"))
        .agg(
            count.alias("event_count"),
            (F.sum(F.col("value").cast("decimal(12,2)")).cast("double") / count).alias("avg_value"),
            F.max("value").alias("max_value"),
        )
        .select(
            F.concat(F.col("user_id").cast("string"), F.lit("_"), F.col("hour_bucket").cast("string")).alias("summary_id"),
            "*",
        )
    )


@query("""
    SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_bucket, count(*) AS event_count, max(value) AS max_value
    FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR GROUP BY ALL
""")
def hourly_rollup_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the last 24 hours before a given time; the time filter reaches the scan."""
    rolled = rollup(load(spark, sf_dir, "events"), as_of="2024-01-30 00:00:00")
    return rolled.select("user_id", "hour_bucket", "event_count", "max_value")


@query("""
    SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, count(*) AS new_orders FROM orders
    WHERE o_orderstatus = 'O' GROUP BY 1 ORDER BY 1
""")
def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders per month."""
    orders = load(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")
    return orders.groupBy(month).agg(F.count(F.lit(1)).alias("new_orders")).orderBy("month")


@query(f"""
    SELECT count(*) AS lines, CAST({_money('')} AS DOUBLE) AS total_value FROM lineitem
    WHERE l_shipdate > (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 1 HOUR
""")
def last_hour_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and value of the lines shipped in the hour before the latest one."""
    load(spark, sf_dir, "lineitem").createOrReplaceTempView("tidegate_lineitem")
    return spark.sql(f"""
        SELECT count(*) AS lines, CAST({_money('')} AS DOUBLE) AS total_value FROM tidegate_lineitem
        WHERE l_shipdate > (SELECT max(l_shipdate) FROM tidegate_lineitem) - INTERVAL 1 HOUR
    """)


@query("""
    SELECT event_id, user_id, event_type, ts AS commit_ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 100
""")
def recent_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred latest changes by commit time."""
    events = accepted(decode_changes(fx.debezium_log(spark, sf_dir), PostgresSource("app"), EVENT_COLUMNS))
    rows = with_metadata(events, "timestamp").orderBy(F.desc("commit_ts"), F.desc("event_id")).limit(100)
    commit = F.col("commit_ts").cast("timestamp_ntz").alias("commit_ts")
    return rows.select("event_id", "user_id", "event_type", commit)


_COUNTED = ("customer", "events", "lineitem", "orders", "part", "supplier")


@query(
    "SELECT table_name, CAST(sum(n) AS BIGINT) AS records FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _COUNTED)
    + ") GROUP BY 1"
)
def union_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of several tables in one frame."""
    counts = [
        load(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        for t in _COUNTED
    ]
    return reduce(DataFrame.unionByName, counts).groupBy("table_name").agg(F.sum("n").alias("records"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.title') AS title FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a JSON document as text; one that is absent is null."""
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.get_json_object("props", "$.title").alias("title"),
    )


_DEFINITION = """
    SELECT c_mktsegment, count(*) AS orders, count(DISTINCT o_custkey) AS buyers
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment
"""


@query(_DEFINITION.format(orders="orders", customer="customer"))
def mv_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own SELECT as the definition of a view."""
    for table in ("orders", "customer"):
        load(spark, sf_dir, table).createOrReplaceTempView(f"tidegate_{table}")
    return sink_input(spark, query=_DEFINITION.format(orders="tidegate_orders", customer="tidegate_customer"))
