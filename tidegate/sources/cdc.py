"""Captured database tables: recorded or live envelopes -> current rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.changes import apply_events, apply_latest
from .config import DatabaseSource, MongoSource, MySqlSource
from .decode import accepted, decode_debezium, documents

# Names of the change metadata columns.
CHANGE_METADATA = {
    "timestamp": ("commit_ts", "commit_ts"),
    "database": ("database_name", "db"),
    "schema": ("schema_name", "schema"),
    "table": ("table_name", "table"),
    "collection": ("collection_name", "table"),
}

DOCUMENT_COLUMNS = {"_id": "VARCHAR", "payload": "VARCHAR"}


def decode_changes(
    feed: DataFrame, source: DatabaseSource, columns: Mapping[str, str], metadata: Sequence[Column] = ()
) -> DataFrame:
    """Change events of one table, rejects included, with ``metadata`` columns of their messages."""
    zone = source.server_time_zone if isinstance(source, MySqlSource) else "UTC"
    return decode_debezium(feed, columns, source.order_ddl, zone, metadata, {**dict.fromkeys(columns, source.time_unit), **source.time_units})


def current_rows(feed: DataFrame, source: DatabaseSource, columns: Mapping[str, str], pk: list[str]) -> DataFrame:
    """The table as of the last change in the feed."""
    return apply_events(accepted(decode_changes(feed, source, columns)), pk)


def current_documents(feed: DataFrame, source: MongoSource) -> DataFrame:
    """The collection as of the last change: ``_id, payload``."""
    rows = documents(accepted(decode_changes(feed, source, DOCUMENT_COLUMNS)))
    return apply_latest(rows, ["_id"], ["_order"], op="_op").drop("_order")


def with_metadata(events: DataFrame, *include: str) -> DataFrame:
    """After images (before images of deletes) with the chosen metadata columns, one row per change."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    kept = [F.col(CHANGE_METADATA[i][1]).alias(CHANGE_METADATA[i][0]) for i in include]
    return events.select("op", image.alias("_image"), *kept).select(
        "op", "_image.*", *[CHANGE_METADATA[i][0] for i in include]
    )
