"""A message topic as a table or a view, by its format and encoding."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from .operators.changes import apply_latest, flatten_events, split_key_changes
from .sinks.lake import MAIN, LakeTable, append_partition, read_partitions, writer_of
from .sources.config import CDC_FORMATS, KafkaSource
from .sources.decode import (
    ERROR,
    RAW,
    accepted,
    decode_bytes,
    decode_canal,
    decode_csv,
    decode_debezium,
    decode_json,
    decode_maxwell,
    decode_upsert,
)
from .sources.feed import UPSERT_KEY, header_value, metadata_columns
from .streaming.pipeline import append_and_reject, run_stream


@dataclass(frozen=True)
class Topic:
    """Columns of a topic's messages with their target types, and the metadata kept next to them.

    PLAIN messages are appended. UPSERT and change formats keep the latest row per ``primary_key``; an UPSERT topic
    without one is keyed by the message key, as ``rw_key``.
    """

    source: KafkaSource
    columns: Mapping[str, str] = field(default_factory=dict)
    primary_key: tuple[str, ...] = ()
    key_columns: Mapping[str, str] | None = None
    metadata: Mapping[str, object] = field(default_factory=dict)
    order_ddl: str = "lsn bigint, txId bigint"
    name: str | None = None

    def __post_init__(self) -> None:
        if self.source.encode in ("AVRO", "PROTOBUF"):
            raise ValueError(f"decode {self.source.encode} messages with Spark's own functions and pass the rows on")
        if self.source.encode == "PARQUET":
            raise ValueError("a feed of Parquet files is read with spark.readStream.parquet")
        if self.source.encode != "BYTES" and not self.columns:
            raise ValueError("the columns of the messages are required")
        if self.source.format in CDC_FORMATS and not self.primary_key:
            raise ValueError("a primary key is required to apply changes")
        if self.source.format == "UPSERT" and set(self.primary_key) - set(self.key_columns or {}):
            raise ValueError("key_columns must hold the primary key: a delete has nothing but its message key")

    @property
    def table_name(self) -> str:
        return self.name or self.source.table_name

    @property
    def keyed(self) -> bool:
        return self.source.format != "PLAIN"

    @property
    def keys(self) -> list[str]:
        return list(self.primary_key) or [UPSERT_KEY]

    def _metadata(self) -> list[Column]:
        wanted = dict(self.metadata)
        if self.source.format == "UPSERT":
            wanted.pop("key", None)  # always there, as rw_key
        return metadata_columns(message_format=self.source.format, encode=self.source.encode, **wanted)

    def decode(self, feed: DataFrame) -> DataFrame:
        """Decoded messages, rejects included; change formats give change events.

        A header that doesn't fit its declared type rejects the message like a field that doesn't.
        """
        typed = {h: t for h, t in (self.metadata.get("header_fields") or {}).items()}
        bad = [F.when(header_value(h).isNotNull() & header_value(h, t).isNull(), F.lit(h)) for h, t in typed.items()]
        if not bad:
            return self._decode(feed, self._metadata())
        failed = F.array_join(F.array_compact(F.array(*bad)), ",")
        checks = [F.when(failed != "", F.concat(F.lit("cast failed: "), failed)).alias("header_error"), F.col("value").cast("string").alias("header_raw")]
        decoded = self._decode(feed, [*self._metadata(), *checks])
        wrong = F.col(ERROR).isNull() & F.col("header_error").isNotNull()
        marked = decoded.withColumns(
            {RAW: F.when(wrong, F.col("header_raw")).otherwise(F.col(RAW)), ERROR: F.coalesce(ERROR, "header_error")}
        )
        return marked.drop("header_error", "header_raw")

    def _decode(self, feed: DataFrame, metadata: list[Column]) -> DataFrame:
        source = self.source
        units = {**dict.fromkeys(self.columns, source.time_unit), **source.time_units}
        if source.format == "UPSERT":
            return decode_upsert(feed, self.columns, self.key_columns, metadata, units)
        if source.format == "DEBEZIUM":
            return decode_debezium(feed, self.columns, self.order_ddl, source.time_zone, metadata, units)
        if source.format == "MAXWELL":
            return decode_maxwell(feed, self.columns, metadata)
        if source.format == "CANAL":
            return decode_canal(feed, self.columns, metadata)
        if source.encode == "CSV":
            return decode_csv(feed, self.columns, source.csv_delimiter, source.csv_without_header, metadata)
        if source.encode == "BYTES":
            rows = decode_bytes(feed, next(iter(self.columns), "id"), metadata)
            return rows.withColumns({RAW: F.lit(None).cast("string"), ERROR: F.lit(None).cast("string")})
        return decode_json(feed, self.columns, metadata, units)

    def to_changes(self, good: DataFrame) -> DataFrame:
        """Accepted decoded messages as flat change rows ``_op, _order`` and the columns."""
        good = good.drop(RAW, ERROR)
        if self.source.format == "UPSERT":
            kept = good.columns if self.keys == [UPSERT_KEY] else [c for c in good.columns if c != UPSERT_KEY]
            return good.select(*[F.col(c).alias("_order") if c == "_offset" else F.col(c) for c in kept])
        return flatten_events(split_key_changes(good, self.keys))

    def rows(self, feed: DataFrame) -> DataFrame:
        """The topic not stored: its rows computed from the feed each time they are asked for."""
        good = accepted(self.decode(feed))
        if not self.keyed:
            return good
        return apply_latest(self.to_changes(good), self.keys, ["_order"], op="_op").drop("_order")

    def view(self, feed: DataFrame) -> str:
        self.rows(feed).createOrReplaceTempView(self.table_name)
        return self.table_name

    def stored(self, feed: DataFrame, path: str) -> DataFrame:
        """Rows of the stored topic below ``path``."""
        spark = feed.sparkSession
        if not self.keyed:
            return read_partitions(spark, f"{path}/{self.table_name}")
        return self._table(feed, path).read().drop("_order")

    def _table(self, feed: DataFrame, path: str) -> LakeTable:
        return LakeTable(feed.sparkSession, f"{path}/{self.table_name}", self.keys, ["_order"], op="_op")

    def store(self, batch: DataFrame, batch_id: int, path: str, writer: str = MAIN) -> None:
        """Store one batch of messages; the same batch again changes nothing."""
        decoded = self.decode(batch)
        rejects = f"{path}/_rejects/{self.table_name}"
        if self.keyed:
            table = self._table(batch, path)
            keep = lambda rows, batch_id: table.append_batch(rows, batch_id, writer)
            append_and_reject(decoded, keep, batch_id, self.to_changes, rejects, table.pk, table.order_by, writer)
            return

        def append(rows: DataFrame, batch_id: int) -> None:
            append_partition(rows, f"{path}/{self.table_name}", batch_id, writer)

        append_and_reject(decoded, append, batch_id, lambda good: good.drop(RAW, ERROR), rejects, writer=writer)

    def run(self, feed: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
        """Store a stream of messages; by default until the end of what is there."""
        writer = writer_of(checkpoint)
        return run_stream(feed, lambda batch, batch_id: self.store(batch, batch_id, path, writer), checkpoint, **trigger)
