"""A captured database from its change feed to its target tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .functions.typemap import struct_of
from .operators.changes import SNAPSHOT, flatten_events, snapshot_chunk, split_key_changes
from .operators.documents import assembled, path_changes
from .operators.selection import TableColumns, TableSelector
from .operators.skew import dealt
from .sinks import paths
from .sinks.lake import MAIN, LakeTable, append_partition, append_tables, writer_of
from .sources.cdc import CHANGE_METADATA, decode_changes
from .sources.config import DatabaseSource, MongoSource
from .sources.decode import accepted, decode_documents
from .streaming.pipeline import append_and_reject, complete_transactions, fold_transactions, open_transactions, run_stream


@dataclass(frozen=True)
class CapturedTable:
    """A table of the feed: its columns with target types, its key, and what is taken of it."""

    schema: str
    table: str
    columns: Mapping[str, str]
    primary_key: tuple[str, ...]
    take: TableColumns | None = None

    def __post_init__(self) -> None:
        if not self.primary_key:
            raise ValueError(f"{self.schema}.{self.table} needs a primary key to apply changes")
        left_out = set(self.primary_key) - set(self.taken)
        if left_out:
            raise ValueError(f"key columns of {self.schema}.{self.table} are not selected: {sorted(left_out)}")

    @property
    def taken(self) -> list[str]:
        if self.take is None or self.take.columns is None:
            return list(self.columns)
        return [c.name for c in self.take.columns]

    @property
    def target(self) -> str:
        return self.take.target if self.take else self.table

    @property
    def types(self) -> dict[str, str]:
        """Selected columns under their overridden types; columns left out are not even parsed."""
        override = {c.name: c.target_type for c in (self.take.columns if self.take else None) or () if c.target_type}
        return {c: override.get(c, self.columns[c]) for c in self.taken}


@dataclass
class Ingest:
    """Keeps one merge-on-read table per captured table below ``warehouse``.

    The feed holds the envelopes of many tables. Each batch is selected and read once; tables of equal columns and key are
    decoded together and written by one write, ``writers`` such groups at a time.

    The source's settings hold here: its table patterns, unless a ``selector`` is given; ``transactional`` lets changes through
    by whole transactions, which the feed's BEGIN and END messages delimit; with ``auto_schema_change`` columns that messages
    have beside the declared ones become text columns of tables of which all columns are taken. ``metadata`` are columns about
    each change to keep: timestamp, database, schema, table.
    """

    spark: SparkSession
    source: DatabaseSource
    tables: tuple[CapturedTable, ...]
    warehouse: str
    selector: TableSelector | None = None
    snapshot: bool | None = None
    writers: int = 4
    metadata: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.selector is None:
            patterns = [p if "." in p else f"{self.source.schema}.{p}" for p in self.source.patterns]
            everything = self.source.tables.strip() == "*"
            self.selector = TableSelector(include_all=True) if everything else TableSelector(include=tuple(patterns))
        unknown = set(self.metadata) - set(CHANGE_METADATA)
        if unknown:
            raise ValueError(f"unknown metadata: {sorted(unknown)}")

    def target(self, table: CapturedTable) -> LakeTable:
        """The stored table, read under the declared columns, so that added and widened columns need no merging."""
        stored = (
            T.StructType()
            .add("_op", "string")
            .add("_order", T.StructType.fromDDL(self.source.order_ddl))
        )
        about = [T.StructField(CHANGE_METADATA[m][0], T.TimestampType() if m == "timestamp" else T.StringType()) for m in self.metadata]
        stored = T.StructType([*stored.fields, *struct_of(table.types).fields, *about])
        path = f"{self.warehouse}/table={table.target}"
        if isinstance(self.source, MongoSource):
            return LakeTable(self.spark, path, ["_id", "path"], ["_order"], op="_op")
        # Columns that the messages bring are read as well.
        declared = None if self._grows(table) else stored
        return LakeTable(self.spark, path, table.primary_key, ["_order"], op="_op", schema=declared)

    def _grows(self, table: CapturedTable) -> bool:
        return self.source.auto_schema_change and (table.take is None or table.take.columns is None)

    def _grown(self, table: CapturedTable, messages: DataFrame) -> CapturedTable:
        """The table with the columns that its messages have beside the declared ones, as text."""
        text = F.col("value").cast("string")
        row = F.coalesce(*[F.get_json_object(text, f"$.{p}{i}") for p in ("", "payload.") for i in ("after", "before")])
        there = F.col("_more") if "_more" in messages.columns else F.json_object_keys(row)
        names = messages.select(F.explode(there).alias("c")).filter(~F.col("c").isin(*table.columns)).distinct()
        more = sorted(r["c"] for r in names.collect())  # names of columns
        return replace(table, columns={**table.columns, **dict.fromkeys(more, "VARCHAR")}) if more else table

    def read(self, table: CapturedTable) -> DataFrame:
        """Current rows; of a document collection ``_id, payload``, put together from the changed paths."""
        rows = self.target(table).read()
        return assembled(rows) if isinstance(self.source, MongoSource) else rows.drop("_order")

    def named(self, feed: DataFrame) -> DataFrame:
        """Messages with the schema and table their envelope names; null where it cannot be read."""
        return self._named(feed)

    def _named(self, feed: DataFrame, more: str = "") -> DataFrame:
        """As ``named``; with the fields of the DDL ``more`` of each message, alone and in its payload, as ``_t``, from the same parse."""
        fields = T.StructType.fromDDL(f"source struct<db: string, schema: string, table: string, collection: string>{more and ', '}{more}")
        message = F.from_json(F.col("value").cast("string"), T.StructType([*fields, T.StructField("payload", fields)]))
        # exploded so that the conditions of the selection share one parse
        exploded = feed.select("*", F.explode(F.array(message)).alias("_t"))
        exploded = exploded.withColumn("_where", F.coalesce(F.col("_t")["source"], F.col("_t")["payload"]["source"]))
        return exploded.select(
            *feed.columns,
            F.coalesce("_where.schema", "_where.db").alias("_schema"),
            F.coalesce("_where.table", "_where.collection").alias("_table"),
            *(["_t"] if more else []),
        )

    def _growing(self, feed: DataFrame, tables: list[CapturedTable]) -> DataFrame:
        """As ``named``, with the names of a row's columns but those that all ``tables`` declare as ``_more``, from the same parse."""
        parsed = self._named(feed, "after map<string, string>, before map<string, string>")
        image = F.coalesce(*[F.col(f"_t.{p}{i}") for p in ("", "payload.") for i in ("after", "before")])
        known = set.intersection(*[set(t.columns) for t in tables])
        more = F.filter(F.map_keys(image), lambda c: ~c.isin(*sorted(known)))
        return parsed.select(*[c for c in parsed.columns if c != "_t"], more.alias("_more"))

    def selected(self, feed: DataFrame) -> DataFrame:
        """Messages of the selected tables with their table's name."""
        return self._select(self.named(feed))

    def _select(self, named: DataFrame) -> DataFrame:
        return self.selector.select(named, "_schema", "_table", known=[(t.schema, t.table) for t in self.tables])

    def _undelivered(self, named: DataFrame) -> DataFrame:
        """``raw, error`` of messages that name no table, and of selected ones of a table that isn't declared."""
        raw = F.col("value").cast("string").alias("raw")
        unread = named.filter("value IS NOT NULL AND _table IS NULL").select(raw, F.lit("no table named").alias("error"))
        declared = reduce(
            lambda a, b: a | b,
            [F.col("_schema").eqNullSafe(t.schema) & F.col("_table").eqNullSafe(t.table) for t in self.tables],
            F.lit(False),
        )
        others = self._select(named.filter("_table IS NOT NULL")).filter(~declared)
        return unread.union(others.select(raw, F.lit("table not declared").alias("error")))

    def _to_changes(self, decoded: DataFrame, table: CapturedTable) -> DataFrame:
        events = decoded.drop("_raw", "_error")
        with_snapshot = self.source.snapshot if self.snapshot is None else self.snapshot
        if not with_snapshot:
            events = events.filter(F.col("op") != SNAPSHOT)
        if isinstance(self.source, MongoSource):
            return path_changes(events, "message_target")
        names = {CHANGE_METADATA[m][0]: CHANGE_METADATA[m][1] for m in self.metadata}
        events = events.withColumns({f"about_{n}": F.col(c) for n, c in names.items()})
        flat = flatten_events(split_key_changes(events, list(table.primary_key)))
        return flat.withColumnsRenamed({f"about_{n}": n for n in names})

    def _transactional(self, feed: DataFrame) -> DataFrame:
        """As ``named``, with the messages' part in transactions: ``_kind``, change, end or other, ``_tx``, ``_place`` and ``_events``."""
        parsed = self._named(
            feed,
            "op string, transaction struct<id: string, total_order: bigint>, status string, id string, event_count bigint,"
            " data_collections array<struct<data_collection: string, event_count: bigint>>",
        )
        cols = [c for c in parsed.columns if c != "_t"]
        part = lambda f: F.coalesce(F.col("_t")["payload"][f], F.col("_t")[f])
        declared = [f"{t.schema}.{t.table}" for t in self.tables]
        mine = F.filter(part("data_collections"), lambda c: c["data_collection"].isin(*declared))
        counted = F.aggregate(mine, F.lit(0).cast("long"), lambda n, c: n + c["event_count"])
        end, known = part("status") == "END", F.coalesce(F.concat_ws(".", "_schema", "_table").isin(*declared), F.lit(False))
        change = known & F.coalesce(part("op") != SNAPSHOT, F.lit(False))
        kinds = F.array_compact(
            F.array(F.when(change, "change"), F.when(end, "end"), F.when(~change & part("status").isNull(), "other"))
        )
        kind = F.explode(kinds).alias("_kind")
        return parsed.select("*", kind).select(
            *cols,
            "_kind",
            F.when(F.col("_kind") == "change", part("transaction")["id"]).when(F.col("_kind") == "end", part("id")).alias("_tx"),
            F.when(F.col("_kind") == "change", part("transaction")["total_order"]).alias("_place"),
            F.when(F.col("_kind") == "end", F.coalesce(counted, part("event_count"))).alias("_events"),
        )

    def _whole(self, held: DataFrame, batch_id: int, writer: str) -> DataFrame:
        """Messages of transactions that are whole by now, and all that belong to none: snapshots, unplaced ones."""
        cols = [c for c in held.columns if c not in ("_kind", "_tx", "_place", "_events")]
        whole = complete_transactions(
            held.filter("_kind <> 'other'").drop("_kind"), batch_id, f"{self.warehouse}/_transactions", "_tx", "_events", ["_place"], ["_place"], writer
        )
        return held.filter("_kind = 'other'").select(*cols).unionByName(whole.select(*cols))

    def open_transactions(self, seconds: float = 0, writer: str = MAIN) -> DataFrame:
        """Transactions whose rows have waited for so many seconds."""
        return open_transactions(self.spark, f"{self.warehouse}/_transactions", "_tx", "_events", seconds, writer, ["_place"])

    def _deliver_group(self, messages: DataFrame, tables: list[CapturedTable], batch_id: int, writer: str) -> None:
        """Decode tables of equal columns and key together and write them at once; keep what can't be applied."""
        place = lambda t: (F.col("_schema") == t.schema) & (F.col("_table") == t.table)
        name = reduce(lambda out, t: F.when(place(t), t.target).otherwise(out), tables, F.lit(None).cast("string"))
        targets = {t.target: self.target(t) for t in tables}
        mine = messages.withColumn("_target", name).filter(F.col("_target").isNotNull())
        kept = [F.col("_target").alias("message_target")]
        if isinstance(self.source, MongoSource):
            decoded = decode_documents(mine, self.source.order_ddl, kept)
        else:
            decoded = decode_changes(mine, self.source, tables[0].types, kept)
        target = next(iter(targets.values()))
        # Names of the group's tables, beside columns that may be called table themselves.
        to_changes = lambda good: self._to_changes(good, tables[0]).withColumnRenamed("message_target", "table")
        rejects = append_and_reject(
            decoded,
            lambda changes, batch_id: append_tables(changes, targets, batch_id, writer),
            batch_id,
            to_changes,
            None,
            target.pk,
            target.order_by,
            writer,
            by={"message_target": "table"},
        )
        if rejects is not None:
            for t in tables:
                bad = rejects.filter(F.col("by") == t.target).drop("by")
                append_partition(bad, f"{self.warehouse}/_rejects/{t.target}", batch_id, writer)

    def deliver(self, batch: DataFrame, batch_id: int, writer: str = MAIN) -> None:
        """Apply one batch; the same batch again changes nothing.

        A batch of large partitions is dealt in pieces first: what a task sorts is then bounded by rows, not by the feed's splits.
        Of a transactional source it is what the batch lets through that is dealt; the batch itself is stored as it comes.

        What no table takes is kept below ``_rejects``: per table what cannot be decoded or keyed, under ``_unplaced`` what
        names no table or one that isn't declared.
        """
        same = [c for c in ("key", "value", "topic", "partition", "offset") if c in batch.columns]
        if self.source.transactional:
            with self._stored(self._transactional(batch), batch_id, writer) as held:
                named = self._whole(held, batch_id, writer)
                self._deliver_named(named, dealt(self._select(named), same), batch_id, writer)
            return
        batch = dealt(batch, same)
        growing = [t for t in self.tables if self._grows(t)]
        named = (self._growing(batch, growing) if growing else self.named(batch)).persist()
        try:
            self._deliver_named(named, self._select(named), batch_id, writer)
        finally:
            named.unpersist()

    @contextmanager
    def _stored(self, rows: DataFrame, batch_id: int, writer: str) -> Iterator[DataFrame]:
        """The rows of a batch as a file table for as long as the block runs.

        Rows that are read again and again are not cached: whole messages fill an executor's heap with blocks, each as large
        as a partition, beyond what Spark counts of them, and are read whole where few columns are asked for.
        """
        path = f"{self.warehouse}/_transactions/read/writer={writer}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        try:
            yield rows.sparkSession.read.schema(rows.schema).parquet(path)
        finally:
            paths.delete(rows.sparkSession, path)

    def _deliver_named(self, named: DataFrame, messages: DataFrame, batch_id: int, writer: str) -> None:
        """Apply the selected ``messages`` of a batch, and keep what no table takes of all its ``named`` ones."""
        groups: dict[tuple, list[CapturedTable]] = {}
        for table in self.tables:
            if self._grows(table):
                table = self._grown(table, messages.filter((F.col("_schema") == table.schema) & (F.col("_table") == table.table)))
            groups.setdefault((tuple(table.types.items()), table.primary_key), []).append(table)
        with ThreadPoolExecutor(self.writers) as pool:
            list(pool.map(lambda tables: self._deliver_group(messages, tables, batch_id, writer), groups.values()))
        unplaced = self._undelivered(named)
        if not unplaced.isEmpty():
            append_partition(unplaced, f"{self.warehouse}/_rejects/_unplaced", batch_id, writer)

    def load(
        self,
        table: CapturedTable,
        chunks: Iterable[str],
        read: Callable[[str], DataFrame],
        position: Callable[[], Mapping[str, object]],
        log: Callable[[Mapping[str, object], Mapping[str, object]], DataFrame],
        writer: str = "snapshot",
    ) -> None:
        """Load the rows a table has already, chunk by chunk, while its log goes on.

        ``chunks`` are conditions that take every row once, such as ``plan_even_splits(...).predicates()``; ``read`` reads one
        chunk (``read_snapshot`` with a condition), ``position`` tells where the log stands, ``log`` gives the messages between
        two positions. Each chunk is a batch of its own, so a load that is broken off is repeated from the start without
        harm, and the stream of changes may run before, beside or after it.
        """
        target = self.target(table)
        columns = struct_of(table.types)
        for batch_id, condition in enumerate(chunks):
            low = position()
            rows = read(condition).select(*[F.col(f.name).cast(f.dataType) for f in columns]).persist()
            try:
                rows.count()  # read whole before the position after it is taken
                high = position()
                between = self.named(log(low, high)).filter((F.col("_schema") == table.schema) & (F.col("_table") == table.table))
                changes = self._to_changes(accepted(decode_changes(between, self.source, table.types)), table)
                target.append_batch(snapshot_chunk(rows, changes, table.primary_key, high), batch_id, writer)
            finally:
                rows.unpersist()

    def run(self, feed: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Continuously; by default until the end of what is there."""
        writer = writer_of(checkpoint)
        return run_stream(feed, lambda batch, batch_id: self.deliver(batch, batch_id, writer), checkpoint, **trigger)

    def maintain(self, keep_batches: int = 0) -> None:
        """Compact every table and drop what the new bases hold."""
        if self.source.transactional:
            fold_transactions(self.spark, f"{self.warehouse}/_transactions", "_tx")
        for table in self.tables:
            target = self.target(table)
            target.compact()
            target.expire(keep_batches)
