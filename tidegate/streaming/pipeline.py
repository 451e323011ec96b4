"""Feeds that run continuously. The same operators as in batch, per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import mark_transactions, unkeyed
from ..operators.observe import observed
from ..sinks.lake import MAIN, BatchTable, LakeTable, append_partition, writer_of


def run_stream(
    stream: DataFrame,
    deliver: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    **trigger,
) -> StreamingQuery:
    """Hand every micro-batch to ``deliver(rows, batch_id)``; a batch may come twice and must then change nothing."""
    return (
        stream.writeStream.foreachBatch(deliver)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_and_reject(
    decoded: DataFrame,
    append: Callable[[DataFrame, int], None],
    batch_id: int,
    to_changes: Callable[[DataFrame], DataFrame],
    reject_path: str | None,
    pk: Sequence[str] = (),
    order_by: Sequence[str] = (),
    writer: str = MAIN,
    by: Mapping[str, str] | None = None,
) -> DataFrame | None:
    """Append the good rows of a decoded batch; write ``raw, error`` of the others to ``reject_path``.

    With ``pk`` and ``order_by`` change rows with a null in them are rejected too, as JSON. Rejects are counted while the
    good rows are written, so a clean batch is decoded once. With ``by``, the name of a column before and after
    ``to_changes``, rejects are returned with that column as ``by`` instead, or None if there are none.
    """
    ((before, after),) = by.items() if by else ((None, None),)
    named = lambda c: [F.col(c).alias("by")] if by else []
    seen, keyless = Observation(), Observation()
    counted = decoded.observe(seen, F.count_if(F.col("_error").isNotNull()).alias("bad"))
    changes = to_changes(counted.filter("_error IS NULL"))
    if pk or order_by:
        reason = unkeyed(changes, pk, order_by)
        changes = changes.observe(keyless, F.count_if(reason.isNotNull()).alias("bad")).filter(reason.isNull())
    append(changes, batch_id)
    bad = []
    if observed(seen, lambda: {"bad": decoded.filter("_error IS NOT NULL").count()})["bad"]:
        of_messages = decoded.filter("_error IS NOT NULL")
        bad.append(of_messages.select(F.col("_raw").alias("raw"), F.col("_error").alias("error"), *named(before)))
    rows = to_changes(decoded.filter("_error IS NULL"))
    if (pk or order_by) and observed(keyless, lambda: {"bad": rows.filter(unkeyed(rows, pk, order_by).isNotNull()).count()})["bad"]:
        reason = unkeyed(rows, pk, order_by)
        bad.append(rows.filter(reason.isNotNull()).select(F.to_json(F.struct("*")).alias("raw"), reason.alias("error"), *named(after)))
    if by:
        return reduce(DataFrame.union, bad) if bad else None
    if bad and reject_path is None:
        raise ValueError("rows were rejected and there is no reject_path to keep them")
    if bad:
        append_partition(reduce(DataFrame.union, bad), reject_path, batch_id, writer)
    return None


def stream_to_lake(
    stream: DataFrame,
    table: LakeTable,
    checkpoint: str,
    decode: Callable[[DataFrame], DataFrame] | None = None,
    reject_path: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep a lake table at the latest state of a change stream.

    ``decode`` turns a micro-batch of messages into change rows with an ``_error`` column; rejected rows, and those with a
    null key or order key, go to ``reject_path``, by default beside the table. Each batch is reduced to one change per key before it is written, and order keys and tombstones are
    stored with the rows, so changes may arrive in any order across batches. There is no streaming state to grow.
    """

    writer = writer_of(checkpoint)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        rows = decode(batch) if decode else batch
        if "_error" not in rows.columns:
            rows = rows.withColumns({"_error": F.lit(None).cast("string"), "_raw": F.lit(None).cast("string")})
        append_and_reject(
            rows,
            lambda changes, batch_id: table.append_batch(changes, batch_id, writer),
            batch_id,
            lambda r: r.drop("_error", "_raw"),
            reject_path or f"{table.path}_rejects",
            table.pk,
            table.order_by,
            writer,
        )

    return run_stream(stream, deliver, checkpoint, **trigger)


def complete_transactions(
    batch: DataFrame,
    batch_id: int,
    carry_path: str,
    txid: str,
    declared: str,
    spread_by: Sequence[str],
    position: Sequence[str] = (),
    writer: str = MAIN,
) -> DataFrame:
    """Rows of the transactions that are whole by this batch; the others wait below ``carry_path``.

    The batch holds change rows and markers: a marker has the number of its transaction's rows in ``declared``, which is
    null on rows. Only transactions that the batch names can become whole, so it is joined with their waiting rows alone, and
    what it leaves open is appended once and never rewritten (``fold_transactions`` drops delivered rows now and then). A
    batch that is replayed finds what it found the first time. Rows of a transaction that has been delivered are repeats
    and left out; rows without a transaction are kept in ``<carry_path>/rejects``.
    """
    spark = batch.sparkSession
    pending, done = BatchTable(spark, f"{carry_path}/pending"), BatchTable(spark, f"{carry_path}/done")
    keyless = batch.filter(F.col(txid).isNull())
    if not keyless.isEmpty():
        raw = F.to_json(F.struct(*batch.columns)).alias("raw")
        append_partition(keyless.select(raw, F.lit("null transaction id").alias("error")), f"{carry_path}/rejects", batch_id, writer)
    new = batch.filter(F.col(txid).isNotNull()).withColumn("_batch", F.lit(batch_id).cast("long"))
    waiting, delivered = pending.rows(before=(writer, batch_id)), done.rows(before=(writer, batch_id))
    both = new.unionByName(waiting.select(*new.columns)) if waiting.columns else new
    mine = F.col("_batch") == batch_id
    sizes, step = BatchTable(spark, f"{carry_path}/sizes"), BatchTable(spark, f"{carry_path}/step")
    sizes.append(_sizes(new, waiting, delivered, txid, declared, position), batch_id, writer)
    named = sizes.batch(batch_id, writer)
    markers = both.filter(F.col(declared).isNotNull())
    step.append(mark_transactions(both, txid, markers, declared, list(spread_by), sizes=named), batch_id, writer)
    marked = step.batch(batch_id, writer)
    pending.append(marked.filter(~F.col("complete") & mine).select(*new.columns), batch_id, writer)
    done.append(named.filter("complete").select(txid), batch_id, writer)
    sizes.forget(2)
    step.forget(2)
    return marked.filter(F.col("complete") & F.col(declared).isNull()).drop("complete", "_batch", declared)


def _sizes(new: DataFrame, waiting: DataFrame, delivered: DataFrame, txid: str, declared: str, position: Sequence[str]) -> DataFrame:
    """``txid, seen, complete`` of the transactions that a batch names and that have not been delivered.

    One aggregate over what is new, what waits and what is done, without the rows themselves, in place of joins of each
    with the others.
    """
    at = F.when(F.col(declared).isNull(), F.struct(*position) if position else F.lit(1)).alias("_at")
    of = lambda rows, named: rows.select(txid, at, F.col(declared).alias("_declared"), F.lit(named).alias("_named"), F.lit(False).alias("_done"))
    seen = of(new, True)
    if waiting.columns:
        seen = seen.unionByName(of(waiting, False))
    if delivered.columns:
        seen = seen.unionByName(delivered.select(txid, F.lit(False).alias("_named"), F.lit(True).alias("_done")), allowMissingColumns=True)
    count = F.count_distinct("_at") if position else F.count("_at")
    sizes = seen.groupBy(txid).agg(count.alias("seen"), F.max("_declared").alias("_declared"), F.max("_named").alias("_named"), F.max("_done").alias("_done"))
    whole = (F.col("seen") > 0) & (F.col("seen") == F.col("_declared"))
    return sizes.filter("_named AND NOT _done").select(txid, "seen", F.coalesce(whole, F.lit(False)).alias("complete"))


def fold_transactions(spark: SparkSession, carry_path: str, txid: str, remember: int = 1000) -> None:
    """Drop waiting rows whose transactions have been delivered, and forget ids delivered over ``remember`` batches ago.

    What the newest batch delivered stays: if it is replayed, it needs the rows again.
    """
    pending, done = BatchTable(spark, f"{carry_path}/pending"), BatchTable(spark, f"{carry_path}/done")
    delivered = done.settled()
    if not delivered.columns:
        return
    pending.fold(lambda rows: rows.join(delivered.select(txid).distinct(), txid, "left_anti").select(*rows.columns))
    done.forget(remember)


def open_transactions(
    spark: SparkSession, carry_path: str, txid: str, declared: str, seconds: float = 0, writer: str = MAIN, position: Sequence[str] = ()
) -> DataFrame:
    """``txid, rows, declared, first_batch`` of transactions that have waited for so many seconds or longer."""
    pending, done = BatchTable(spark, f"{carry_path}/pending"), BatchTable(spark, f"{carry_path}/done")
    waiting = pending.rows().join(done.rows().select(txid).distinct(), txid, "left_anti")
    of_row = F.col(declared).isNull()
    seen = waiting.groupBy(txid).agg(
        (F.count_distinct(F.when(of_row, F.struct(*position))) if position else F.count_if(of_row)).alias("rows"), F.max(declared).alias(declared), F.min("_batch").alias("first_batch")
    )
    return seen.filter(F.col("first_batch") <= pending.batch_before(seconds, writer))


def stream_transactions_to_lake(
    stream: DataFrame,
    table: LakeTable,
    checkpoint: str,
    carry_path: str,
    txid: str,
    declared: str,
    spread_by: Sequence[str],
    position: Sequence[str] = (),
    **trigger,
) -> StreamingQuery:
    """Upsert a change stream by whole transactions: none is visible before all of its rows have come.

    ``position`` names the columns that tell a transaction's rows apart, so that a repeated delivery counts once.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            writer = writer_of(checkpoint)
            whole = complete_transactions(batch, batch_id, carry_path, txid, declared, spread_by, position, writer)
            table.append_batch(whole, batch_id, writer)
        finally:
            batch.unpersist()

    return run_stream(stream, deliver, checkpoint, **trigger)


def fan_out_stream(
    stream: DataFrame,
    tables: dict[tuple[str, str], Callable[[DataFrame, int], None]],
    checkpoint: str,
    schema: str = "schema",
    table: str = "table",
    **trigger,
) -> StreamingQuery:
    """One multi-table stream to many tables; the batch is read once and filtered per table."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for (s, t), write in tables.items():
                write(batch.filter((F.col(schema) == s) & (F.col(table) == t)), batch_id)
        finally:
            batch.unpersist()

    return run_stream(stream, deliver, checkpoint, **trigger)


def dedupe_stream(stream: DataFrame, key: Sequence[str], event_time: str, watermark: str) -> DataFrame:
    """Drop repeated deliveries of a key that come within the watermark of the first."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(key))


def stream_rollup(
    stream: DataFrame, keys: Sequence[str], event_time: str, bucket: str, watermark: str, aggregates: Sequence[Column]
) -> DataFrame:
    """Running aggregates per key and time bucket: ``keys…, bucket_start, aggregates…``; for update mode.

    The watermark bounds the state: rows that come later than it are left out, so it has to exceed the feed's lateness.
    """
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, watermark)
    rolled = timed.groupBy(F.window(event_time, bucket).alias("_w"), *keys).agg(*aggregates)
    names = [c for c in rolled.columns if c != "_w" and c not in keys]
    return rolled.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("bucket_start"), *names)


def rollup_to_lake(rolled: DataFrame, table: LakeTable, checkpoint: str, version: str = "version", **trigger) -> StreamingQuery:
    """Upsert the updated buckets of every micro-batch; the batch id orders the versions of a bucket."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(version, F.lit(batch_id).cast("long")).withColumn(table.op, F.lit("u"))
        table.append_batch(rows, batch_id, writer_of(checkpoint))

    return run_stream(rolled, deliver, checkpoint, output_mode="update", **trigger)


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be taken in parts: ``part`` over rows, ``whole`` over the parts."""

    name: str
    part: Column
    whole: Callable[[str], Column]


def rollup_parts(
    stream: DataFrame, path: str, keys: Sequence[str], event_time: str, bucket: str, measures: Sequence[Measure], checkpoint: str, **trigger
) -> StreamingQuery:
    """Aggregates of every micro-batch per key and time bucket, appended below ``path`` and combined when read.

    There is no streaming state and no watermark: a row counts however late it comes. A batch that is replayed replaces its
    aggregates.
    """
    writer, table = writer_of(checkpoint), BatchTable(stream.sparkSession, path)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn(event_time, F.col(event_time).cast("timestamp"))
        parts = timed.groupBy(F.window(event_time, bucket).alias("_w"), *keys).agg(*[m.part.alias(m.name) for m in measures])
        start = F.col("_w.start").cast("timestamp_ntz").alias("bucket_start")
        table.append(parts.select(*keys, start, *[m.name for m in measures]), batch_id, writer)

    return run_stream(stream, deliver, checkpoint, **trigger)


def combined(parts: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return parts.groupBy(*keys, "bucket_start").agg(*[m.whole(m.name).alias(m.name) for m in measures])


def read_rollup(spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """``keys…, bucket_start, measures…``."""
    return combined(BatchTable(spark, path).rows(), keys, measures)


def fold_rollup(spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[Measure]) -> None:
    """One row per key and bucket in place of those of all batches but the newest."""
    table = BatchTable(spark, path)
    table.fold(lambda parts: combined(parts, keys, measures).select(*parts.columns))


def late_rows(query: StreamingQuery) -> int:
    """Rows that a stream's watermark has left out, in the progress reports that the query keeps."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
