"""Applying change rows.

A *flat* change row is a table row plus an ``op`` column: ``r`` snapshot read, ``c`` insert, ``u`` update, ``d`` delete.
A *change event* is what the decoders emit: ``op, before, after, order_key, commit_ts, db, schema, table, txid`` with
``before`` and ``after`` as structs of the table's columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .skew import ROWS_PER_TASK, join_by_key

SNAPSHOT = "r"
DELETE = "d"
UPSERT_OPS = (SNAPSHOT, "c", "u")
EVENT_COLUMNS = ("op", "before", "after", "order_key", "commit_ts", "db", "schema", "table", "txid")


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def split_unkeyed(changes: DataFrame, pk: list[str], order_by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(changes that can be applied, changes with a null in the primary key or the order key)."""
    bad = _any_null([*pk, *order_by])
    return changes.filter(~bad), changes.filter(bad)


def unkeyed(changes: DataFrame, pk: Sequence[str], order_by: Sequence[str]) -> Column:
    """Why a change row cannot be applied: ``null key`` or ``null order key``, else null.

    An order key of several fields is null if all of them are.
    """

    def missing(c: str) -> Column:
        kind = changes.schema[c].dataType
        if not isinstance(kind, T.StructType):
            return F.col(c).isNull()
        return F.col(c).isNull() | reduce(lambda a, b: a & b, [F.col(c)[f.name].isNull() for f in kind])

    any_of = lambda names: reduce(lambda a, b: a | b, [missing(c) for c in names], F.lit(False))
    return F.when(any_of(pk), "null key").when(any_of(order_by), "null order key")


def collapse(
    changes: DataFrame, pk: list[str], order_by: list[str], op: str = "op", sequence: str | None = None
) -> DataFrame:
    """The last change of each key, deletes included as tombstones.

    The greatest ``order_by`` wins. On a tie a delete beats an upsert, then the higher ``sequence`` wins. Rows with a
    null key are not keyed changes and are left out; ``split_unkeyed`` returns them.

    One partial and one final aggregate: each task first reduces its rows to one per key, so a key holding much of the
    log is never gathered in one task, and the same expression runs on a stream.
    """
    if not pk:
        raise ValueError("a primary key is required to apply changes")
    order = F.struct(
        *order_by, (F.col(op) == DELETE).alias("_is_delete"), *([F.col(sequence).alias("_sequence")] if sequence else [])
    )
    row = F.struct(*[c for c in changes.columns if c not in pk])
    last = changes.filter(~_any_null(pk)).groupBy(*pk).agg(F.max_by(row, order).alias("_row"))
    return last.select(*[F.col(c) if c in pk else F.col("_row")[c].alias(c) for c in changes.columns])


def apply_latest(
    changes: DataFrame, pk: list[str], order_by: list[str], op: str = "op", sequence: str | None = None
) -> DataFrame:
    """Current table state: the last change of each key, without deleted keys."""
    return collapse(changes, pk, order_by, op, sequence).filter(F.col(op) != DELETE).drop(op)


def flatten_events(events: DataFrame) -> DataFrame:
    """Change events as flat change rows with ``_op`` and ``_order``: the after image, or the before image of a delete.

    Columns the events carry besides their own, such as message metadata, follow the row's.
    """
    others = [c for c in events.columns if c not in EVENT_COLUMNS and not c.startswith("_")]
    image = F.when(F.col("op") == DELETE, F.col("before")).otherwise(F.col("after"))
    flat = events.select(F.col("op").alias("_op"), F.col("order_key").alias("_order"), image.alias("_image"), *others)
    return flat.select("_op", "_order", "_image.*", *others)


def apply_events(events: DataFrame, pk: list[str]) -> DataFrame:
    """Current table state from change events, key changes included."""
    flat = flatten_events(split_key_changes(events, pk))
    return apply_latest(flat, pk, ["_order"], op="_op").drop("_order")


def split_key_changes(events: DataFrame, pk: list[str]) -> DataFrame:
    """An update that changes the primary key becomes a delete of the old key and an insert of the new one."""
    moved = (F.col("op") == "u") & F.col("before").isNotNull() & reduce(
        lambda a, b: a | b,
        [F.col("before")[c].isNotNull() & (F.col("before")[c] != F.col("after")[c]) for c in pk],
    )
    nothing = F.lit(None)
    pairs = F.when(
        moved,
        F.array(
            F.struct(F.lit(DELETE).alias("op"), F.col("before").alias("before"), nothing.alias("after")),
            F.struct(F.lit("c").alias("op"), nothing.alias("before"), F.col("after").alias("after")),
        ),
    ).otherwise(F.array(F.struct("op", "before", "after")))
    others = [c for c in events.columns if c not in ("op", "before", "after")]
    split = events.select(*others, F.explode(pairs).alias("_e"))
    return split.select(*[F.col("_e")[c].alias(c) if c not in others else F.col(c) for c in events.columns])


def to_append_only(changes: DataFrame, op: str = "op") -> DataFrame:
    """Inserts and after images of updates, as plain rows; deletes are dropped."""
    return changes.filter(F.col(op).isin(*UPSERT_OPS)).drop(op)


def snapshot_then_log(
    snapshot: DataFrame, log: DataFrame, position: Mapping[str, object], snapshot_rows: bool = True, op: str = "op"
) -> DataFrame:
    """Changes of a table whose existing rows are read first.

    Snapshot rows become op ``r`` at ``position``, the order-key values that lie just below the first log entry.
    ``snapshot_rows=False`` takes the log only.
    """
    if not snapshot_rows:
        return log
    rows = snapshot.withColumn(op, F.lit("r"))
    for c, value in position.items():
        rows = rows.withColumn(c, F.lit(value).cast(log.schema[c].dataType))
    return rows.unionByName(log)


def snapshot_chunk(
    rows: DataFrame, log: DataFrame, pk: Sequence[str], position: Mapping[str, object], order: str = "_order", op: str = "_op"
) -> DataFrame:
    """Changes of a chunk of a table that was read while the log went on.

    ``log`` has the changes, deletes included, between the log positions before and after the read. Where it changes a key the
    chunk's row may be older or newer than that, and the log has the truth, so the row is dropped; any other row is
    the table's at ``position``, the one after the read, and becomes op ``r`` there.
    """
    changed = log.select(*pk).distinct()
    kind = log.schema[order].dataType
    at = F.struct(*[F.lit(position.get(f.name)).cast(f.dataType).alias(f.name) for f in kind])
    kept = rows.join(changed, list(pk), "left_anti")
    return kept.select(F.lit(SNAPSHOT).alias(op), at.alias(order), *rows.columns)


def transaction_sizes(
    rows: DataFrame, txid: str, markers: DataFrame, declared: str, position: list[str] | None = None
) -> DataFrame:
    """One row per transaction seen: ``txid, seen, declared, complete``.

    With ``position``, the columns that tell the rows of a transaction apart, a row that is delivered twice counts once.
    """
    count = F.count_distinct(F.struct(*position)) if position else F.count(F.lit(1))
    seen = rows.groupBy(txid).agg(count.alias("seen"))
    return seen.join(markers.select(txid, F.col(declared).alias("declared")), txid, "left").withColumn(
        "complete", F.coalesce(F.col("seen") == F.col("declared"), F.lit(False))
    )


def mark_transactions(
    rows: DataFrame,
    txid: str,
    markers: DataFrame,
    declared: str,
    spread_by: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    position: list[str] | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """The rows with ``complete``: whether as many rows of their transaction arrived as its marker declares.

    A transaction holding a large share of the rows is spread over several tasks by a hash of ``spread_by``. ``position``
    is as in ``transaction_sizes``. ``sizes``, if they are known, are ``txid, seen, complete``, which are read twice; rows of
    transactions that they don't have are left out.
    """
    how = "left" if sizes is None else "inner"
    if sizes is None:
        sizes = transaction_sizes(rows, txid, markers, declared, position).drop("declared")
    marked = join_by_key(rows, sizes, [txid], "seen", spread_by, how, rows_per_task)
    return marked.select(*rows.columns, F.coalesce("complete", F.lit(False)).alias("complete"))


def split_transactions(
    rows: DataFrame,
    txid: str,
    markers: DataFrame,
    declared: str,
    spread_by: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    position: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows of complete transactions, rows to carry to the next batch)."""
    marked = mark_transactions(rows, txid, markers, declared, spread_by, rows_per_task, position)
    return marked.filter("complete").drop("complete"), marked.filter("NOT complete").drop("complete")
