"""Database tables over JDBC.

Appends are plain writes. An upsert stages its rows with a parallel write and merges them with one statement that runs
inside the database, so a failed task never leaves the target half merged.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.changes import DELETE, UPSERT_OPS, collapse, to_append_only, unkeyed
from .config import JdbcSink
from .lake import MAIN, append_partition


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _quoted_path(name: str) -> str:
    return ".".join(quoted(p) for p in name.split("."))


def append_rows(changes: DataFrame, op: str = "op") -> DataFrame:
    return to_append_only(changes, op) if op in changes.columns else changes


def upsert_rows(changes: DataFrame, pk: Sequence[str], order_by: Sequence[str], op: str = "op") -> DataFrame:
    """What an upsert stages: the last change of each key, with ``op`` reduced to ``u`` or ``d``.

    Without an order any change could be the last, so one is required.
    """
    if not order_by:
        raise ValueError("order_by is required to upsert changes")
    last = collapse(changes, list(pk), list(order_by), op)
    return last.withColumn(op, F.when(F.col(op).isin(*UPSERT_OPS), F.lit("u")).otherwise(F.col(op)))


def merge_statements(
    target: str,
    staging: str,
    columns: Sequence[str],
    pk: Sequence[str],
    op: str = "op",
    order_by: Sequence[str] = (),
    tombstone: str | None = None,
) -> list[str]:
    """Statements that move staged rows into the target and remove deleted keys.

    With ``order_by`` columns, kept in the target, an earlier change never replaces or removes a later row. With ``tombstone``,
    a boolean column of the target, a deleted key stays as a row for which it is true, so that a change older than the
    delete doesn't bring the row back.
    """
    if tombstone:
        return _tombstone_statements(target, staging, columns, pk, op, order_by, tombstone)
    t, s = _quoted_path(target), _quoted_path(staging)
    names = ", ".join(quoted(c) for c in columns)
    keys = ", ".join(quoted(c) for c in pk)
    values = [c for c in columns if c not in pk]
    action = "DO UPDATE SET " + ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in values) if values else "DO NOTHING"
    row = lambda name: "(" + ", ".join(f"{name}.{quoted(c)}" for c in order_by) + ")"
    newer = f" WHERE {row('EXCLUDED')} >= {row('t')}" if order_by and values else ""
    not_older = f" AND {row('s')} >= {row('t')}" if order_by else ""
    same_key = " AND ".join(f"t.{quoted(c)} = s.{quoted(c)}" for c in pk)
    return [
        f"DELETE FROM {t} AS t USING {s} AS s WHERE {same_key} AND s.{quoted(op)} = '{DELETE}'{not_older}",
        f"INSERT INTO {t}{' AS t' if newer else ''} ({names}) SELECT {names} FROM {s} WHERE {quoted(op)} <> '{DELETE}' "
        f"ON CONFLICT ({keys}) {action}{newer}",
    ]


def _tombstone_statements(
    target: str, staging: str, columns: Sequence[str], pk: Sequence[str], op: str, order_by: Sequence[str], tombstone: str
) -> list[str]:
    if not order_by:
        raise ValueError("tombstones need order_by columns in the target")
    t, s = _quoted_path(target), _quoted_path(staging)
    written = [*columns, tombstone]
    names, keys = (", ".join(quoted(c) for c in some) for some in (written, pk))
    staged = ", ".join([*[quoted(c) for c in columns], f"{quoted(op)} = '{DELETE}'"])
    sets = ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in written if c not in pk)
    row = lambda name: "(" + ", ".join(f"{name}.{quoted(c)}" for c in order_by) + ")"
    return [
        f"INSERT INTO {t} AS t ({names}) SELECT {staged} FROM {s} "
        f"WHERE true ON CONFLICT ({keys}) DO UPDATE SET {sets} WHERE {row('EXCLUDED')} >= {row('t')}"
    ]


def _execute(spark: SparkSession, sink: JdbcSink, statements: Sequence[str]) -> None:
    """Run statements in one transaction on a driver-side connection; no rows pass through it."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for key, value in sink.options.items():
        properties.setProperty(key, value)
    if "driver" in sink.options:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(sink.options["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(sink.url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    finally:
        connection.close()


def write_jdbc(
    df: DataFrame,
    sink: JdbcSink,
    order_by: Sequence[str] = (),
    op: str = "op",
    reject_path: str | None = None,
    batch_id: int = 0,
    writer: str = MAIN,
) -> None:
    """Append rows, or upsert changes by the sink's primary key in the order of ``order_by``.

    Changes with a null in the key or the order are kept below ``reject_path``; without one they fail the delivery.
    """
    if sink.data_type == "append-only":
        append_rows(df, op).write.jdbc(sink.url, sink.target, mode="append", properties=sink.options)
        return
    reason = unkeyed(df, sink.keys, order_by)
    rejects = df.withColumn("_error", reason).filter("_error IS NOT NULL")
    if not rejects.isEmpty():
        if reject_path is None:
            raise ValueError("changes without a key or an order, and no reject_path to keep them")
        raw = F.to_json(F.struct(*df.columns)).alias("raw")
        append_partition(rejects.select(raw, F.col("_error").alias("error")), reject_path, batch_id, writer)
    staged = upsert_rows(df.filter(reason.isNull()), sink.keys, order_by, op)
    staging = f"{sink.target}_stage_{uuid.uuid4().hex}"
    staged.write.jdbc(sink.url, staging, mode="overwrite", properties=sink.options)
    columns = [c for c in staged.columns if c != op]
    kept_order = [c for c in order_by if c in columns]
    statements = merge_statements(sink.target, staging, columns, sink.keys, op, kept_order, sink.tombstone)
    try:
        _execute(df.sparkSession, sink, statements)
    finally:
        _execute(df.sparkSession, sink, [f"DROP TABLE {_quoted_path(staging)}"])
