"""Many tables to one kind of sink, and one feed to many tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.observe import observed
from ..operators.skew import bring_together
from .lake import MAIN, overwrite, placed

RESULT = "sink string, table string, rows long, ok boolean, error string, seconds double"


def sink_input(spark: SparkSession, table: str | None = None, query: str | None = None) -> DataFrame:
    """The rows of a sink: a table, or a SELECT; exactly one of them."""
    if bool(table) == bool(query):
        raise ValueError("give either a table or a query")
    return spark.sql(query) if query else spark.table(table)


def deliver_tables(
    spark: SparkSession,
    sink: str,
    write: Callable[[DataFrame, str], None],
    tables: Sequence[str] = (),
    queries: Mapping[str, str] | None = None,
    frames: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``write(rows, name)`` for every table; one that fails is reported and does not stop the rest.

    Each name gets its own target. Rows are counted while they are written, not by a second scan.
    """
    queries, frames = queries or {}, frames or {}
    results = []
    for name in dict.fromkeys([*tables, *queries, *frames]):
        started = time.monotonic()
        seen = Observation()
        try:
            if name in frames:
                rows = frames[name]
            elif name in queries:
                rows = sink_input(spark, query=queries[name])
            else:
                rows = sink_input(spark, table=name)
            write(rows.observe(seen, F.count(F.lit(1)).alias("n")), name)
            results.append((sink, name, observed(seen, lambda: {"n": rows.count()})["n"], True, None, time.monotonic() - started))
        except Exception as e:  # reported per table
            text = str(e).strip().splitlines() or [type(e).__name__]
            results.append((sink, name, 0, False, text[0], time.monotonic() - started))
    return spark.createDataFrame(results, RESULT)


def fan_out(
    feed: DataFrame, path: str, schema: str = "schema", table: str = "table", batch_id: int | None = None, writer: str = MAIN
) -> None:
    """One pass over a multi-table feed: its rows land in one partition per table, writer and batch.

    The rows are brought together by table first. Otherwise every task would leave a file in every table's partition. The
    same batch of a writer again replaces its rows; without a ``batch_id`` every call is a batch of its own.
    """
    batch = batch_id if batch_id is not None else time.time_ns() // 1000
    named = feed.withColumnsRenamed({schema: "source_schema", table: "source_table"})
    dealt = bring_together(named, ["source_schema", "source_table"]).withColumns(placed(batch, writer))
    overwrite(dealt.write, path, "source_schema", "source_table", "writer", "batch")


def fan_out_table(
    spark: SparkSession, path: str, schema: str, table: str, columns: T.StructType | None = None, payload: str = "after"
) -> DataFrame:
    """One table's rows of a fanned-out feed, the JSON payload parsed into its columns."""
    rows = spark.read.parquet(path).filter((F.col("source_schema") == schema) & (F.col("source_table") == table))
    rows = rows.drop("source_schema", "source_table", "writer", "batch")
    if columns is None:
        return rows
    others = [c for c in rows.columns if c != payload]
    return rows.select(*others, F.from_json(payload, columns).alias("_row")).select(*others, "_row.*")
