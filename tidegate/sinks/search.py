"""Search-index delivery: bulk documents, request packing, sending."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.changes import DELETE, collapse, unkeyed
from ..operators.skew import bring_together
from .config import SearchSink
from .encode import wire_value
from .lake import MAIN, append_partition


def split_unkeyed_docs(df: DataFrame, pk: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows with a null in it): a null part would vanish from the joined id."""
    if not pk:
        return df, df.limit(0)
    return df.filter(~_any_null(pk)), df.filter(_any_null(pk))


def document_id(pk: Sequence[str], delimiter: str = ",") -> Column:
    return F.concat_ws(delimiter, *[F.col(c).cast("string") for c in pk])


def bulk_docs(
    df: DataFrame, sink: SearchSink, op: str = "op", fields: Sequence[str] | None = None, version: str | None = None
) -> DataFrame:
    """``_index, _id, routing, action, source``: one document per row with a full key.

    Deletes have no source. Without a key the index assigns ids. With ``version``, a column of whole numbers, documents have
    it as their external version, so that the index itself refuses an action older than the last one for the id.
    """
    keyed, _ = split_unkeyed_docs(df, sink.keys)
    names = [c for c in fields or df.columns if c != op]
    source = F.to_json(F.struct(*[wire_value(c, df.schema[c].dataType) for c in names]), {"ignoreNullFields": "false"})
    delete = F.col(op) == DELETE if op in df.columns else F.lit(False)
    return keyed.select(
        (F.col(sink.index_column).cast("string") if sink.index_column else F.lit(sink.index)).alias("_index"),
        (document_id(sink.keys, sink.delimiter) if sink.keys else F.lit(None).cast("string")).alias("_id"),
        (F.col(sink.routing_column).cast("string") if sink.routing_column else F.lit(None).cast("string")).alias("routing"),
        F.when(delete, F.lit("delete")).otherwise(F.lit("index")).alias("action"),
        F.when(~delete, source).alias("source"),
        *([F.col(version).cast("long").alias("version")] if version else []),
    )


def ndjson(docs: DataFrame) -> DataFrame:
    """Bulk text per document: the action line and, unless it deletes, the source line."""
    versioned = ["version", F.lit("external_gte").alias("version_type")] if "version" in docs.columns else []
    target = F.to_json(F.struct("_index", "_id", "routing", *versioned))
    action = F.concat(F.lit('{"'), F.col("action"), F.lit('":'), target, F.lit("}"))
    return docs.select("_index", "_id", "routing", F.concat_ws("\n", action, F.col("source")).alias("value"))


def write_ndjson(docs: DataFrame, path: str) -> None:
    ndjson(docs).select("value").write.mode("append").text(path)


def route(docs: DataFrame) -> DataFrame:
    """Documents of one routing value together; a value with many documents takes several tasks."""
    return bring_together(docs, ["routing"])


def number_batches(
    docs: DataFrame, unique_id: str, max_docs: int, rows_per_lane: int = 100_000, lane: Column | None = None
) -> DataFrame:
    """Fixed request numbers by the count rule: ``lane, batch`` with at most ``max_docs`` documents each.

    Lanes are residues of the unique id's hash, so ids in any stride spread over them. Their number follows the row count,
    so a lane stays near ``rows_per_lane`` rows whatever the table's size, and no other column can make one of them hot.
    ``lane`` is a number to take the residue of instead, for ids that are known to be dense.
    """
    lanes = max(1, math.ceil(docs.count() / rows_per_lane))
    dealt = F.pmod(F.xxhash64(unique_id) if lane is None else lane, F.lit(lanes)).cast("int")
    order = Window.partitionBy("lane").orderBy(unique_id)
    number = F.floor((F.row_number().over(order) - 1) / max_docs).cast("int")
    return docs.withColumn("lane", dealt).withColumn("batch", number)


#: Size limit of a request body whose sink names none.
DEFAULT_MAX_KB = 5 * 1024


def cut_points(lengths: np.ndarray, most_docs: float, most_bytes: float) -> list[int]:
    """Where requests of consecutive documents begin within both limits; a document above the size limit goes alone."""
    ends = np.cumsum(lengths)
    cuts, at = [], 0
    while at < len(lengths):
        cuts.append(at)
        base = ends[at - 1] if at else 0
        fits = int(np.searchsorted(ends, base + most_bytes, side="right")) if most_bytes < float("inf") else len(lengths)
        at = max(at + 1, min(fits, at + most_docs if most_docs < float("inf") else fits))
    return cuts


def pack_requests(docs: DataFrame, max_docs: int | None = None, max_kb: int | None = None) -> DataFrame:
    """Request bodies within the count and size limits: ``docs, bytes, body``.

    Each task packs the documents it holds, in the order they come, so packing needs no shuffle; it keeps one open
    request in memory. A document above the size limit goes alone. Without a size limit ``DEFAULT_MAX_KB`` holds.
    """
    most_docs, most_bytes = max_docs or float("inf"), (max_kb or DEFAULT_MAX_KB) * 1024

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"line": pa.array([], pa.string()), "length": pa.array([], pa.int32())})
        for batch in batches:
            rows = pa.concat_tables([held, pa.Table.from_batches([batch]).cast(held.schema)]).combine_chunks()
            cuts = cut_points(rows["length"].to_numpy().astype(np.int64), most_docs, most_bytes)
            if len(cuts) > 1:
                yield _bodies(rows, cuts)
            held = rows.slice(cuts[-1]) if cuts else rows
        if held.num_rows:
            yield _bodies(held, [0, held.num_rows])

    text = F.concat(F.col("value"), F.lit("\n"))
    lines = ndjson(docs).select(text.alias("line"), F.octet_length(text).alias("length"))
    return lines.mapInArrow(pack, "docs int, bytes long, body string")


def _bodies(rows: pa.Table, cuts: list[int]) -> pa.RecordBatch:
    """Requests between neighbouring cuts."""
    lines, sizes = rows["line"].to_pylist(), np.concatenate(([0], np.cumsum(rows["length"].to_numpy().astype(np.int64))))
    spans = list(zip(cuts, cuts[1:]))
    return pa.RecordBatch.from_pydict(
        {
            "docs": pa.array([b - a for a, b in spans], pa.int32()),
            "bytes": pa.array([int(sizes[b] - sizes[a]) for a, b in spans], pa.int64()),
            "body": pa.array(["".join(lines[a:b]) for a, b in spans], pa.string()),
        }
    )


def send_requests(requests: DataFrame, send: Callable[[str], None], concurrency: int = 1) -> None:
    """Call ``send(body)`` for every request, ``concurrency`` at a time in each task.

    A failed call fails the task and Spark retries it; ids make a repeated request harmless.
    """

    def deliver(rows: Iterator) -> None:
        with ThreadPoolExecutor(concurrency) as pool:
            waiting: list = []
            for row in rows:
                waiting.append(pool.submit(send, row.body))
                if len(waiting) >= concurrency:
                    waiting.pop(0).result()
            for future in waiting:
                future.result()

    requests.select("body").foreachPartition(deliver)


def prepare(
    df: DataFrame,
    sink: SearchSink,
    op: str = "op",
    order_by: Sequence[str] = (),
    fields: Sequence[str] | None = None,
    version: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(bulk documents, ``raw, error`` of the rows that can't be delivered).

    Changes of keyed documents need ``order_by``: only the last change of every id is kept. Rejected are rows with a null in
    the id or in the order, and, unless the sink changes its schema, rows with a value in a column that isn't in
    ``fields``; those columns are left out of the documents.
    """
    changes = op in df.columns
    if sink.keys and changes and not order_by:
        raise ValueError("order_by is required to deliver changes: without it any of them could be the last")
    strict = fields is not None and not sink.auto_schema_change
    beside = [op, *order_by, *([version] if version else [])]
    unknown = [c for c in df.columns if strict and c not in fields and c not in beside]
    named = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in unknown])), ",") if unknown else None
    reason = F.when(_any_null(sink.keys), "null document id") if sink.keys else F.lit(None).cast("string")
    if changes and order_by:
        reason = F.coalesce(reason, unkeyed(df, (), order_by))
    if named is not None:
        reason = F.coalesce(reason, F.when(named != "", F.concat(F.lit("unknown fields: "), named)))
    rejects = df.withColumn("_error", reason).filter("_error IS NOT NULL")
    rejects = rejects.select(F.to_json(F.struct(*df.columns)).alias("raw"), F.col("_error").alias("error"))
    good = df.filter(reason.isNull()).drop(*unknown)
    if changes and sink.keys:
        good = collapse(good, list(sink.keys), list(order_by), op)
    taken = [c for c in good.columns if c in fields] if fields is not None and strict else None
    return bulk_docs(good, sink, op, taken, version), rejects


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def deliver(
    df: DataFrame,
    sink: SearchSink,
    send: Callable[[str], None],
    op: str = "op",
    order_by: Sequence[str] = (),
    reject_path: str | None = None,
    fields: Sequence[str] | None = None,
    version: str | None = None,
    batch_id: int = 0,
    writer: str = MAIN,
) -> None:
    """Rows or changes to the index: documents, routing, packing, sending; see ``prepare``.

    Within a batch no two requests race for one document; with ``version`` none do across batches either, whatever order they
    are sent in. Rejected rows are kept below ``reject_path``, once for each batch however often it is replayed; without a
    path they fail the delivery, before anything is sent.
    """
    docs, rejects = prepare(df, sink, op, order_by, fields, version)
    if not rejects.isEmpty():
        if reject_path is None:
            raise ValueError("rows were rejected, such as without a document id, and there is no reject_path to keep them")
        append_partition(rejects, reject_path, batch_id, writer)
    if sink.routing_column:
        docs = route(docs)
    requests = pack_requests(docs, sink.batch_num_messages, sink.batch_size_kb)
    send_requests(requests, send, sink.concurrent_requests or 1)


def split_unknown_fields(feed: DataFrame, fields: Sequence[str], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """With schema change off: (documents with declared fields only, documents with others and their names)."""
    unknown = F.array_except(F.json_object_keys(F.col(value).cast("string")), F.array(*[F.lit(f) for f in fields]))
    marked = feed.withColumn("unknown_fields", F.array_join(F.coalesce(unknown, F.array(F.lit("?"))), ","))
    return marked.filter("unknown_fields = ''").drop("unknown_fields"), marked.filter("unknown_fields <> ''")
