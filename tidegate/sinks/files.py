"""Parquet, JSON and CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import to_append_only
from .config import FileSink
from .encode import encode_debezium, encode_plain, encode_upsert

# Both writers drop microseconds by default.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_SPARK_FORMAT = {"PARQUET": "parquet", "JSON": "json", "CSV": "csv"}
# An empty text is a quoted empty field and a null is \\N; blanks around a value are kept.
_CSV_OPTIONS = {
    "header": "true",
    "nullValue": "\\N",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _options(sink: FileSink) -> dict[str, str]:
    text = TEXT_TIMES if sink.encode != "PARQUET" else {}
    csv = _CSV_OPTIONS if sink.encode == "CSV" else {}
    return {**text, **csv, **sink.options}


def _encoded(df: DataFrame, sink: FileSink, pk: Sequence[str], op: str) -> DataFrame:
    if sink.format == "UPSERT":
        return encode_upsert(df, pk, op)
    if sink.format == "DEBEZIUM":
        return encode_debezium(df, op=op)
    return to_append_only(df, op) if op in df.columns and sink.force_append_only else df


def write_files(df: DataFrame, sink: FileSink, pk: Sequence[str] = (), op: str = "op") -> None:
    """Append the rows. PLAIN takes rows or changes (deletes dropped); the other formats take changes."""
    out = _encoded(df, sink, pk, op)
    out.write.mode("append").format(_SPARK_FORMAT[sink.encode]).options(**_options(sink)).save(sink.path)


def stream_files(
    df: DataFrame, sink: FileSink, checkpoint: str, pk: Sequence[str] = (), op: str = "op", **trigger
) -> StreamingQuery:
    """The same as a stream; the file sink's log and the checkpoint make it exactly-once."""
    out = _encoded(df, sink, pk, op)
    writer = out.writeStream.format(_SPARK_FORMAT[sink.encode]).options(**_options(sink))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(sink.path)


def read_files(spark: SparkSession, sink: FileSink, schema: T.StructType) -> DataFrame:
    """What the sink holds, under the schema it was written with."""
    return spark.read.schema(schema).format(_SPARK_FORMAT[sink.encode]).options(**_options(sink)).load(sink.path)


__all__ = ["TEXT_TIMES", "encode_plain", "read_files", "stream_files", "write_files"]
