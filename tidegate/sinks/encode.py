"""Output envelopes of message-shaped sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.times import to_micros


def wire_value(name: str, dtype: T.DataType) -> Column:
    """A column as it travels in JSON: times as BIGINT micros, binary as base64."""
    col = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return to_micros(col).alias(name)
    if isinstance(dtype, T.BinaryType):
        return F.base64(col).alias(name)
    return col.alias(name)


def wire_row(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    return F.struct(*[wire_value(c, df.schema[c].dataType) for c in columns or df.columns])


def _rest(df: DataFrame, *left_out: str) -> list[str]:
    return [c for c in df.columns if c not in left_out]


def encode_plain(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(wire_row(df), {"ignoreNullFields": "false"}).alias("value"))


def encode_upsert(changes: DataFrame, pk: Sequence[str], op: str = "op") -> DataFrame:
    """``key, value`` JSON; the value of a delete is null."""
    keep = {"ignoreNullFields": "false"}
    return changes.select(
        F.to_json(wire_row(changes, pk), keep).alias("key"),
        F.when(F.col(op) != "d", F.to_json(wire_row(changes, _rest(changes, op)), keep)).alias("value"),
    )


def encode_debezium(
    changes: DataFrame, columns: Sequence[str] | None = None, op: str = "op", source: Column | None = None
) -> DataFrame:
    """``{op, before, after[, source]}`` JSON: deletes carry the row as before, everything else as after."""
    row = wire_row(changes, columns or _rest(changes, op))
    envelope = [
        F.col(op).alias("op"),
        F.when(F.col(op) == "d", row).alias("before"),
        F.when(F.col(op) != "d", row).alias("after"),
    ]
    if source is not None:
        envelope.append(source.alias("source"))
    return changes.select(F.to_json(F.struct(*envelope), {"ignoreNullFields": "false"}).alias("value"))
