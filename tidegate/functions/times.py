"""Timestamps as microseconds: JSON text keeps only milliseconds, so envelopes carry BIGINT micros."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_micros(col: Column | str) -> Column:
    return F.unix_micros(F.col(col).cast("timestamp") if isinstance(col, str) else col.cast("timestamp"))


def from_micros(col: Column | str) -> Column:
    return F.timestamp_micros(F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def local_to_utc(col: Column | str, zone: str) -> Column:
    """A wall-clock DATETIME read in the server's zone, as UTC."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_utc_timestamp(c.cast("timestamp"), zone).cast("timestamp_ntz")
