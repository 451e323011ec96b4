"""Bloom filters over 64-bit hashes: rows that a join can't need stay where they are.

A filter has a fixed bound of ``MOST`` bits. It never misses a hash it was made of; a fuller one admits more others, which
costs a shuffle of them and changes no result, because what it admits is still joined or counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import mixed

#: Bits of a filter at most, for each hash, and set by each hash.
MOST, EACH, PROBES = 1 << 27, 16, 4


@dataclass
class Bloom:
    bits: np.ndarray

    def places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        start = mixed(h ^ np.uint64(0x9E3779B97F4A7C15))
        step = mixed(start) | np.uint64(1)
        for i in range(PROBES):
            yield (start + np.uint64(i) * step) & np.uint64(len(self.bits) * 64 - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in self.places(h):
            out &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out

    def test(self, h: Column) -> Column:
        """Whether the filter admits a hash, a long."""

        @F.pandas_udf("boolean")
        def admitted(values: pd.Series) -> pd.Series:
            return pd.Series(self.has(values.to_numpy().astype(np.int64).view(np.uint64)))

        return admitted(h)

    @classmethod
    def of(cls, hashes: DataFrame) -> Bloom:
        """Filter of the only column of ``hashes``, longs."""
        (name,) = hashes.columns
        wanted = max(1024, min(MOST, EACH * hashes.count()))
        out = cls(np.zeros((1 << (wanted - 1).bit_length()) // 64, np.uint64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                h = b.column(0).to_numpy().view(np.uint64)
                at = np.concatenate(list(out.places(h))) if len(h) else np.zeros(0, np.uint64)
                bits = np.uint64(1) << (at & np.uint64(63))
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bits.view(np.int64))], names=["place", "bits"])

        rows = hashes.filter(F.col(name).isNotNull()).mapInArrow(run, "place long, bits long")
        # A row for each 64 bits of the filter at most.
        got = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
        out.bits[got.column("place").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        return out


def split(df: DataFrame, keys: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` may be among the only column of ``keys``, rows whose key surely isn't)."""
    admitted = Bloom.of(keys).test(key)
    return df.filter(admitted), df.filter(~admitted)
