"""Helpers the operators share: columns computed in Arrow batches, texts as arrays of code points, written tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.session import work_path

#: Bytes of text that one step of the vectorised code takes at once; a longer single text is taken alone.
STEP_BYTES = 500_000

ADDED = "__added"


def saved(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back, which cuts its lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, spent: str | None = None) -> tuple[DataFrame, str]:
    """``saved``, and the path. ``spent`` is the path of a table that nothing reads any more once this one is written."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    if spent:
        emptied(df.sparkSession, spent)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def emptied(spark: SparkSession, path: str) -> None:
    """Free the room of a table of ours, by Spark's own writer, which reaches whatever store the folder lies in."""
    spark.range(0).write.mode("overwrite").parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes in the column, or one row."""
    if not batch.num_rows:
        return
    sizes = np.nan_to_num(
        pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.float64)
    ).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def add_columns(
    df: DataFrame,
    column: str,
    fields: list[T.StructField],
    compute: Callable[[pa.Array], list],
    prepare: Callable[[], Callable[[pa.Array], list]] | None = None,
) -> DataFrame:
    """All columns of ``df`` and the new ``fields``, which ``compute`` derives from the text column, null as empty.

    As with ``withColumn``, a column that already has the name of a new field is replaced. ``prepare`` makes ``compute``
    once per task, for state such as caches.
    """
    new = [f.name for f in fields]
    lower = {n.lower() for n in new}
    kept = [c for c in df.columns if c.lower() not in lower]
    inner = df.select(*[df[c].alias(f"{ADDED}{i}") for i, c in enumerate(kept)], df[column].alias(ADDED))
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in inner.schema.fields if f.name != ADDED]
        + [T.StructField(f"{ADDED}_{f.name}", f.dataType, True) for f in fields]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = prepare() if prepare else compute
        for whole in batches:
            for b in steps(whole, ADDED):
                texts = pc.fill_null(b.column(ADDED), "")
                made = [
                    v if isinstance(v, pa.Array) else pa.array(v, arrow.field(b.num_columns - 1 + i).type)
                    for i, v in enumerate(fn(texts))
                ]
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 1)] + made, schema=arrow)

    out = inner.mapInArrow(run, schema)
    return out.select(
        *[out[f"{ADDED}{i}"].alias(c) for i, c in enumerate(kept)], *[out[f"{ADDED}_{n}"].alias(n) for n in new]
    )


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each begins (one more entry for the end)."""
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts in one array and where each text begins in it; the bytes, and where each code point begins."""
    raw, at = buffers(texts)
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    leads = np.flatnonzero((raw & 0xC0) != 0x80)
    byte_at = np.append(leads, len(raw))
    return codes, np.searchsorted(leads, at), raw, byte_at


def fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"
