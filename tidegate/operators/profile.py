"""Row counts, sizes and key candidates of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, rows, bytes`` per file table; bytes are the sizes of the files the rows come from."""

    def one(name: str, df: DataFrame) -> DataFrame:
        # file sizes first shrink to one row per file, so the counting stays a partial aggregate
        files = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes")
        )
        return files.agg(
            F.lit(name).alias("table"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"),
        )

    return _union([one(n, df) for n, df in tables.items()])


def feed_profile(feed: DataFrame, schema: str = "schema", table: str = "table") -> DataFrame:
    """Rows per table of a multi-table feed."""
    return feed.groupBy(F.col(schema).alias("schema"), F.col(table).alias("table")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def column_profile(name: str, df: DataFrame, pk: Sequence[str] = ()) -> DataFrame:
    """One row per column: ``table, column, ordinal, data_type, is_pk, rows, nulls``; one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    items = [
        F.struct(
            F.lit(name).alias("table"),
            F.lit(f.name).alias("column"),
            F.lit(i + 1).alias("ordinal"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.name in pk).alias("is_pk"),
            F.col("_rows").alias("rows"),
            F.col(f"_n{i}").alias("nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*items)))


def candidate_keys(name: str, df: DataFrame, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """Which column lists identify a row: ``table, columns, rows, distinct_keys, null_rows, is_key``.

    Grouping by the candidate, then counting the groups, keeps every step a partial aggregate; one distinct count per
    candidate in a single pass would multiply the rows by the number of candidates.
    """

    def one(cols: Sequence[str]) -> DataFrame:
        has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        keys = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).select("_n", has_null.alias("_null"))
        return keys.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
            F.count_if(~F.col("_null")).alias("distinct_keys"),
            F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).cast("long").alias("null_rows"),
        ).select(
            F.lit(name).alias("table"),
            F.lit(",".join(cols)).alias("columns"),
            "rows",
            "distinct_keys",
            "null_rows",
            ((F.col("rows") == F.col("distinct_keys")) & (F.col("null_rows") == 0)).alias("is_key"),
        )

    return _union([one(c) for c in candidates])


# Databases of a document server itself.
SYSTEM_DATABASES = ("admin", "config", "local")


def collection_stats(
    feed: DataFrame, collection: str = "collection", payload: str = "payload", database: str | None = None
) -> DataFrame:
    """Documents and payload bytes per collection; system databases and ``system.*`` collections are left out."""
    named = feed.filter(~F.col(collection).startswith("system."))
    if database:
        named = named.filter(~F.col(database).isin(*SYSTEM_DATABASES))
    return (
        named.groupBy(*([database] if database else []), collection)
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.coalesce(F.sum(F.octet_length(payload).cast("long")), F.lit(0)).alias("bytes"),
        )
    )
