"""Checks of constraints and column selections against the rows themselves."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .selection import ColumnSelection


def _null_count(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows breaking NOT NULL, per column: one pass, one row per column."""
    counts = df.agg(*[_null_count(c).alias(c) for c in columns])
    per_column = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in columns])
    return counts.select(F.inline(per_column))


def split_not_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows)."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.filter(~bad), df.filter(bad)


def pk_violations(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys that break the primary key: ``pk…, rows, reason`` (``duplicate`` or ``null key``)."""
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    keys = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("rows"))
    reason = F.when(has_null, F.lit("null key")).when(F.col("rows") > 1, F.lit("duplicate"))
    return keys.withColumn("reason", reason).filter("reason IS NOT NULL")


_FINDING = "rule string, column string, severity string, violating_rows long"


def selection_findings(
    df: DataFrame,
    selection: Sequence[ColumnSelection],
    upstream_pk: Sequence[str],
    upstream_not_null: Sequence[str] = (),
    document: bool = False,
) -> DataFrame:
    """What is wrong with a column selection: ``rule, column, severity, violating_rows``.

    Errors: unknown column, a key claimed that upstream has not, an upstream key left out, no key at all; for documents
    an ``_id`` missing or not the key. Warnings: an upstream key not marked, a nullability that differs from upstream.
    The row counts come from the data: nulls of the column, or rows sharing their key with another row.
    """
    present, chosen = set(df.columns), [s.name for s in selection]
    marked = [s.name for s in selection if s.primary_key]
    total = F.col("_total")
    static: list[tuple[str, str, str, Column]] = []
    for s in selection:
        if s.name not in present:
            static.append(("unknown column", s.name, "error", total))
            continue
        if s.primary_key and s.name not in upstream_pk:
            static.append(("not an upstream key", s.name, "error", total))
        if s.name in upstream_pk and not s.primary_key:
            static.append(("upstream key not marked", s.name, "warning", total))
        if s.nullable is not None and s.nullable == (s.name in upstream_not_null):
            static.append(("nullability override", s.name, "warning", F.col(f"_null_{s.name}")))
    if not marked:
        static.append(("no primary key", "", "error", total))
    for c in upstream_pk:
        if c not in chosen:
            static.append(("upstream key left out", c, "error", total))
    if document and "_id" not in chosen:
        static.append(("_id left out", "_id", "error", total))
    elif document and "_id" not in marked:
        static.append(("_id not the key", "_id", "error", total))

    known = [s for s in selection if s.name in present]
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"), *[_null_count(s.name).alias(f"_null_{s.name}") for s in known]
    )
    data = [
        ("null in NOT NULL column", s.name, "error", F.col(f"_null_{s.name}"))
        for s in known
        if s.nullable is False or s.primary_key
    ]

    def rows(items: list[tuple[str, str, str, Column]]) -> list[Column]:
        return [
            F.struct(
                F.lit(rule).alias("rule"), F.lit(c).alias("column"), F.lit(sev).alias("severity"), n.alias("violating_rows")
            )
            for rule, c, sev, n in items
        ]

    empty = F.from_json(F.lit("[]"), T.ArrayType(T.StructType.fromDDL(_FINDING)))
    found = F.array(*rows(static)) if static else empty
    violated = F.filter(F.array(*rows(data)), lambda f: f["violating_rows"] > 0) if data else empty
    findings = counts.select(F.inline(F.concat(found, violated)))

    keyed = [c for c in marked if c in present]
    if not keyed:
        return findings
    shared = (
        df.dropna(subset=keyed)
        .groupBy(*keyed)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violating_rows"))
        .filter("violating_rows > 0")
        .select(
            F.lit("duplicate key").alias("rule"),
            F.lit(",".join(keyed)).alias("column"),
            F.lit("error").alias("severity"),
            F.col("violating_rows").cast("long").alias("violating_rows"),
        )
    )
    return findings.unionByName(shared)
