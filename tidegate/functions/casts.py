"""Casting projections that keep the rows they cannot cast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .typemap import map_type, spark_type, split_target

REJECT = "reject_reason"
REJECT_ROW = "reject_row"


def cast_to_target(col: Column, target: str) -> Column:
    """``col`` as the target type; null where the value does not fit."""
    base, numbers = split_target(target)
    if base == "JSONB":
        return F.when(F.try_parse_json(col.cast("string")).isNotNull(), col.cast("string"))
    if base in ("BYTEA", "BIT"):
        # change feeds carry binary columns as base64 text
        return F.try_to_binary(col.cast("string"), F.lit("base64"))
    if base in ("VARCHAR", "CHAR", "CHARACTER", "CHARACTER VARYING") and numbers:
        text = col.cast("string")
        return F.when(F.char_length(text) <= numbers[0], text)
    if target.strip().endswith("[]"):
        return F.from_json(col.cast("string"), spark_type(target))
    return col.try_cast(spark_type(target))


def typed_projection(
    df: DataFrame,
    columns: Mapping[str, str],
    dialect: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Project ``columns`` to their types and name the ones that failed in ``reject_reason``.

    A failed row also carries its input values as JSON in ``reject_row``, so that it can be repaired and replayed.

    ``columns`` maps a column to its upstream type when ``dialect`` is given, else to a target type. A value that is
    present but does not fit marks the row; it never becomes a silent null.
    """
    targets = {c: map_type(dialect, t) if dialect else t for c, t in columns.items()}
    cast = df.select(
        *keep,
        *[F.col(c).alias(f"_in_{c}") for c in targets],
        *[cast_to_target(F.col(c), t).alias(c) for c, t in targets.items()],
    )
    failed = F.array_compact(
        F.array(*[F.when(F.col(f"_in_{c}").isNotNull() & F.col(c).isNull(), F.lit(c)) for c in targets])
    )
    reason = F.when(F.size(failed) > 0, F.concat(F.lit("cast failed: "), F.array_join(failed, ",")))
    inputs = F.struct(*[F.col(f"_in_{c}").alias(c) for c in targets])
    return cast.select(
        *keep, *targets, reason.alias(REJECT), F.when(reason.isNotNull(), F.to_json(inputs)).alias(REJECT_ROW)
    )


def split_rejects(df: DataFrame, reason: str = REJECT) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the reject columns, rejected rows with them)."""
    return df.filter(F.col(reason).isNull()).drop(reason, REJECT_ROW), df.filter(F.col(reason).isNotNull())
