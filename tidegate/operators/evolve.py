"""Columns that appear, disappear or widen between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_WHOLE_DIGITS = {"ByteType": 3, "ShortType": 5, "IntegerType": 10, "LongType": 19}
_FLOATING = (T.FloatType, T.DoubleType)


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Smallest type that holds every value of both unchanged; text when none does.

    A double holds whole numbers of 32 bits and less, and no decimals, whose fractions it would round.
    """
    if a == b:
        return a
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if a in _WHOLE and b in _WHOLE:
            return _WHOLE[max(_WHOLE.index(a), _WHOLE.index(b))]
        floating = [isinstance(t, _FLOATING) for t in (a, b)]
        if any(floating):
            other = b if floating[0] else a
            exact = all(floating) or isinstance(other, (T.ByteType, T.ShortType, T.IntegerType))
            return T.DoubleType() if exact else T.StringType()
        whole, scale = zip(*[_digits(t) for t in (a, b)])
        total = max(whole) + max(scale)
        return T.DecimalType(total, max(scale)) if total <= 38 else T.StringType()
    pair = {type(a), type(b)}
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if pair <= {T.DateType, T.TimestampNTZType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def _digits(t: T.DataType) -> tuple[int, int]:
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return _WHOLE_DIGITS[type(t).__name__], 0


def evolved_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of ``old`` in order, then those only ``new`` has; shared columns take the wider type."""
    incoming = {f.name: f.dataType for f in new}
    fields = [T.StructField(f.name, wider_type(f.dataType, incoming.get(f.name, f.dataType))) for f in old]
    known = {f.name for f in old}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new if f.name not in known])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; a column it lacks is null."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both batches under the evolved schema. A column the new batch dropped stays, as null."""
    schema = evolved_schema(old.schema, new.schema)
    return conform(old, schema).unionByName(conform(new, schema))
