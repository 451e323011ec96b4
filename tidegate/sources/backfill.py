"""Initial snapshots read in parallel splits of a key column."""

from __future__ import annotations

import datetime
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .config import DatabaseSource


@dataclass(frozen=True)
class SplitPlan:
    """Even splits of an integer key: ``splits`` ranges of ``width`` keys from ``lower``."""

    column: str
    lower: int
    upper: int
    splits: int

    @property
    def width(self) -> int:
        return max(1, math.ceil((self.upper - self.lower + 1) / self.splits))

    def split_of(self) -> Column:
        """The split a row belongs to; a null key belongs to the first."""
        # whole numbers all the way: a double has too few digits for large keys
        offset = F.col(self.column).cast("bigint") - F.lit(self.lower)
        whole = offset - F.pmod(offset, F.lit(self.width))
        return F.coalesce(F.call_function("div", whole, F.lit(self.width)).cast("int"), F.lit(0))

    def predicates(self) -> list[str]:
        """One SQL condition per split; together they take every row once, null keys included."""
        c, edges = self.column, [self.lower + i * self.width for i in range(1, self.splits)]
        return range_predicates(c, edges)


def split_count(rows: int, rows_per_split: int) -> int:
    if rows_per_split <= 0:
        raise ValueError("rows_per_split must be positive")
    return max(1, math.ceil(rows / rows_per_split))


def sql_literal(value: object) -> str:
    """A key value as SQL text: quotes doubled, dates and times typed."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, edges: list) -> list[str]:
    """Conditions for the ranges between ``edges``; the first also takes nulls."""
    if not edges:
        return ["1 = 1"]
    text = [sql_literal(e) for e in edges]
    first = f"({column} < {text[0]} OR {column} IS NULL)"
    middle = [f"({column} >= {a} AND {column} < {b})" for a, b in zip(text, text[1:])]
    return [first, *middle, f"{column} >= {text[-1]}"]


def key_bounds(df: DataFrame, column: str) -> tuple[object, object, int]:
    """Least and greatest key, and the number of rows, from one aggregate."""
    lower, upper, rows = df.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    return lower, upper, rows


def plan_even_splits(df: DataFrame, column: str, rows_per_split: int) -> SplitPlan:
    """Equal ranges of an integer key from one aggregate over the table."""
    lower, upper, rows = key_bounds(df, column)
    if lower is None:
        return SplitPlan(column, 0, 0, 1)
    if isinstance(lower, (datetime.date, str)):
        raise TypeError(f"{column} is not a whole number; split it at uneven_edges")
    return SplitPlan(column, int(lower), int(upper), split_count(rows, rows_per_split))


def uneven_edges(df: DataFrame, column: str, rows_per_split: int, accuracy: int | None = None) -> list:
    """Range edges holding about ``rows_per_split`` rows each, for keys that are not spread evenly; dates and times too.

    The accuracy of the quantiles follows the number of splits, so that neighbouring edges stay apart. A key value with
    more rows than a split makes one larger split, for equal keys cannot be told apart by ranges.
    """
    n = split_count(df.count(), rows_per_split)
    if n == 1:
        return []
    shares = [i / n for i in range(1, n)]
    edges = df.agg(F.percentile_approx(column, shares, accuracy or max(10_000, 10 * n))).first()[0] or []
    return sorted(set(edges))


def _between(column: str, low: object, past: object) -> str:
    """Condition of the keys from ``low`` on and below ``past``; None stands for no bound."""
    parts = [f"{column} >= {sql_literal(low)}"] * (low is not None) + [f"{column} < {sql_literal(past)}"] * (past is not None)
    return " AND ".join(parts) or f"{column} IS NOT NULL"


def uneven_predicates(df: DataFrame, column: str, rows_per_split: int, second: str | None = None) -> list[str]:
    """Conditions that take every row once, nulls included, of about ``rows_per_split`` rows each; for keys as in ``uneven_edges``.

    Edges are quantiles of the key, which tasks sketch for the rows they read and merge. A key value, or null, with more rows
    than a split gets conditions of its own, by ranges of the ``second`` column. There are some two conditions for each
    split, and one aggregate for each value that a split's worth of rows share.
    """
    edges = uneven_edges(df, column, rows_per_split)
    crowded = df.filter(F.col(column).isNull() | F.col(column).isin(*edges)).groupBy(column).count()
    hot = [r[0] for r in crowded.filter(F.col("count") > rows_per_split).collect()] if second else []
    values = sorted(v for v in hot if v is not None)
    cuts = sorted({*edges, *values})
    out = []
    for low, past in zip([None, *cuts], [*cuts, None]):
        condition = _between(column, low, past)
        out.append(f"({condition} AND {column} <> {sql_literal(low)})" if low in values else f"({condition})")
    taken = {v: f"{column} = {sql_literal(v)}" for v in values} | {None: f"{column} IS NULL"}
    for v, condition in taken.items():
        inner: list = []
        if v in hot:
            inner = uneven_edges(df.filter(F.col(column).isNull() if v is None else F.col(column) == F.lit(v)), second, rows_per_split)
        if not inner:
            out.append(f"({condition})")
            continue
        ranges = [_between(second, low, past) for low, past in zip([None, *inner], [*inner, None])]
        out += [f"({condition} AND {r})" for r in ranges[1:]] + [f"({condition} AND ({ranges[0]} OR {second} IS NULL))"]
    return out


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    rows_per_split: int,
    even: bool = True,
    fetch_size: int = 1000,
    parallelism: int | None = None,
    edges: list | None = None,
    second: str | None = None,
    **options: str,
) -> DataFrame:
    """A database table in one task per split, or in ``parallelism`` tasks that read their splits one after another.

    Even bounds are computed inside the database by a pushed-down aggregate, for whole numbers, dates and times. For
    uneven ranges the caller may give ``edges``, from a query of the database's own; without them the key column is read
    in even ranges, each task sketching its own, to find quantiles, and values with more rows than a split are split by the
    ``second`` column.
    """
    properties = {"fetchsize": str(fetch_size), **options}
    whole = spark.read.format("jdbc").options(url=url, dbtable=table, pushDownAggregate="true", **properties).load()

    def ranged() -> DataFrame:
        """The table in even ranges of the key; text has none and is read in one task."""
        lower, upper, n = key_bounds(whole, column)
        if lower is None or isinstance(lower, str):
            return spark.read.jdbc(url, table, properties=properties)
        return spark.read.jdbc(
            url,
            table,
            column=column,
            lowerBound=str(lower),
            upperBound=str(upper + 1 if isinstance(upper, int) else upper),
            numPartitions=split_count(n, rows_per_split),
            properties=properties,
        )

    if even:
        rows = ranged()
    else:
        columns = [column, *([second] if second else [])]
        found = uneven_predicates(ranged().select(*columns), column, rows_per_split, second) if edges is None else range_predicates(column, edges)
        rows = spark.read.jdbc(url, table, predicates=found, properties=properties)
    return rows.coalesce(parallelism) if parallelism else rows


def read_snapshot(
    spark: SparkSession, source: DatabaseSource, url: str, table: str, column: str, condition: str | None = None
) -> DataFrame:
    """The snapshot of one captured table with the source's own split, parallelism and fetch settings.

    With ``condition`` only the rows it holds for: a chunk of ``Ingest.load``.
    """
    if condition:
        table = f"(SELECT * FROM {table} WHERE {condition}) AS chunk"
    if not source.rows_per_split:
        options = {"fetchsize": str(source.snapshot_batch_size), **source.options}
        return spark.read.jdbc(url, table, properties=options)
    return read_jdbc_snapshot(
        spark,
        url,
        table,
        column,
        source.rows_per_split,
        source.even_splits,
        source.snapshot_batch_size,
        source.parallelism,
        **source.options,
    )
