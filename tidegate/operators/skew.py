"""Shuffles by a key that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Rows one task should take for a single key before the key is split.
ROWS_PER_TASK = 5_000_000

_SALT = "_salt"
_SALTS = "_salts"


def _hot_keys(keys: DataFrame, on: list[str], rows: str, rows_per_task: int) -> DataFrame:
    # At most total rows / rows_per_task keys can pass this filter, which bounds what is broadcast below.
    return keys.filter(F.col(rows) > rows_per_task).select(
        *on, F.ceil(F.col(rows) / rows_per_task).cast("int").alias(_SALTS)
    )


def salt_hot_keys(
    df: DataFrame, keys: DataFrame, on: list[str], rows: str, spread_by: list[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add ``_salt``: 0 for ordinary keys, a hash of ``spread_by`` over enough values for the hot ones.

    ``keys`` has one row per key with its row count in ``rows``. The salt is a function of the row alone, so a
    retried task sends every row to the same place.
    """
    hot = F.broadcast(_hot_keys(keys, on, rows, rows_per_task))
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col(_SALTS), F.lit(1)).cast("long"))
    return df.join(hot, on, "left").withColumn(_SALT, salt).drop(_SALTS)


def join_by_key(
    df: DataFrame,
    keys: DataFrame,
    on: list[str],
    rows: str,
    spread_by: list[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``df`` joined with ``keys``, one row per key with its row count; a hot key is spread over several tasks."""
    salted = salt_hot_keys(df, keys, on, rows, spread_by, rows_per_task)
    last = F.greatest(F.ceil(F.col(rows) / rows_per_task).cast("long"), F.lit(1).cast("long")) - 1
    salted_keys = keys.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias(_SALT))
    return salted.join(salted_keys, [*on, _SALT], how).drop(_SALT)


# Rows of a piece that a task sorts at once, and the most pieces that a shuffle writes without sorting them itself.
ROWS_PER_PIECE = 250_000
MOST_PIECES = 200


def dealt(df: DataFrame, same: list[str], rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """The rows in pieces of some ``rows_per_piece``, if a partition of ``df`` has more; else ``df`` as it is.

    A file's bytes don't tell how many rows a task gets of it: dense columns hold millions in few megabytes. The rows are
    counted without their columns, then dealt by a hash of the columns ``same`` and of the partition they came from, so that
    repeats of a row are spread as they were and a retried task sends every row to the same place. Pieces of more than
    ``rows_per_piece * MOST_PIECES`` rows grow with them.
    """
    found = df.groupBy(F.spark_partition_id().alias("_p")).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("n")).first()
    if (found["most"] or 0) <= rows_per_piece:
        return df
    pieces = max(-(-found["n"] // rows_per_piece), df.sparkSession.sparkContext.defaultParallelism)
    placed = df.withColumn("_from", F.spark_partition_id())
    return placed.repartition(min(pieces, MOST_PIECES), *same, "_from").drop("_from")


def bring_together(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows of one key in as few tasks as their size allows, by one shuffle and no scan for counting.

    The adaptive planner splits a partition that is too large for one task and joins those that are too small.
    """
    return df.hint("rebalance", *[F.col(c) for c in on])
