"""Which tables and which columns of a feed are taken.

Table selection filters the rows of a multi-table feed by its schema and table columns, on the executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import typed_projection

DEFAULT_SCHEMA = "public"


@dataclass(frozen=True)
class ColumnSelection:
    """One selected column; unset overrides keep the upstream value."""

    name: str
    target_type: str | None = None
    primary_key: bool = False
    nullable: bool | None = None


@dataclass(frozen=True)
class TableColumns:
    """Columns to take from a table (None: all) and the name of the table they go to."""

    table: str
    columns: tuple[ColumnSelection, ...] | None = None
    target_table: str | None = None

    @property
    def target(self) -> str:
        return self.target_table or self.table

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns or () if c.primary_key]

    def project(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """The selected columns, cast where a type is given; failed casts are named in ``reject_reason``."""
        if self.columns is None:
            return df
        typed = {c.name: c.target_type for c in self.columns if c.target_type}
        plain = tuple(c.name for c in self.columns if not c.target_type)
        if not typed:
            return df.select(*keep, *plain)
        cast = typed_projection(df, typed, keep=(*keep, *plain))
        return cast.select(*keep, *[c.name for c in self.columns], "reject_reason", "reject_row")


def project_columns(df: DataFrame, include: Sequence[str] | None = None, exclude: Iterable[str] = ()) -> DataFrame:
    """Included columns (all when None) minus the excluded ones; an excluded column never comes back."""
    wanted, unwanted = set(include or df.columns), set(exclude)
    unknown = wanted - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    return df.select(*[c for c in df.columns if c in wanted and c not in unwanted])


def glob_regex(pattern: str) -> str:
    """A shell glob (``*``, ``?``, ``[ab]``, ``[!ab]``) as a Java regex for the whole lower-cased name.

    ``*`` also matches dots. An unclosed ``[`` stands for itself.
    """
    out, rest = "", pattern.lower()
    while rest:
        if cls := re.match(r"\[(!?)(\]?[^\]]*)\]", rest):
            members = re.sub(r"([\\\[\]^&~|])", r"\\\1", cls.group(2))
            out += f"[{'^' if cls.group(1) else ''}{members}]"
            rest = rest[cls.end() :]
        else:
            out += {"*": ".*", "?": "."}.get(rest[0]) or re.sub(r"([^\w\s])", r"\\\1", rest[0])
            rest = rest[1:]
    return rf"^(?s:{out})\z"


def _any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


@dataclass(frozen=True)
class TableSelector:
    """Tables by name or glob.

    ``specific`` wins over everything and ignores ``exclude``. Otherwise ``include`` globs (or everything with
    ``include_all``) are taken and ``exclude`` globs removed. A name matches qualified or bare, in any case for globs.
    """

    include_all: bool = False
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    specific: tuple[str, ...] = field(default=())

    def condition(self, schema: str = "schema", table: str = "table") -> Column:
        """Row condition of the globs."""
        qualified = F.concat_ws(".", F.col(schema), F.col(table))

        def matches(patterns: tuple[str, ...]) -> Column:
            regexes = [glob_regex(p) for p in patterns]
            return _any_of(
                [F.lower(name).rlike(r) for r in regexes for name in (qualified, F.col(table))]
            )

        taken = F.lit(True) if self.include_all else matches(self.include)
        return taken & ~matches(self.exclude) if self.exclude else taken

    def select(
        self,
        feed: DataFrame,
        schema: str = "schema",
        table: str = "table",
        known: Sequence[tuple[str, str]] | None = None,
    ) -> DataFrame:
        """Rows of the selected tables.

        Specific names are looked up among the ``known`` (schema, table) pairs, or in the feed itself when it is not a
        stream; a stream needs ``known``, for a bare name must mean the same table in every batch.
        """
        if not self.specific:
            return feed.filter(self.condition(schema, table))
        if known is None:
            return select_specific(feed, self.specific, schema, table)
        hits = [next((k for k in known if n in (k[1], ".".join(k))), None) for n in self.specific]
        return feed.filter(tables_condition([h for h in hits if h], schema, table))


def pattern_condition(
    patterns: str, default_schema: str, schema: str = "schema", table: str = "table"
) -> Column:
    """``"db1.*, db2.orders, users"``: whole schemas, named tables, bare names in the default schema."""
    conditions = []
    for item in (p.strip() for p in patterns.split(",")):
        if not item:
            continue
        owner, dot, name = item.partition(".")
        if not dot:
            owner, name = default_schema, item
        same = F.col(schema) == owner
        conditions.append(same if name == "*" else same & (F.col(table) == name))
    return _any_of(conditions)


def _requested(feed: DataFrame, names: Sequence[str]) -> DataFrame:
    # as long as the caller's own list, so it may be broadcast
    items = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("requested")) for i, n in enumerate(names)])
    return feed.sparkSession.range(1).select(F.inline(items))


def _table_counts(feed: DataFrame, schema: str, table: str) -> DataFrame:
    return feed.groupBy(F.col(schema).alias("schema"), F.col(table).alias("table")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def resolve_specific(
    feed: DataFrame, names: Sequence[str], schema: str = "schema", table: str = "table"
) -> DataFrame:
    """One row per requested name, order and duplicates kept: ``position, requested, schema, table, rows, found``.

    A name matches qualified or bare; of several tables with the bare name the first by (schema, table) is taken. A
    name nothing matches gets a placeholder with no rows: the text before the first dot is its schema.
    """
    # one row per table of the feed under each of its two names: joined on equality, never on OR
    named = _table_counts(feed, schema, table).select(
        "schema",
        "table",
        "rows",
        F.explode(F.array_distinct(F.array(F.concat_ws(".", "schema", "table"), F.col("table")))).alias("requested"),
    )
    first = named.groupBy("requested").agg(F.min(F.struct("schema", "table", "rows")).alias("hit"))
    dot = F.instr("requested", ".")
    owner = F.when(dot > 0, F.substring_index("requested", ".", 1)).otherwise(F.lit(DEFAULT_SCHEMA))
    name = F.when(dot > 0, F.expr("substring(requested, instr(requested, '.') + 1)")).otherwise(F.col("requested"))
    return F.broadcast(_requested(feed, names)).join(first, "requested", "left").select(
        "position",
        "requested",
        F.coalesce("hit.schema", owner).alias("schema"),
        F.coalesce("hit.table", name).alias("table"),
        F.coalesce("hit.rows", F.lit(0).cast("long")).alias("rows"),
        F.col("hit").isNotNull().alias("found"),
    )


def tables_condition(
    tables: Iterable[tuple[str, str]], schema: str = "schema", table: str = "table"
) -> Column:
    """Rows of exactly these (schema, table) pairs."""
    return _any_of([(F.col(schema) == s) & (F.col(table) == t) for s, t in tables])


def select_specific(
    feed: DataFrame, names: Sequence[str], schema: str = "schema", table: str = "table"
) -> DataFrame:
    """Rows of the tables the requested names resolve to, each row once.

    At most as many tables as names come back to the driver, so that the choice is a filter the scan can use.
    """
    chosen = resolve_specific(feed, names, schema, table).filter("found").select("schema", "table").distinct().collect()
    return feed.filter(tables_condition([(r.schema, r.table) for r in chosen], schema, table))


def missing_tables(
    feed: DataFrame, names: Sequence[str], schema: str = "schema", table: str = "table"
) -> DataFrame:
    """Requested names no table of the feed answers to."""
    return resolve_specific(feed, names, schema, table).filter(~F.col("found")).select("requested").distinct()


def require_tables(feed: DataFrame, names: Sequence[str], schema: str = "schema", table: str = "table") -> None:
    """Raise with every missing name at once."""
    missing = sorted(r.requested for r in missing_tables(feed, names, schema, table).collect())
    if missing:
        raise ValueError(f"tables not found in the feed: {', '.join(missing)}")
