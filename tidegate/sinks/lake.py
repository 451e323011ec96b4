"""Lake tables: append, upsert, exactly-once batches, versions, compaction, expiration.

A catalog with row-level operations takes ``MERGE INTO``. Without one the table is merge-on-read: every batch of
changes is one Parquet partition, a base holds the folded rows in buckets of the key, and reading merges what batches came
after. Folded changes keep their order keys and tombstones, so a change that arrives after a compaction still loses to a
later one.

    <path>/tier=delta/writer=<name>/batch=<id>/                   one partition per delivered batch
    <path>/tier=base/writer=main/batch=<number>/key_bucket=<b>/   the buckets that the fold of that number rewrote
    <path>/_parts/<tier>@<writer>@<batch>@<schema>@<buckets>@<version>   marks a complete batch or base
    <path>/_folds/<number>/<name>@<id>                        the last batch of each writer in a base
    <path>/_schemas/<number>                                  every schema that rows were written under
    <path>/_layout/<buckets>, _expired/<version>, _pins/...   bucket count, oldest readable version, readers

A batch names the buckets it touches. A fold rewrites those only, the files of all others stay where they are, and a read
merges those only: base rows of other buckets are passed on as they are stored. Merging is a join with the changes, one
for each key at most, so it moves no base row where the planner can send the changes to the tasks, and reads no column but
the keys, the order and what is asked for.

Batch ids belong to their writer: a snapshot, a stream and a stream restarted with a new checkpoint deliver under names of
their own, so none replaces or hides what another wrote. Every completed batch or fold is a version; ``read(as_of=...)``
returns the state at one, until ``expire`` gives it up.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, Window, functions as F, types as T

from ..operators.changes import DELETE, collapse, to_append_only, unkeyed
from ..operators.evolve import conform, evolved_schema, wider_type
from ..operators.observe import observed
from ..operators.skew import bring_together
from . import paths
from .config import LakeSink

MAIN = "main"
BUCKETS = 16


@dataclass(frozen=True)
class Part:
    """A complete batch (``delta``, or ``rows`` without keys) or fold (``base``), as its mark names it."""

    tier: str
    writer: str
    batch: int
    schema: int
    buckets: frozenset[int]
    version: int

    @property
    def mark(self) -> str:
        bits = sum(1 << b for b in self.buckets)
        return f"{self.tier}@{self.writer}@{self.batch}@{self.schema}@{bits:x}@{self.version}"

    @property
    def folder(self) -> str:
        below = f"writer={self.writer}/batch={self.batch}"
        return below if self.tier == "rows" else f"tier={self.tier}/{below}"

    @classmethod
    def of(cls, mark: str) -> Part | None:
        m = re.fullmatch(r"(delta|base|rows)@([^@]+)@(-?\d+)@(\d+)@([0-9a-f]+)@(\d+)", mark)
        if not m:
            return None
        bits = int(m[5], 16)
        buckets = frozenset(b for b in range(bits.bit_length()) if bits >> b & 1)
        return cls(m[1], m[2], int(m[3]), int(m[4]), buckets, int(m[6]))


@dataclass(frozen=True)
class State:
    """What a version consists of: the base number that holds each bucket, and the batches to merge."""

    base: dict[int, Part]
    deltas: list[Part]


class BatchTable:
    """Rows in batches: one Parquet partition for each, marked when it is complete, with the schema it was written under.

    Rows are read under the schema they were written under, then cast to the table's: the declared ``schema``, or all columns
    ever written, each of a type that holds all its values. ``auto_schema_change=False`` refuses batches with other columns
    or types than the table has.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | None = None, auto_schema_change: bool = True
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.auto_schema_change = auto_schema_change
        self._logged: dict[int, T.StructType] = {}

    def append(self, rows: DataFrame, batch_id: int, writer: str = MAIN) -> None:
        """Append one batch; the same id from the same writer again replaces it."""
        schema = self._schema_number(rows.schema)
        overwrite(rows.withColumns(placed(batch_id, writer)).write, self.path, "writer", "batch")
        self._mark("rows", batch_id, writer, schema, frozenset([0]))

    def rows(self, before: tuple[str, int] | None = None) -> DataFrame:
        """Rows of all batches; with ``before`` those of that writer below that batch id only."""
        return self._live([p for p in self._parts() if p.tier == "rows" and (before is None or (p.writer, p.batch) < before and p.writer == before[0])])

    def batch(self, batch_id: int, writer: str = MAIN) -> DataFrame:
        """Rows of one batch."""
        return self._live([p for p in self._parts() if (p.tier, p.batch, p.writer) == ("rows", batch_id, writer)])

    def settled(self) -> DataFrame:
        """Rows of all batches but the newest of each writer, which may be replayed."""
        batches = [p for p in self._parts() if p.tier == "rows"]
        return self._live([p for p in batches if p.batch < max(o.batch for o in batches if o.writer == p.writer)])

    def _live(self, batches: list[Part]) -> DataFrame:
        """Rows of the newest fold and of those batches that it doesn't hold."""
        schemas = self._schemas()
        base = max((p for p in self._parts() if p.tier == "base"), key=lambda p: p.batch, default=None)
        folded = self._folded(base.batch if base else None)
        live = ([base] if base else []) + [p for p in batches if p.batch > folded.get(p.writer, p.batch - 1)]
        # A batch without rows has no folder.
        there = [p for p in live if paths.exists(self.spark, f"{self.path}/{p.folder}")]
        return self._files({p.folder: p.schema for p in there}, self.columns(schemas), schemas)

    def fold(self, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Replace all batches but the newest of each writer, which may be replayed, by ``combine`` of their rows."""
        parts = self._parts()
        batches = [p for p in parts if p.tier == "rows"]
        newest = {w: max(p.batch for p in batches if p.writer == w) for w in {p.writer for p in batches}}
        old = [p for p in batches if p.batch < newest[p.writer]]
        number = max((p.batch for p in parts if p.tier == "base"), default=-1)
        folded = self._folded(number)
        if not [p for p in old if p.batch > folded.get(p.writer, p.batch - 1)]:
            return
        rows = combine(self._live(old))
        schema = self._schema_number(rows.schema)
        overwrite(rows.withColumns({"tier": F.lit("base"), **placed(number + 1, MAIN)}).write, self.path, "tier", "writer", "batch")
        for p in old:
            folded[p.writer] = max(p.batch, folded.get(p.writer, -1))
        for name, last in folded.items():
            paths.touch(self.spark, f"{self.path}/_folds/{number + 1}/{name}@{last}")
        self._mark("base", number + 1, MAIN, schema, frozenset([0]))
        for p in parts:
            if p in old or p.tier == "base":
                paths.delete(self.spark, f"{self.path}/_parts/{p.mark}")
                paths.delete(self.spark, f"{self.path}/{p.folder}")

    def _folded(self, base: int | None) -> dict[str, int]:
        """The last batch of each writer that a base holds."""
        out: dict[str, int] = {}
        for mark in paths.names(self.spark, f"{self.path}/_folds/{base}") if base is not None else ():
            name, at, last = mark.rpartition("@")
            if at and last.isdigit():
                out[name] = max(int(last), out.get(name, -1))
        return out

    def forget(self, keep: int) -> None:
        """Drop all but the newest ``keep`` batches of each writer."""
        batches = [p for p in self._parts() if p.tier == "rows"]
        for writer in {p.writer for p in batches}:
            for p in sorted((p for p in batches if p.writer == writer), key=lambda p: p.batch)[: -keep or None]:
                paths.delete(self.spark, f"{self.path}/_parts/{p.mark}")
                paths.delete(self.spark, f"{self.path}/{p.folder}")

    def batch_before(self, seconds: float, writer: str = MAIN) -> int:
        """The newest batch id of a writer that is older than so many seconds; -1 if none is."""
        at = (time.time() - seconds) * 1000
        return max((p.batch for p in self._parts() if p.tier == "rows" and p.writer == writer and p.version <= at), default=-1)

    def _mark(self, tier: str, batch_id: int, writer: str, schema: int, touched: frozenset[int]) -> None:
        """Mark a batch complete. A replay keeps the version of the first time and replaces its mark."""
        parts = self._parts()
        same = [p for p in parts if (p.tier, p.writer, p.batch) == (tier, writer, batch_id)]
        version = same[0].version if same else max([int(time.time() * 1000), *(p.version + 1 for p in parts)])
        part = Part(tier, writer, batch_id, schema, touched, version)
        paths.touch(self.spark, f"{self.path}/_parts/{part.mark}")
        for old in same:
            if old != part:
                paths.delete(self.spark, f"{self.path}/_parts/{old.mark}")

    def _schemas(self) -> dict[int, T.StructType]:
        """All logged schemas; each is read once, as it never changes."""
        root = f"{self.path}/_schemas"
        for n in sorted(int(n) for n in paths.names(self.spark, root) if n.isdigit()):
            if n not in self._logged:
                self._logged[n] = T.StructType.fromJson(paths.read_json(self.spark, f"{root}/{n}"))
        return dict(sorted(self._logged.items()))

    def _schema_number(self, schema: T.StructType) -> int:
        """The number under which a schema is logged; a new one is logged if the table may change."""
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        while True:
            known = self._schemas()
            for n, s in known.items():
                if s == plain:
                    return n
            if known and not self.auto_schema_change:
                old = self.columns(known)
                if evolved_schema(old, plain) != old:
                    raise ValueError(f"columns differ from the table's and it may not change: {plain.simpleString()}")
            number = max(known, default=-1) + 1
            if paths.write_new_json(self.spark, f"{self.path}/_schemas/{number}", plain.jsonValue()):
                return number

    def columns(self, known: dict[int, T.StructType] | None = None) -> T.StructType:
        """The table's columns: all that were ever written, in a type that holds every value."""
        schemas = list((self._schemas() if known is None else known).values())
        stored = reduce(evolved_schema, schemas) if schemas else T.StructType()
        if self.schema is None:
            return stored
        have = {f.name: f.dataType for f in stored}
        return T.StructType([T.StructField(f.name, wider_type(f.dataType, have.get(f.name, f.dataType))) for f in self.schema])

    def _parts(self, as_of: int | None = None) -> list[Part]:
        parts = [p for n in paths.names(self.spark, f"{self.path}/_parts") if (p := Part.of(n))]
        newest: dict[tuple, Part] = {}
        for p in sorted(parts, key=lambda p: p.version):
            if as_of is None or p.version <= as_of:
                newest[p.tier, p.writer, p.batch] = p
        return sorted(newest.values(), key=lambda p: (p.version, p.mark))

    def _files(self, folders: dict[str, int], schema: T.StructType, schemas: dict[int, T.StructType]) -> DataFrame:
        """Rows of folders, each read under its own schema and cast to the table's."""
        by_schema: dict[int, list[str]] = {}
        for folder, number in folders.items():
            by_schema.setdefault(number, []).append(f"{self.path}/{folder}")
        read = [conform(self.spark.read.schema(schemas[n]).parquet(*where), schema) for n, where in sorted(by_schema.items())]
        return reduce(DataFrame.unionByName, read) if read else self.spark.createDataFrame([], schema)


class LakeTable(BatchTable):
    """A merge-on-read table of changes keyed by ``pk`` and ordered by ``order_by``.

    ``buckets`` is fixed by the first batch. Changes with a null in the key or the order key can't be applied;
    ``append_batch`` keeps them in ``<path>_rejects``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        pk: Sequence[str],
        order_by: Sequence[str],
        op: str = "op",
        schema: T.StructType | None = None,
        buckets: int = BUCKETS,
        auto_schema_change: bool = True,
    ) -> None:
        if not pk or not order_by:
            raise ValueError("a primary key and an order are required to apply changes")
        super().__init__(spark, path, schema, auto_schema_change)
        self.pk, self.order_by, self.op, self._buckets = list(pk), list(order_by), op, buckets

    # -- writing

    def append_batch(self, changes: DataFrame, batch_id: int, writer: str = MAIN) -> None:
        """Deliver one batch. The same id from the same writer again replaces it, so a replay changes nothing."""
        keyless = Observation()
        reason = unkeyed(changes, self.pk, self.order_by)
        seen = changes.observe(keyless, F.count_if(reason.isNotNull()).alias("bad")).filter(reason.isNull())
        self._commit(collapse(seen, self.pk, self.order_by, self.op), "delta", batch_id, writer)
        if observed(keyless, lambda: {"bad": changes.filter(reason.isNotNull()).count()})["bad"]:
            bad = changes.withColumn("error", reason).filter("error IS NOT NULL")
            bad = bad.select(F.to_json(F.struct(*changes.columns)).alias("raw"), "error")
            append_partition(bad, f"{self.path}_rejects", batch_id, writer)

    def _commit(self, rows: DataFrame, tier: str, batch_id: int, writer: str = MAIN, also: Sequence[str] = ()) -> None:
        """Write rows, then mark them complete; ``also`` are paths of marks that have to be there before."""
        schema = self._schema_number(rows.schema)
        touched = self._write(rows, tier, batch_id, writer)
        for mark in also:
            paths.touch(self.spark, mark)
        self._mark(tier, batch_id, writer, schema, touched)

    def _write(self, rows: DataFrame, tier: str, batch_id: int, writer: str = MAIN) -> frozenset[int]:
        """The buckets that the written rows lie in."""
        found = Observation()
        located = rows.withColumn("key_bucket", self._bucket()).observe(found, *self._touched())
        located = located.withColumns({"tier": F.lit(tier), **placed(batch_id, writer)})
        if tier == "base":
            # Neighbouring keys lie together, so that a file's range of keys tells whether it is worth reading.
            located = located.sortWithinPartitions("key_bucket", *self.pk)
            filtered = [c for c in self.pk if isinstance(rows.schema[c].dataType, (T.IntegerType, T.LongType, T.StringType))]
            out = located.write.options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in filtered})
            overwrite(out, self.path, "tier", "writer", "batch", "key_bucket")
        else:
            overwrite(located.drop("key_bucket").write, self.path, "tier", "writer", "batch")
        return self._buckets_of(observed(found, dict))  # none where no row is left

    def _touched(self, name: str = "", condition: Column | None = None) -> list[Column]:
        """Aggregates over ``key_bucket`` that hold a bit for each bucket with rows."""
        mine = F.lit(True) if condition is None else condition
        bit = lambda w: F.when(mine & (F.floor(F.col("key_bucket") / 64) == w), F.expr("shiftleft(1L, key_bucket % 64)"))
        return [F.bit_or(bit(w)).alias(f"{name}w{w}") for w in range((self.buckets + 63) // 64)]

    def _buckets_of(self, values: dict, name: str = "") -> frozenset[int]:
        bits = [(values.get(f"{name}w{w}") or 0) & (2**64 - 1) for w in range((self.buckets + 63) // 64)]
        return frozenset(w * 64 + b for w, x in enumerate(bits) for b in range(64) if x >> b & 1)

    @property
    def buckets(self) -> int:
        """The table's bucket count: that of the first one to write."""
        root = f"{self.path}/_layout"
        there = [int(n) for n in paths.names(self.spark, root) if n.isdigit()]
        if not there:
            paths.touch(self.spark, f"{root}/{self._buckets}")
            there = [int(n) for n in paths.names(self.spark, root) if n.isdigit()]
        return min(there)

    def _bucket(self) -> Column:
        """By the key as text, so that a key keeps its bucket when its type is widened."""
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in self.pk]), F.lit(self.buckets)).cast("int")

    # -- reading

    def _state(self, parts: list[Part]) -> State:
        bases = sorted((p for p in parts if p.tier == "base"), key=lambda p: p.batch)
        base = {b: p for p in bases for b in p.buckets}
        folded = self._folded(bases[-1].batch if bases else None)
        deltas = [p for p in parts if p.tier == "delta" and p.buckets and p.batch > folded.get(p.writer, p.batch - 1)]
        return State(base, deltas)

    def versions(self) -> list[int]:
        """Versions that can be read, oldest first."""
        oldest = self._oldest()
        return [p.version for p in self._parts() if p.version >= oldest]

    def _oldest(self) -> int:
        return max((int(n) for n in paths.names(self.spark, f"{self.path}/_expired") if n.isdigit()), default=0)

    def changes(self) -> DataFrame:
        """Every stored change, deletes included: of all batches that are still there, and of the base."""
        schemas, parts = self._schemas(), self._parts()
        folders = {f"{p.folder}/key_bucket={b}": p.schema for b, p in self._state(parts).base.items()}
        folders |= {p.folder: p.schema for p in parts if p.tier == "delta" and p.buckets}
        return self._files(folders, self.columns(schemas), schemas)

    def read(self, columns: Sequence[str] | None = None, as_of: int | None = None, evolving: bool = True) -> DataFrame:
        """Current rows, or those of a version; with ``columns`` only these are read, beside key and order.

        A read that is not ``evolving`` takes the columns of the newest schema alone.
        """
        if as_of is not None and as_of < self._oldest():
            raise ValueError(f"version {as_of} was expired")
        rows = self._merged(self._state(self._parts(as_of)), evolving=evolving).filter(F.col(self.op) != DELETE).drop(self.op)
        return rows.select(*columns) if columns is not None else rows

    def _merged(self, state: State, touched_only: bool = False, evolving: bool = True) -> DataFrame:
        """The last change of every key, deletes included; of the buckets that batches touch or of all."""
        schemas = self._schemas()
        schema = self.columns(schemas if evolving else dict(list(schemas.items())[-1:]))
        touched = frozenset().union(*(p.buckets for p in state.deltas))
        of = lambda some: {f"{p.folder}/key_bucket={b}": p.schema for b, p in state.base.items() if some(b)}
        met = of(lambda b: b in touched)
        out = []
        if not touched_only and (rest := of(lambda b: b not in touched)):
            out.append(self._files(rest, schema, schemas))
        if state.deltas:
            found = self._files({p.folder: p.schema for p in state.deltas}, schema, schemas)
            last = self._last(found) if len(state.deltas) > 1 else found
            out += self._settle(self._files(met, schema, schemas), last) if met else [last]
        return reduce(DataFrame.unionByName, out) if out else self.spark.createDataFrame([], schema)

    def _order(self, rows: DataFrame | None = None) -> Column:
        of = (lambda c: rows[c]) if rows is not None else F.col
        return F.struct(*[of(c) for c in self.order_by], (of(self.op) == DELETE).alias("_is_delete"))

    def _last(self, changes: DataFrame) -> DataFrame:
        """The last change of each key. Tasks first keep one row per key of their own, so no key gathers in one task."""
        nth = Window.partitionBy(*self.pk).orderBy(self._order().desc())
        return changes.withColumn("__nth", F.row_number().over(nth)).filter("__nth = 1").drop("__nth")

    def _settle(self, base: DataFrame, last: DataFrame) -> list[DataFrame]:
        """The rows of a base that no change replaces, and the changes that no row of it outlives; a row per key on either side."""
        names = [f"__key_{c}" for c in self.pk]
        key = reduce(lambda a, b: a & b, [F.col(c) == F.col(n) for c, n in zip(self.pk, names)])
        of = lambda rows, order: rows.select(*[F.col(c).alias(n) for c, n in zip(self.pk, names)], self._order().alias(order))
        kept = base.join(of(last, "__theirs"), key & (F.col("__theirs") > self._order()), "left_anti")
        # Keys whose base row stays: few, found among the changes' keys without moving the base.
        outlived = of(last, "__theirs").join(
            base.select(*self.pk, self._order().alias("__mine")), key & (F.col("__mine") >= F.col("__theirs"))
        )
        return [kept, last.join(outlived.select(*names), key, "left_anti")]

    # -- upkeep

    def files(self) -> dict[int, frozenset[str]]:
        """Names of the base's files, by bucket."""
        base = self._state(self._parts()).base
        names = lambda b, p: paths.names(self.spark, f"{self.path}/{p.folder}/key_bucket={b}")
        return {b: frozenset(n for n in names(b, p) if n[0] not in "._") for b, p in base.items()}

    def _batches(self, tier: str) -> dict[str, list[int]]:
        """Batches of every writer."""
        out: dict[str, list[int]] = {}
        for p in sorted((p for p in self._parts() if p.tier == tier), key=lambda p: p.batch):
            out.setdefault(p.writer, []).append(p.batch)
        return out

    def _newest_base(self) -> int | None:
        return max((p.batch for p in self._parts() if p.tier == "base"), default=None)

    def compact(self) -> int | None:
        """Fold all batches present now into a new base, which rewrites the buckets they touch; returns the newest base's number."""
        parts = self._parts()
        newest = max((p.batch for p in parts if p.tier == "base"), default=None)
        state, folded = self._state(parts), self._folded(newest)
        last = dict(folded)
        for p in parts:
            if p.tier == "delta":
                last[p.writer] = max(p.batch, last.get(p.writer, -1))
        if not state.deltas:
            return newest
        number = max(0 if newest is None else newest + 1, *(p.batch for p in state.deltas))
        marks = [f"{self.path}/_folds/{number}/{name}@{batch_id}" for name, batch_id in last.items()]
        paths.delete(self.spark, f"{self.path}/_folds/{number}")  # of a fold that died
        self._commit(self._merged(state, touched_only=True), "base", number, also=marks)
        return number

    def expire(self, keep_batches: int = 0, before: int | None = None) -> list[int]:
        """Drop batches and bases that no version from ``before`` on needs, by default none but the newest version.

        Versions that readers have pinned stay as well, and the newest ``keep_batches`` batches of each writer. Returns the
        ids of the dropped batches. ``version_before`` turns an age into a version.
        """
        parts = self._parts()
        if not parts:
            return []
        horizon = min([parts[-1].version if before is None else before, *self._pinned()])
        # The state at the horizon, and all that came later.
        then = self._state([p for p in parts if p.version <= horizon])
        needed = {p for p in then.deltas} | {p for p in parts if p.version > horizon}
        for writer in {p.writer for p in parts if p.tier == "delta"} if keep_batches else ():
            needed |= set(sorted((p for p in parts if p.tier == "delta" and p.writer == writer), key=lambda p: p.batch)[-keep_batches:])
        live = self._state(parts)
        needed |= set(live.deltas)
        held = {(b, p.batch) for s in (then, live) for b, p in s.base.items()}
        paths.touch(self.spark, f"{self.path}/_expired/{horizon}")
        dropped = []
        for p in parts:
            if p.tier == "delta" and p not in needed:
                paths.delete(self.spark, f"{self.path}/_parts/{p.mark}")
                paths.delete(self.spark, f"{self.path}/{p.folder}")
                dropped.append(p.batch)
            elif p.tier == "base" and p not in needed:
                left = {b for b in p.buckets if (b, p.batch) in held}
                for gone in [f"key_bucket={b}" for b in p.buckets - left] if left else [""]:
                    paths.delete(self.spark, f"{self.path}/{p.folder}/{gone}".rstrip("/"))
                if not left:
                    paths.delete(self.spark, f"{self.path}/_parts/{p.mark}")
                    paths.delete(self.spark, f"{self.path}/_folds/{p.batch}")
        return sorted(dropped)

    def version_before(self, seconds: float) -> int:
        """The version that was current so many seconds ago, the oldest one there is if none was."""
        at = int((time.time() - seconds) * 1000)
        versions = self.versions()
        return max((v for v in versions if v <= at), default=versions[0] if versions else 0)

    @contextmanager
    def pinned(self, as_of: int | None = None, seconds: float = 86_400) -> Iterator[DataFrame]:
        """Rows of a version, by default the newest, that no expiration takes while the block runs, for ``seconds`` at most."""
        parts = self._parts()
        version = as_of if as_of is not None else parts[-1].version if parts else 0
        pin = f"{self.path}/_pins/{uuid.uuid4().hex}@{version}@{int((time.time() + seconds) * 1000)}"
        paths.touch(self.spark, pin)
        try:
            yield self.read(as_of=version)
        finally:
            paths.delete(self.spark, pin)

    def _pinned(self) -> list[int]:
        pins = [n.split("@") for n in paths.names(self.spark, f"{self.path}/_pins")]
        return [int(p[1]) for p in pins if len(p) == 3 and int(p[2]) > time.time() * 1000]


def append_tables(changes: DataFrame, tables: dict[str, LakeTable], batch_id: int, writer: str = MAIN) -> None:
    """Deliver one batch to tables of equal key, order and columns, by one write.

    ``table`` names each row's table; that of a name has its path at ``table=<name>`` below one folder. Rows of several tables
    are brought together by table, so tasks leave few files in each; those of a single one are written where they are. Every
    table's part of the batch is then marked on its own, and the same batch again replaces it.
    """
    one = next(iter(tables.values()))
    (root,) = {t.path.removesuffix(f"/table={name}") for name, t in tables.items()}
    named = changes.filter(F.col("table").isin(*tables))
    if len(tables) == 1:
        last = collapse(named.drop("table"), one.pk, one.order_by, one.op).withColumn("table", F.lit(next(iter(tables))))
    else:
        last = collapse(named, ["table", *one.pk], one.order_by, one.op)
    schema = T.StructType([f for f in last.schema if f.name != "table"])
    numbers = {name: t._schema_number(schema) for name, t in tables.items()}
    found = Observation()
    bits = [c for i, (name, t) in enumerate(tables.items()) for c in t._touched(f"t{i}", F.col("table") == name)]
    buckets = reduce(lambda out, nt: F.when(F.col("table") == nt[0], nt[1]._bucket()).otherwise(out), tables.items(), F.lit(0))
    located = last.withColumn("key_bucket", buckets).observe(found, *bits).drop("key_bucket")
    located = located if len(tables) == 1 else bring_together(located, ["table"])
    located = located.withColumns({"tier": F.lit("delta"), **placed(batch_id, writer)})
    overwrite(located.write, root, "table", "tier", "writer", "batch")
    values = observed(found, dict)  # none where no row is left
    for i, (name, t) in enumerate(tables.items()):
        t._mark("delta", batch_id, writer, numbers[name], t._buckets_of(values, f"t{i}"))


def placed(batch_id: int, writer: str) -> dict[str, Column]:
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_-]*", writer):
        raise ValueError(f"a writer's name begins with a letter, then has letters, digits, _ or -: {writer!r}")
    return {"writer": F.lit(writer), "batch": F.lit(batch_id).cast("long")}


def overwrite(out: DataFrameWriter, path: str, *partitions: str) -> None:
    """Replace the partitions that the rows have."""
    out.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def writer_of(checkpoint: str) -> str:
    """The writer's name of a stream: a new checkpoint, which counts its batches anew, is a new writer."""
    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def append_partition(rows: DataFrame, path: str, batch_id: int, writer: str = MAIN) -> None:
    """Append one batch of plain rows; the same id from the same writer again replaces it."""
    BatchTable(rows.sparkSession, path).append(rows, batch_id, writer)


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all batches, whatever columns and types each has."""
    return BatchTable(spark, path).rows()


def merge_sql(
    target: str,
    view: str,
    columns: Sequence[str],
    pk: Sequence[str],
    op: str = "op",
    order_by: Sequence[str] = (),
    tombstone: str | None = None,
) -> str:
    """``MERGE INTO`` for catalogs with row-level operations.

    With ``order_by`` columns, kept in the target, only a later change touches a row, whatever order batches come in. With
    ``tombstone``, a boolean column of the target, a deleted key stays as a row for which it is true, so that this holds for
    changes older than a delete as well.
    """
    on = " AND ".join(f"t.`{c}` = s.`{c}`" for c in pk)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c not in pk)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    later = f" AND ({_later('s', 't', order_by)})" if order_by else ""
    if tombstone:
        gone = f"s.`{op}` = '{DELETE}'"
        return (
            f"MERGE INTO {target} t USING {view} s ON {on} "
            f"WHEN MATCHED{later} THEN UPDATE SET {', '.join(filter(None, [sets, f't.`{tombstone}` = {gone}']))} "
            f"WHEN NOT MATCHED THEN INSERT ({names}, `{tombstone}`) VALUES ({values}, {gone})"
        )
    update = f"WHEN MATCHED{later} THEN UPDATE SET {sets} " if sets else ""
    return (
        f"MERGE INTO {target} t USING {view} s ON {on} "
        f"WHEN MATCHED AND s.`{op}` = '{DELETE}'{later} THEN DELETE {update}"
        f"WHEN NOT MATCHED AND s.`{op}` <> '{DELETE}' THEN INSERT ({names}) VALUES ({values})"
    )


def _later(a: str, b: str, order_by: Sequence[str]) -> str:
    """Whether ``a`` comes after ``b`` in the order of the columns; a row without an order comes first."""
    first, *rest = order_by
    x, y = f"{a}.`{first}`", f"{b}.`{first}`"
    tie = f" OR ({x} = {y} AND ({_later(a, b, rest)}))" if rest else f" OR {x} = {y}"
    return f"{y} IS NULL OR {x} > {y}{tie}"


def append_table(df: DataFrame, sink: LakeSink, op: str = "op") -> None:
    """Append rows to a catalog table (made when missing), or to Parquet below the warehouse without a catalog."""
    rows = to_append_only(df, op) if op in df.columns else df
    if sink.catalog_type == "storage":
        rows.write.mode("append").options(**sink.options).parquet(sink.path)
        return
    writer = rows.writeTo(sink.identifier).options(**sink.options)
    if sink.create_table and not df.sparkSession.catalog.tableExists(sink.identifier):
        writer.create()
    else:
        writer.append()


def upsert_table(changes: DataFrame, sink: LakeSink, order_by: Sequence[str], batch_id: int, op: str = "op") -> None:
    """Upsert one batch: ``MERGE INTO`` in a catalog, else a merge-on-read batch."""
    spark = changes.sparkSession
    if sink.catalog_type == "storage":
        LakeTable(spark, sink.path, sink.keys, order_by, op).append_batch(changes, batch_id)
        return
    if not order_by:
        raise ValueError("order_by is required to upsert changes")
    last = collapse(changes, sink.keys, list(order_by), op)
    view = f"upsert_{sink.table}_{uuid.uuid4().hex}"
    last.createOrReplaceTempView(view)
    columns = [c for c in last.columns if c != op]
    kept_order = [c for c in order_by if c in columns]
    spark.sql(merge_sql(sink.identifier, view, columns, sink.keys, op, kept_order, sink.tombstone))
    spark.catalog.dropTempView(view)
