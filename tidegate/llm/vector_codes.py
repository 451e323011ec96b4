"""Vector code compression: product codes whose codebooks active-entry Lloyd rounds learn over all vectors, in integers.

Each component x becomes floor(scale * x). Vectors are cut into ``parts`` equal parts; the codebook of a part position starts
as that part of the vectors with the smallest ids. Every round assigns each part to its nearest entry, ties to the lower
index, then moves each entry to the floor of its parts' mean; an entry without parts stays.

A part keeps its entry and the exact distance to it. If that entry stayed where it was, no other entry that stayed can have
become nearer, so the part is compared with the entries that moved only; a part whose own entry moved looks through the
whole codebook. Entries settle one by one, so later rounds compare few. Vectors never leave their task: a round reads the
table of the round before and writes the next, with counts and sums per entry of each task beside the vectors. Only these
sums, one row for each component of a codebook, come to the driver.

Defined results: vectors that are null or hold null or non-finite components are left out; shorter vectors, the empty one
included, and lengths that ``parts`` doesn't divide are filled up with zeros; components are held within a bound, of
some 1e8 for parts of 8, at which the error of a vector fits 64 bits. Repeated rows are vectors of their own; rows of the
same id start a codebook in the order of their components, null ids come last. Fewer vectors than entries make a shorter
codebook; an empty table gives an empty table. Only the columns named in the result are returned, so others cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors that one step of a task takes at once.
STEP = 4096


@dataclass
class Codes:
    """``vec_id, kept columns, code (one byte a part), error`` of every vector, and the final codebooks: part, entry, component."""

    vectors: DataFrame
    books: np.ndarray


def bound(width: int) -> int:
    """Largest component for which the squared distances of all parts of a vector add up within 64 bits."""
    return math.isqrt((2**63 - 1) // (4 * max(1, width)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(column.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of every row of ``x``; the lower index wins a tie."""
    best, code = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.uint8)
    for k, entry in enumerate(book):
        far = ((x - entry) ** 2).sum(1)
        nearer = far < best
        best[nearer], code[nearer] = far[nearer], k
    return code, best


def rescan(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, best: np.ndarray) -> None:
    """Bring ``code`` and ``best`` up to date, in place, after the ``moved`` entries of ``book`` changed."""
    again = moved[code]
    code[again], best[again] = scan(x[again], book)
    held = np.flatnonzero(~again)
    for k in np.flatnonzero(moved).tolist():
        far = ((x[held] - book[k]) ** 2).sum(1)
        nearer = (far < best[held]) | ((far == best[held]) & (k < code[held]))
        code[held[nearer]], best[held[nearer]] = k, far[nearer]


def _round(schema: T.StructType, n_kept: int, books: np.ndarray, moved: np.ndarray | None, sums: bool):
    """What a task does in one round: assign, and add up the parts of each entry."""
    parts, entries, w = books.shape
    kinds = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, w), np.int64)
        arrow = None
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                b = whole.slice(at, STEP)
                n = b.num_rows
                x = _matrix(b.column(n_kept), parts * w).reshape(n, parts, w)
                if moved is None:
                    code, best = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
                else:
                    code = np.frombuffer(b"".join(b.column(n_kept + 1).to_pylist()), np.uint8).reshape(n, parts).copy()
                    best = _matrix(b.column(n_kept + 2), parts)
                for p in range(parts):
                    c, d = code[:, p].copy(), best[:, p].copy()
                    if moved is None:
                        c, d = scan(x[:, p], books[p])
                    else:
                        rescan(x[:, p], books[p], moved[p], c, d)
                    code[:, p], best[:, p] = c, d
                    if sums:
                        count[p] += np.bincount(c, minlength=entries)
                        np.add.at(total[p], c, x[:, p])
                best = pa.ListArray.from_arrays(np.arange(0, n * parts + 1, parts, np.int32), best.ravel())
                made = [*b.columns[: n_kept + 1], pa.array([r.tobytes() for r in code], pa.binary()), best]
                made += [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
                arrow = [c.type for c in made]
                yield pa.RecordBatch.from_arrays(made, names=kinds)
        used = np.argwhere(count)
        if len(used):
            made = [pa.nulls(len(used), t) for t in arrow[: n_kept + 3]]
            made += [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array([int(count[p, k]) for p, k in used])]
            made.append(pa.array([total[p, k].tolist() for p, k in used], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(made, names=kinds)

    return run


def moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the floor of the mean of its parts, which the tasks of ``state`` have added up."""
    each = state.filter("entry IS NOT NULL").select("part", "entry", "n", F.posexplode("total").alias("place", "s"))
    # A row for each component of a codebook, however many vectors there are.
    rows = each.groupBy("part", "entry", "place").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n")
    )
    out = books.copy()
    for r in rows.collect():
        out[r["part"], r["entry"], r["place"]] = int(r["s"]) // int(r["n"])
    return out


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    keep: tuple[str, ...] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codes:
    """Codes of all vectors, with the columns ``keep`` beside them."""
    names = ("vec_id", *keep)
    kept = [f"kept{i}" for i in range(len(names))]
    read = vectors.select(
        *[vectors[c].alias(k) for c, k in zip((vec_id, *keep), kept)], vectors[embedding].cast("array<double>").alias("x")
    ).filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    w = math.ceil((read.agg(F.max(F.size("x"))).first()[0] or 0) / parts)
    most = float(bound(w * parts))
    held = lambda v: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), v * float(scale)))).cast("int")
    ints = read.select(*kept, F.transform("x", held).alias("ints"))
    # As many vectors as a codebook has entries.
    first = ints.select(kept[0], "ints").orderBy(F.col(kept[0]).asc_nulls_last(), "ints").limit(entries).collect()
    books = np.zeros((len(first), parts * w), np.int64)
    for at, r in enumerate(first):
        books[at, : len(r["ints"])] = r["ints"]
    books = books.reshape(len(first), parts, w).transpose(1, 0, 2).copy()
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in ints.schema.fields]
        + [T.StructField("code", T.BinaryType()), T.StructField("best", T.ArrayType(T.LongType()))]
        + [T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType())]
        + [T.StructField("n", T.LongType()), T.StructField("total", T.ArrayType(T.LongType()))]
    )
    state, path, moved = ints, None, None
    for r in range(rounds + 1):
        last = r == rounds
        state, path = stored(state.mapInArrow(_round(schema, len(kept), books, moved, not last), schema), "codes", path)
        if not last:
            after = moved_books(state, books)
            moved, books = (after != books).any(2), after
            state = state.filter("entry IS NULL").select(*kept, "ints", "code", "best")
    error = F.aggregate("best", F.lit(0).cast("long"), lambda a, v: a + v).alias("error")
    return Codes(state.select(*[F.col(k).alias(c) for c, k in zip(names, kept)], "code", error), books)


def book_text(books: np.ndarray) -> str:
    """All components of all entries, by part, entry and place, as decimals between commas."""
    return ",".join(map(str, books.ravel().tolist()))


def hex_code(code: Column) -> Column:
    """Two lowercase hex digits a part."""
    return F.lower(F.hex(code))
