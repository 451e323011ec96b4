"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A hash of a vector is the coordinate that a random rotation makes largest, with its sign; rotations are three rounds of random
signs and a fast Hadamard transform. ``HASHES`` of them name a bucket in each of ``TABLES`` tables. Every vector lies in its
own bucket of a table and also looks into ``PROBES`` neighbouring ones, those in which the narrowest second-best coordinate
replaces a largest one. Vectors of a bucket, one of them at least in its own, are compared by their cosine in double
precision. Pairs at the threshold of 0.95 are missed with a chance of about 1 in 150, closer ones less often.

Equal vectors are one class, which is hashed once and counts by its size. A linked pair is counted in one bucket only, the
first that both share, so that links are counted in place and never listed: a task returns counts and a forest of links.
Buckets of more than ``LEAF`` vectors are met in pairs of blocks, each pair a task of its own.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of
different length don't link; repeated rows are linked vectors; a null id never names a component, and its row is not kept;
an empty table gives an empty table. Only the columns named in the result are returned, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .frames import saved
from .trie import forest, group_numbers, whole_groups

THRESHOLD = 0.95
TABLES, HASHES, PROBES = 6, 3, 3
SEED = 5
LEAF = 2048
#: Rows that a task gathers before it compares the vectors of their groups.
GATHER = 30_000
#: Largest group whose pairs are listed together with those of other groups; beyond it blocks of a matrix are compared.
SMALL = 48
BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows, scaled to keep lengths; the row length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), 2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


@cache
def _signs(d: int) -> np.ndarray:
    return np.random.default_rng((SEED, d)).choice(np.array([-1.0, 1.0], np.float32), (TABLES, HASHES, 3, d))


def buckets(vectors: np.ndarray) -> np.ndarray:
    """Bucket numbers of every vector, ``TABLES`` x (1 + ``PROBES``), its own bucket first."""
    n, d = vectors.shape
    wide = 1 << max(1, (d - 1).bit_length())
    x = np.zeros((n, wide), np.float32)
    x[:, :d] = vectors
    signs = _signs(wide)
    out = np.zeros((n, TABLES, 1 + PROBES), np.int64)
    options = [m for m in range(1 << HASHES)]
    for t in range(TABLES):
        codes = np.zeros((HASHES, 2, n), np.int64)
        gaps = np.zeros((HASHES, n), np.float32)
        for k in range(HASHES):
            y = x
            for r in range(3):
                y = hadamard(y * signs[t, k, r])
            size = np.abs(y)
            rows = np.arange(n)
            for best in (0, 1):
                at = size.argmax(1)
                codes[k, best] = at * 2 + (y[rows, at] < 0)
                gaps[k] = size[rows, at] if best == 0 else gaps[k] - size[rows, at]
                size[rows, at] = -1
        cost = np.stack([sum((gaps[k] for k in range(HASHES) if m >> k & 1), np.zeros(n, np.float32)) for m in options], 1)
        chosen = np.argsort(cost, axis=1, kind="stable")[:, : 1 + PROBES]
        name = np.zeros((n, 1 + PROBES), np.int64)
        for k in range(HASHES):
            name = (name << 16) | np.where(chosen >> k & 1, codes[k, 1][:, None], codes[k, 0][:, None])
        out[:, t] = name | ((t * 32 + wide.bit_length()) << 48)
    return out


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers as rows of one matrix, zeros behind short ones, and their lengths.

    Rows are scaled by their largest component: that changes no cosine, and squares of very large or small ones stay finite.
    """
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(column.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=1))))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    most = np.abs(out).max(1, initial=0.0, keepdims=True)
    return out / np.where(most > 0, most, 1.0), size


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            b = whole.slice(at, 2000)
            vectors, size = _matrix(b.column("embedding"))
            nodes = b.column("node").to_numpy()
            for d in np.unique(size).tolist():
                rows = np.flatnonzero(size == d)
                made = buckets(vectors[rows, :d]).reshape(len(rows), -1)
                own = np.tile(np.arange(1 + PROBES) == 0, TABLES)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(made.ravel()),
                        pa.array(np.repeat(nodes[rows], made.shape[1])),
                        pa.array(np.tile(own, len(rows)).astype(np.int32)),
                    ],
                    names=["bucket", "node", "own"],
                )


def _candidates(group: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Places of the pairs of every group, in parts, and whether all of the first meet all of the second; ``group`` doesn't fall."""
    cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(cut, len(group)))
    small = size <= SMALL
    n = np.where(small, size * size, 0)
    ends = np.cumsum(n)
    at = 0
    while at < len(cut):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 500_000, side="right")))
        k = n[at:to]
        which = np.repeat(np.arange(at, to), k)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(k) - k, k)
        i, j = cut[which] + nth // np.maximum(1, size[which]), cut[which] + nth % np.maximum(1, size[which])
        ok = (i < j) & ((side[i] == 0) | (side[i] != side[j]))
        yield i[ok], j[ok], False
        at = to
    for g in np.flatnonzero(~small).tolist():
        for a in range(cut[g], cut[g] + size[g], BLOCK):
            for b in range(a, cut[g] + size[g], BLOCK):
                end = cut[g] + size[g]
                yield np.arange(a, min(a + BLOCK, end)), np.arange(b, min(b + BLOCK, end)), True


def _compare(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of whole groups: node, linked node (-1: none), and what the links weigh."""
    group, side, own = group_numbers(t), t["side"].to_numpy(), t["own"].to_numpy()
    order = np.argsort(group, kind="stable")
    t = t.take(pa.array(order))
    group, side, own = group[order], side[order], own[order]
    nodes, weight = t["node"].to_numpy(), t["weight"].to_numpy()
    column = t["embedding"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    raw, length = _matrix(column)
    unit = raw / np.linalg.norm(raw, axis=1)[:, None]
    mine = np.array([int(g.split("/")[0]) for g in t["group"].to_pylist()], np.int64)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j, block in _candidates(group, side):
        if block:
            near = unit[i] @ unit[j].T >= THRESHOLD
            p, q = np.nonzero(near)
            p, q = i[p], j[q]
            ok = (p < q) & ((side[p] == 0) | (side[p] != side[q]))
            p, q = p[ok], q[ok]
        else:
            near = np.einsum("nd,nd->n", unit[i], unit[j]) >= THRESHOLD
            p, q = i[near], j[near]
        ok = (length[p] == length[q]) & ((own[p] | own[q]) > 0)
        pairs.append((p[ok], q[ok]))
    i, j = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    if not len(i):
        return
    linked = np.unique(np.concatenate((i, j)))
    keys = np.zeros((len(linked), TABLES, 1 + PROBES), np.int64)
    for d in np.unique(length[linked]).tolist():
        rows = np.flatnonzero(length[linked] == d)
        keys[rows] = buckets(raw[linked[rows], :d])
    place = np.zeros(len(group), np.int64)
    place[linked] = np.arange(len(linked))
    first = np.zeros(len(i), bool)
    for at in range(0, len(i), 200_000):
        a, b = keys[place[i[at : at + 200_000]]], keys[place[j[at : at + 200_000]]]
        least = np.full(len(a), np.iinfo(np.int64).max)
        for t_ in range(TABLES):
            for p in range(1 + PROBES):
                least = np.where(a[:, t_, 0] == b[:, t_, p], np.minimum(least, a[:, t_, 0]), least)
                least = np.where(b[:, t_, 0] == a[:, t_, p], np.minimum(least, b[:, t_, 0]), least)
        first[at : at + 200_000] = least == mine[i[at : at + 200_000]]
    values, slot = np.unique(nodes, return_inverse=True)
    n = np.bincount(slot[i[first]], weight[j[first]], len(values)) + np.bincount(slot[j[first]], weight[i[first]], len(values))
    some = np.flatnonzero(n)
    yield values[some], np.full(len(some), -1), n[some].astype(np.int64)
    root = forest(slot[i], slot[j], len(values))
    child = np.flatnonzero(root != np.arange(len(values)))
    yield values[child], values[root[child]], np.zeros(len(child), np.int64)


LINKS = T.StructType([T.StructField(n, T.LongType()) for n in ("node", "other", "n")])


def links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", leaf: int = LEAF) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    single = vectors.schema[embedding].dataType == T.ArrayType(T.FloatType(), vectors.schema[embedding].dataType.containsNull)
    # Floats stay floats on the way; every other type is compared as doubles.
    read = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>" if single else "array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = read.filter(usable)
    classes = good.groupBy("embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first_id"))
    # Numbers of rows are unique; written, they are the same ever after.
    classes = saved(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "vectors")
    rows = saved(classes.select("node", "embedding").mapInArrow(_bucket_rows, "bucket long, node long, own int"), "buckets")
    rows = rows.groupBy("bucket", "node").agg(F.max("own").alias("own"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("own").alias("owned"))
    some = sizes.filter("size > 1 AND owned > 0").select(F.col("bucket").alias("met"), "size")
    met = rows.join(some, F.col("bucket") == F.col("met"))
    n_blocks = F.ceil(F.col("size") / (leaf // 2))
    block = F.when(F.col("size") <= leaf, 0).otherwise(F.pmod(F.xxhash64("node"), n_blocks))
    others = F.when(F.col("size") <= leaf, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), n_blocks - 1))
    met = met.withColumn("block", block.cast("long")).withColumn("other", F.explode(others))
    dealt = met.select(
        F.concat_ws(
            "/",
            F.col("bucket").cast("string"),
            F.least("block", "other").cast("string"),
            F.greatest("block", "other").cast("string"),
        ).alias("group"),
        "node",
        "own",
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).cast("int").alias("side"),
    )
    dealt = dealt.join(classes.select("node", "weight", "embedding"), "node").repartition("group").sortWithinPartitions("group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, GATHER):
            for made in _compare(t):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=LINKS.names)

    found = saved(dealt.mapInArrow(run, LINKS), "links")
    counts = found.filter("other < 0").groupBy("node").agg(F.sum("n").alias("n"))
    member = saved(components(found.filter("other >= 0").select("node", "other"), "node", "other"), "member")
    named = (
        classes.select("node", "embedding", "weight", "first_id")
        .join(counts, "node", "left")
        .join(member, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = named.join(smallest, "component").select(
        F.xxhash64("embedding").alias("h"),
        F.col("embedding").alias("same"),
        (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        "component_id",
    )
    linked = good.withColumn("k", F.xxhash64("embedding")).join(
        by_class, (F.col("k") == F.col("h")) & (F.col("embedding") == F.col("same"))
    )
    rest = read.filter(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = linked.select("vec_id", "n_links", "component_id").union(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
