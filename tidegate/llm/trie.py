"""Binary trie self-join of 64-bit words within a Hamming budget.

Words that differ in at most ``budget`` bits agree on one of ``budget + 1`` blocks of their bits. So each word enters that
many tries, each with another block first; a node whose path is a whole block is the root of a group. Within a group pairs
of nodes are traversed together: both children of one node meet both children of the other, differing bits add up, and a
pair ends where they exceed the budget. Groups too large for one task are traversed on tables first, ``STEP`` levels at a
time, so that every task gets node pairs of bounded size. Where levels can't tell words apart, as the budget allows all
their bits to differ or the words are equal, a group is dealt to blocks by a hash, and every pair of blocks is a task's. The
same traversal serves groups that a caller has formed. If a check decides the links, the rows of a large group are first
checked against one of them; rows that it joins need not be met with each other any more, only with all others.

Links become components, so a task reduces the links it finds to a forest: the same components from fewer rows. Where a check
can't decide pairs, the rows they stand between are returned, not the pairs; ``decide`` meets them again with all it takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import saved

#: Rows of a node pair that one task traverses in memory.
LEAF = 4096
#: Levels of the trie that a pass on tables descends.
STEP = 6
#: Rows that a task gathers before it traverses their groups together, without and with a payload.
GATHER, GATHER_PAYLOAD = 100_000, 12_000
#: The same where rows bring all that decides, and pairs checked in one step then.
LEAF_WHOLE, GATHER_WHOLE, STEP_WHOLE = 512, 512, 64
#: Parts among which the rows that meet one representative are dealt.
SALTS = 64
#: Pairs of words that are compared one by one instead of descending further, for a pair of nodes.
FEW = 24

#: Rounds in which the rows of a large group are checked against one of them.
ROUNDS = 3

Check = Callable[[np.ndarray, np.ndarray], np.ndarray]


def blocks(word: Column, budget: int) -> Column:
    """Array of (group, word): the block's number and bits, and the word turned so that the block comes first."""
    n = budget + 1
    edges = [round(64 * i / n) for i in range(n + 1)]
    out = []
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        turned = word if a == 0 else F.shiftleft(word, a).bitwiseOR(F.shiftrightunsigned(word, 64 - a))
        key = F.shiftrightunsigned(turned, 64 - (b - a)) if b - a < 64 else F.lit(0).cast("long")
        out.append(F.struct(F.lit(i).alias("trie"), key.alias("root"), turned.alias("word"), F.lit(b - a).alias("depth")))
    return F.array(*out)


def _popcounts(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def traverse(words: np.ndarray, side: np.ndarray, group: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of words of one group that differ in at most ``budget`` bits.

    ``side`` is 0 for groups joined with themselves; in groups of two sides, 1 and 2, only words of different sides pair.
    Groups are numbers that don't fall.
    """
    order = np.lexsort((words, side, group))
    words, side, group = words[order], side[order], group[order]
    cut = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])))
    end = np.append(cut[1:], len(words))
    alone = side[cut] == 0
    first = np.flatnonzero(~alone & (side[cut] == 1))
    first = first[(first + 1 < len(cut))]
    first = first[group[cut[first]] == group[cut[np.minimum(first + 1, len(cut) - 1)]]] if len(first) else first
    a_lo = np.concatenate((cut[alone], cut[first]))
    a_hi = np.concatenate((end[alone], end[first]))
    b_lo = np.concatenate((cut[alone], cut[first + 1]))
    b_hi = np.concatenate((end[alone], end[first + 1]))
    left = np.full(len(a_lo), budget)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for depth in range(65):
        same = a_lo == b_lo
        na, nb = a_hi - a_lo, b_hi - b_lo
        live = (na > 0) & (nb > 0) & (left >= 0) & ~(same & (na < 2))
        few = live & ((na * nb <= FEW) | (depth == 64))
        if few.any():
            n = (na * nb)[few]
            which = np.repeat(np.flatnonzero(few), n)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            i, j = a_lo[which] + nth // nb[which], b_lo[which] + nth % nb[which]
            differ = _popcounts((words[i] ^ words[j]) & _below(depth))
            ok = (differ <= left[which]) & (~same[which] | (i < j))
            found.append((i[ok], j[ok]))
        go = live & ~few
        if not go.any():
            break
        a_lo, a_hi, b_lo, b_hi, left, same = a_lo[go], a_hi[go], b_lo[go], b_hi[go], left[go], same[go]
        ones = np.concatenate(([0], np.cumsum((words >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)))
        a_mid, b_mid = a_hi - (ones[a_hi] - ones[a_lo]), b_hi - (ones[b_hi] - ones[b_lo])
        apart = ~same
        a_lo, a_hi, b_lo, b_hi, left = (
            np.concatenate(parts)
            for parts in (
                (a_lo, a_mid, a_lo, a_mid[apart]),
                (a_mid, a_hi, a_mid, a_hi[apart]),
                (b_lo, b_mid, b_mid, b_lo[apart]),
                (b_mid, b_hi, b_hi, b_mid[apart]),
                (left, left, left - 1, left[apart] - 1),
            )
        )
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return order[np.concatenate([i for i, _ in found])], order[np.concatenate([j for _, j in found])]


def _below(depth: int) -> np.uint64:
    """Mask of the bits below ``depth`` levels."""
    return np.uint64((1 << (64 - depth)) - 1) if depth else np.uint64(0xFFFFFFFFFFFFFFFF)


def forest(a: np.ndarray, b: np.ndarray, n: int, roots: np.ndarray | None = None) -> np.ndarray:
    """The smallest place of each place's component, of ``n`` places, under the links; continues from ``roots``."""
    root = np.arange(n) if roots is None else roots
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _node_pairs(rows: DataFrame, budget: int) -> DataFrame:
    """One pass down ``STEP`` levels: every row goes to the pairs of child nodes it belongs to."""
    masks = [m for m in range(1 << STEP) if m.bit_count() <= budget]
    x = F.shiftrightunsigned("word", 64 - STEP)
    x = F.shiftrightunsigned(F.expr("shiftleft(word, depth)"), 64 - STEP).cast("long")
    to = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("bits")) for m in masks]))
    met = rows.withColumn("x", x).withColumn("to", to).filter(F.col("to.bits") <= F.col("left"))
    y = F.col("x").bitwiseXOR(F.col("to.mask"))
    alone = F.col("side") == 0
    stays = alone & (F.col("to.mask") == 0)
    # Of a node joined with itself two different children meet once, the smaller as side 1.
    low = F.when(alone, F.least("x", y)).when(F.col("side") == 1, F.col("x")).otherwise(y)
    high = F.when(alone, F.greatest("x", y)).when(F.col("side") == 1, y).otherwise(F.col("x"))
    side = F.when(stays, 0).when(alone, F.when(F.col("x") < y, 1).otherwise(2)).otherwise(F.col("side"))
    kept = [c for c in rows.columns if c not in ("group", "side", "left", "depth")]
    return met.select(
        *kept,
        F.concat_ws("/", "group", low.cast("string"), high.cast("string")).alias("group"),
        side.cast("int").alias("side"),
        (F.col("left") - F.col("to.bits")).cast("int").alias("left"),
        (F.col("depth") + STEP).cast("int").alias("depth"),
    )


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of groups in which something can pair, with the group's size and how many rows of it are of side 1."""
    sizes = rows.groupBy("group").agg(
        F.count("*").alias("size"),
        F.count_if(F.col("side") == 1).alias("ones"),
        F.min("side").alias("s0"),
        F.max("side").alias("s1"),
    )
    some = sizes.filter("size > 1 AND (s0 = 0 OR s0 <> s1)").select(F.col("group").alias("g"), "size", "ones")
    return rows.join(some, F.col("group") == F.col("g")).drop("g")


def _block_pairs(sized: DataFrame, leaf: int) -> DataFrame:
    """Every row in all pairs of blocks of its group that it belongs to, blocks of some ``leaf`` / 2 rows."""
    half = max(1, leaf // 2)
    alone = F.col("side") == 0
    first = F.col("side") == 1
    twos = F.col("size") - F.col("ones")
    mine = F.ceil(F.when(alone, F.col("size")).when(first, F.col("ones")).otherwise(twos) / half)
    theirs = F.ceil(F.when(alone, F.col("size")).when(first, twos).otherwise(F.col("ones")) / half)
    met = sized.withColumn("block", F.pmod(F.xxhash64("node"), mine).cast("long"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), theirs - 1)))
    low = F.when(alone, F.least("block", "other")).when(first, F.col("block")).otherwise(F.col("other"))
    high = F.when(alone, F.greatest("block", "other")).when(first, F.col("other")).otherwise(F.col("block"))
    side = F.when(~alone, F.col("side")).when(F.col("block") == F.col("other"), 0)
    side = side.when(F.col("block") < F.col("other"), 1).otherwise(2)
    group = F.concat_ws("/", "group", low.cast("string"), high.cast("string"))
    kept = [F.col(c) for c in sized.columns if c not in ("group", "side", "size", "ones")]
    return met.select(*kept, group.alias("group"), side.cast("int").alias("side"))


def _checked(pairs: DataFrame, payload: DataFrame, check) -> DataFrame:
    """Those of the pairs ``node, rep`` that the check links."""
    extra = [c for c in payload.columns if c != "node"]
    reps = pairs.select("rep").distinct().join(payload.withColumnRenamed("node", "rep"), "rep")
    of_rep = reps.select("rep", *[F.col(c).alias(f"rep_{c}") for c in extra], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = pairs.join(payload, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    met = met.join(of_rep, ["rep", "salt"]).select("node", "rep", *extra, *[f"rep_{c}" for c in extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                own = pa.table([b.column(c) for c in extra], names=extra)
                reps = pa.table([b.column(f"rep_{c}") for c in extra], names=extra)
                place = np.arange(b.num_rows)
                yes = check(pa.concat_tables([own, reps]))(place, place + b.num_rows) == 1
                yield b.select(["node", "rep"]).filter(pa.array(yes))

    return met.mapInArrow(run, "node long, rep long")


def _represented(
    rows: DataFrame, budget: int, leaf: int, payload: DataFrame, check
) -> tuple[DataFrame, list[DataFrame]]:
    """Rows by groups in which pairs are left to check, and links found before.

    In each round one row of a group with more than ``leaf`` unjoined rows is checked against them. The rows it joins are of
    one component, so pairs of them are left out; all other pairs stay.
    """
    sizes = rows.groupBy("group").agg(F.count("*").alias("size"))
    large = saved(sizes.filter(F.col("size") > leaf).select(F.col("group").alias("g")), "large")
    if large.isEmpty():
        return rows, []
    small = rows.join(large, F.col("group") == F.col("g"), "left_anti")
    rest = saved(rows.join(large, F.col("group") == F.col("g"), "left_semi"), "unjoined")
    done: list[DataFrame] = []
    found: list[DataFrame] = []
    for nth in range(1, ROUNDS + 1):
        reps = rest.groupBy("group").agg(F.count("*").alias("size"), F.min(F.struct("node", "word")).alias("least"))
        reps = reps.filter(F.col("size") > leaf)
        reps = saved(reps.select(F.col("group").alias("g"), F.col("least.node").alias("rep"), F.col("least.word").alias("rep_word")), "reps")
        if reps.isEmpty():
            break
        met = rest.join(reps, F.col("group") == F.col("g"))
        near = F.bit_count(F.col("word").bitwiseXOR(F.col("rep_word"))) <= budget
        yes = saved(_checked(met.filter((F.col("node") != F.col("rep")) & near).select("node", "rep").distinct(), payload, check), "joined")
        found.append(yes.select(F.col("node").alias("a"), F.col("rep").alias("b")))
        known = yes.select(F.col("node").alias("n"), F.col("rep").alias("r"))
        marked = rest.join(reps.drop("rep_word"), F.col("group") == F.col("g"), "left")
        marked = marked.join(known, (F.col("node") == F.col("n")) & (F.col("rep") == F.col("r")), "left")
        label = F.when((F.col("node") == F.col("rep")) | F.col("n").isNotNull(), nth).otherwise(0)
        marked = saved(marked.select(*rest.columns, label.alias("label")), "marked")
        done.append(marked.filter("label > 0"))
        rest = marked.filter("label = 0").drop("label")
    labelled = rest.withColumn("label", F.lit(0))
    for d in done:
        labelled = labelled.unionByName(d)
    met = labelled.withColumn("other", F.explode(F.array(*[F.lit(k) for k in range(len(done) + 1)])))
    met = met.filter("other <> label OR label = 0")
    low, high = F.least("label", "other"), F.greatest("label", "other")
    side = F.when(F.col("label") == F.col("other"), 0).when(F.col("label") < F.col("other"), 1).otherwise(2)
    left = met.withColumn("side", side.cast("int"))
    left = left.withColumn("group", F.concat_ws("/", "group", low.cast("string"), high.cast("string")))
    return small.unionByName(left.select(*rows.columns)), found


def self_join(
    rows: DataFrame,
    budget: int,
    leaf: int = LEAF,
    payload: DataFrame | None = None,
    check: Callable[[pa.RecordBatch], Check] | None = None,
) -> DataFrame:
    """``a, b``: links that join the same nodes as all links do, of nodes in ``rows``.

    ``rows`` has ``group`` (text), ``node`` (long), ``word`` (long) and ``depth``, the leading bits all words of the group
    share. ``payload`` has more columns by ``node``; ``check`` makes of them a function that tells which of the pairs of
    rows within the budget are linked: 1 (or true), 0 (or false), or 2 where the payload doesn't decide. With a check there
    are also the columns ``group, side, word``: links have none, and rows without ``b`` are the members ``a`` of groups in
    which pairs of the last kind are left that other links of their task don't join. There is one for each row at most.
    """
    open_ = rows.select(
        "group", "node", "word", F.lit(0).alias("side"), F.lit(budget).alias("left"), F.col("depth").cast("int").alias("depth")
    )
    found: list[DataFrame] = []
    if check is not None:
        open_, found = _represented(open_, budget, leaf, payload, check)
    ready: list[DataFrame] = []
    while True:
        sized = saved(_sized(open_), "nodes")
        ready.append(sized.filter(F.col("size") <= leaf).drop("size", "ones"))
        over = sized.filter(F.col("size") > leaf)
        if over.isEmpty():
            break
        alike = (F.col("depth") + STEP > 64) | (F.col("left") >= STEP)
        ready.append(_block_pairs(over.filter(alike), leaf))
        large = over.filter(~alike).drop("size", "ones")
        if large.isEmpty():
            break
        open_ = _node_pairs(large, budget)
    parts = ready[0]
    for more in ready[1:]:
        parts = parts.unionByName(more)
    extra = []
    if payload is not None:
        extra = [c for c in payload.columns if c != "node"]
        parts = parts.join(payload, "node")
    gather = GATHER_PAYLOAD if extra else GATHER
    out = _deal(parts.select("group", "side", "node", "word", *extra), budget, gather, check)
    for links in found:
        more = [F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields[2:]]
        out = out.unionByName(links.select("a", "b", *more))
    return out


def _deal(parts: DataFrame, budget: int, gather: int, check, step: int = 4096) -> DataFrame:
    """Links, and members of undecided pairs, of all groups."""
    dealt = parts.repartition("group").sortWithinPartitions("group")
    schema = "a long, b long" if check is None else "a long, b long, group string, side int, word long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, gather):
            a, b, left = _links(t, budget, check, step)
            made = [pa.array(a), pa.array(b)]
            if check is None:
                yield pa.RecordBatch.from_arrays(made, names=["a", "b"])
                continue
            made += [pa.nulls(len(a), kind) for kind in (pa.string(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["a", "b", "group", "side", "word"])
            rest = t.take(pa.array(left)).combine_chunks()
            if len(left):
                (r,) = rest.select(["node", "group", "side", "word"]).to_batches()
                made = [r.column(0), pa.nulls(len(left), pa.int64()), r.column(1), r.column(2).cast(pa.int32()), r.column(3)]
                yield pa.RecordBatch.from_arrays(made, names=["a", "b", "group", "side", "word"])

    return dealt.mapInArrow(run, schema)


def decide(left: DataFrame, budget: int, payload: DataFrame, check, leaf: int = LEAF_WHOLE) -> DataFrame:
    """``a, b``: links between the members ``left`` over by ``self_join``.

    ``left`` has ``group, side, node, word`` and ``of``, a component that other links make; pairs of one component are left
    out. ``payload`` and ``check`` decide every pair.
    """
    sized = saved(_sized(left), "nodes")
    # A group keeps its name only if it stays whole.
    blocks_ = _block_pairs(sized.filter(F.col("size") > leaf), leaf)
    parts = sized.filter(F.col("size") <= leaf).drop("size", "ones").unionByName(blocks_)
    extra = [c for c in payload.columns if c != "node"]
    parts = parts.join(payload, "node").select("group", "side", "node", "word", "of", *extra)
    return _deal(parts, budget, GATHER_WHOLE, check, STEP_WHOLE).select("a", "b")


def whole_groups(batches: Iterator[pa.RecordBatch], gather: int = GATHER) -> Iterator[pa.Table]:
    """Tables of about ``gather`` rows that hold whole groups, of batches in order of ``group``."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < gather:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        last = t["group"][-1].as_py()
        keep = pc.sum(pc.equal(t["group"], last).cast(pa.int64())).as_py()
        if keep < t.num_rows:
            yield t.slice(0, t.num_rows - keep)
            held, n = t.slice(t.num_rows - keep).combine_chunks().to_batches(), keep
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_numbers(t: pa.Table) -> np.ndarray:
    """Number of each row's group, rising."""
    codes = t["group"].combine_chunks().dictionary_encode()
    codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
    return codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _links(t: pa.Table, budget: int, check, step: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked nodes as a forest, and the rows between which undecided pairs are left."""
    group = group_numbers(t)
    words = t["word"].to_numpy().view(np.uint64)
    i, j = traverse(words, t["side"].to_numpy().astype(np.int64), group, budget)
    nodes = t["node"].to_numpy()
    values, place = np.unique(nodes, return_inverse=True)
    root = np.arange(len(values))
    if "of" in t.column_names:
        # Members of a component hang on the first of them that is here; their links are known.
        _, first, nth = np.unique(t["of"].to_numpy(), return_index=True, return_inverse=True)
        root = forest(place, place[first[nth]], len(root), root)
    known = root.copy()
    unsure: list[np.ndarray] = []
    if check is None:
        root = forest(place[i], place[j], len(root), root)
    else:
        tell = check(t)
        mix = np.random.default_rng(len(i)).permutation(len(i))
        i, j = i[mix], j[mix]
        at = 0
        while at < len(i):  # pairs that earlier ones have joined already need no check
            a, b = i[at : at + 200_000], j[at : at + 200_000]
            at += len(a)
            while len(a):
                apart = root[place[a]] != root[place[b]]
                a, b = a[apart], b[apart]
                told = tell(a[:step], b[:step])
                yes, may = told == 1, told == 2
                unsure.append(np.stack((a[:step][may], b[:step][may])))
                root = forest(place[a[:step][yes]], place[b[:step][yes]], len(root), root)
                a, b = a[step:], b[step:]
    left = np.zeros(0, np.int64)
    if unsure:
        low, high = np.concatenate(unsure, 1)
        apart = root[place[low]] != root[place[high]]
        left = np.unique(np.concatenate((low[apart], high[apart])))
    new = np.flatnonzero(root != known)
    return values[new], values[root[new]], left
