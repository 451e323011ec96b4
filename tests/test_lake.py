"""Keyed lake tables against plain dictionaries: buckets, pruned reads, versions, schemas that change."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate import LakeTable
from tidegate.sinks.lake import BatchTable, append_partition, read_partitions

LOG = "k long, v string, pos long, op string"


def log(spark, items):
    return spark.createDataFrame(items, LOG)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def applied(items):
    """State after changes in any order: the greatest position wins, a delete on a tie."""
    last = {}
    for k, v, pos, op in items:
        if k not in last or (pos, op == "d") > (last[k][1], last[k][2] == "d"):
            last[k] = (v, pos, op)
    return {k: v for k, (v, _, op) in last.items() if op != "d"}


def state(df):
    return {r.k: r.v for r in df.collect()}


@pytest.mark.parametrize("buckets", [1, 7, 130])
def test_every_version_stays_readable(spark, out, buckets):
    rng = random.Random(buckets)
    table = LakeTable(spark, out, ["k"], ["pos"], buckets=buckets)
    seen, want = [], {}
    for batch in range(6):
        items = [(rng.randrange(25), f"{batch}.{i}", rng.randrange(60), rng.choice("cuud")) for i in range(12)]
        seen += items
        table.append_batch(log(spark, items), batch, f"w{batch % 2}")
        want[table.versions()[-1]] = applied(seen)
        if batch in (1, 4):
            table.compact()
            want[table.versions()[-1]] = applied(seen)
    got = {v: {r.k for r in table.read(as_of=v).collect()} for v in want}
    assert got == {v: set(s) for v, s in want.items()}
    # on a tie of position and kind either change may stay, but the newest version is the state
    assert set(state(table.read())) == set(applied(seen))
    middle = sorted(want)[3]
    table.expire(before=middle)
    assert {v: {r.k for r in table.read(as_of=v).collect()} for v in want if v >= middle} == {
        v: set(s) for v, s in want.items() if v >= middle
    }
    with pytest.raises(ValueError):
        table.read(as_of=sorted(want)[0])
    assert table.versions()[0] >= middle


def test_fold_leaves_other_buckets_in_place(spark, out):
    table = LakeTable(spark, out, ["k"], ["pos"], buckets=8)
    table.append_batch(log(spark, [(k, "a", 1, "u") for k in range(400)]), 0)
    table.compact()
    before = table.files()
    assert set(before) == set(range(8)) and all(before.values())
    table.append_batch(log(spark, [(5, "b", 2, "u"), (7, None, 2, "d")]), 1)
    touched = {r[0] for r in log(spark, [(5, "", 1, ""), (7, "", 1, "")]).select(table._bucket()).collect()}
    table.compact()
    table.expire()
    after = table.files()
    assert {b for b in after if after[b] != before[b]} == touched
    got = state(table.read())
    assert got == {k: "b" if k == 5 else "a" for k in range(400) if k != 7}
    # the bucket count is that of the first batch, whatever a later reader asks for
    assert LakeTable(spark, out, ["k"], ["pos"], buckets=3).buckets == 8 and state(LakeTable(spark, out, ["k"], ["pos"]).read()) == got


def test_merge_moves_no_base_row(spark, out):
    """No exchange lies over a scan of the base, and only asked columns are read."""
    table = LakeTable(spark, out, ["k"], ["pos"], buckets=8)
    table.append_batch(log(spark, [(k, "a", 1, "u") for k in range(1000)]), 0)
    table.compact()
    plain = plan(table.read())
    assert "Exchange" not in plain and "Join" not in plain
    for batch in (1, 2, 3):  # three batches touch one bucket: it is a scan of 1 path, the others one of 7
        table.append_batch(log(spark, [(1, "b", batch, "u")]), batch)
    text = plan(table.read(columns=["k"]))
    assert "SortAggregate" not in text and "ReadSchema: struct<k:bigint,pos:bigint,op:string>" in text and "v:string" not in text
    lines = text.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "(1 paths)" in line]
    assert scans and sum("(7 paths)" in line for line in lines) == 1
    for i in scans:
        level, above = depth(lines[i]), []
        for line in reversed(lines[:i]):
            if depth(line) < level:
                level = depth(line)
                above.append(line)
        shuffles = [line for line in above if "Exchange hashpartitioning" in line]
        joins = [line for line in above if "Join" in line]
        # The only shuffle above a base scan moves what the join with the changes has left of it.
        assert not shuffles or above.index(shuffles[0]) > above.index(joins[0])


def test_untouched_buckets_are_passed_on(spark, out):
    table = LakeTable(spark, out, ["k"], ["pos"], buckets=16)
    table.append_batch(log(spark, [(k, "a", 1, "u") for k in range(300)]), 0)
    table.compact()
    table.append_batch(log(spark, [(3, "b", 2, "u")]), 1)
    text = plan(table.read())
    first = text[: text.index("Join")]
    assert "PartitionFilters" in first or "tier=base" in first
    assert state(table.read()) == {k: "b" if k == 3 else "a" for k in range(300)}


def test_pins_hold_an_expiration_off(spark, out):
    table = LakeTable(spark, out, ["k"], ["pos"])
    table.append_batch(log(spark, [(1, "a", 1, "u"), (2, "a", 1, "u")]), 0)
    with table.pinned() as pinned:
        table.append_batch(log(spark, [(1, "b", 2, "u")]), 1)
        table.compact()
        assert table.expire() == []
        assert state(pinned) == {1: "a", 2: "a"}
    with table.pinned(seconds=-1):  # a reader that died counts no longer
        assert table.expire() == [0, 1]
    assert state(table.read()) == {1: "b", 2: "a"}
    assert table.version_before(3600) == table.versions()[0]


def test_nulls_are_kept_as_rejects(spark, out):
    table = LakeTable(spark, out, ["k"], ["pos"])
    items = [(1, "a", 1, "u"), (None, "b", 1, "u"), (2, "c", None, "u")]
    for _ in range(2):
        table.append_batch(log(spark, items), 0)
    assert state(table.read()) == {1: "a"}
    assert rows(read_partitions(spark, f"{out}_rejects").select("error")) == [("null key",), ("null order key",)]
    table.append_batch(log(spark, []), 1)
    assert state(table.read()) == {1: "a"} and state(table.read(as_of=table.versions()[-1])) == {1: "a"}
    table.compact()
    table.append_batch(log(spark, []), 2)
    assert state(table.read()) == {1: "a"} and table.compact() == 0
    with pytest.raises(ValueError):
        LakeTable(spark, out, ["k"], [])


def test_columns_widen_without_losing_a_value(spark, out):
    table = LakeTable(spark, out, ["k"], ["o"])
    make = lambda items, ddl: spark.createDataFrame(items, ddl)
    table.append_batch(make([(1, 1, "u", 7, 1)], "k int, o int, op string, n int, gone int"), 0)
    table.append_batch(make([(2**40, 2, "u", 2**53 + 1)], "k long, o int, op string, n long"), 1)
    table.compact()
    table.append_batch(make([(1, 3, "u", 0.1)], "k int, o int, op string, n double"), 2)  # the key has its bucket still
    assert table.columns().simpleString() == "struct<k:bigint,o:int,op:string,n:string,gone:int>"
    want = [(1, "0.1", None), (2**40, str(2**53 + 1), None)]
    assert rows(table.read().select("k", "n", "gone")) == want
    table.compact()
    table.expire()
    assert rows(table.read().select("k", "n", "gone")) == want
    assert table.read(evolving=False).columns == ["k", "o", "n", "gone"]


def test_schema_changes_may_be_refused(spark, out):
    strict = LakeTable(spark, out, ["k"], ["pos"], auto_schema_change=False)
    strict.append_batch(log(spark, [(1, "a", 1, "u")]), 0)
    with pytest.raises(ValueError):
        strict.append_batch(log(spark, [(2, "b", 1, "u")]).withColumn("extra", F.lit(1)), 1)
    strict.append_batch(log(spark, [(3, "c", 1, "u")]).drop("v"), 1)  # a column less is none that the table lacks
    assert state(strict.read()) == {1: "a", 3: None}


def test_appends_are_idempotent_and_evolve(spark, out):
    first = spark.createDataFrame([(1, "a")], "n int, s string")
    append_partition(first, out, 0)
    append_partition(first, out, 0)
    append_partition(spark.createDataFrame([("x", True)], "n string, flag boolean"), out, 1)
    append_partition(first.limit(0), out, 2)
    assert rows(read_partitions(spark, out)) == [("1", "a", None), ("x", None, True)]
    assert read_partitions(spark, f"{out}/nothing").count() == 0
    with pytest.raises(ValueError):
        BatchTable(spark, out, auto_schema_change=False).append(first.withColumn("more", F.lit(1)), 3)
