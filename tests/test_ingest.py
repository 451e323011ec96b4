"""A captured database end to end: transactions, documents, groups of tables, chunks beside the log, late rows."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate import CapturedTable, Ingest, PostgresSource, connect
from tidegate.operators.changes import snapshot_chunk
from tidegate.operators.documents import assembled, patched
from tidegate.operators.skew import dealt
from tidegate.plans import source_queries
from tidegate.sinks.lake import BatchTable, read_partitions
from tidegate.sources import MongoSource, accepted, decode
from tidegate.streaming import Measure, complete_transactions, fold_rollup, fold_transactions, open_transactions, read_rollup, rollup_parts


def feed(spark, *messages):
    """Messages with their key and value as Python objects or text."""
    items = []
    for m in messages:
        key, value = m if isinstance(m, tuple) else (None, m)
        text = lambda x: None if x is None else bytearray((x if isinstance(x, str) else json.dumps(x)).encode())
        items.append((text(key), text(value)))
    return spark.createDataFrame(items, "key binary, value binary")


def change(table, lsn, op="c", tx=None, place=None, **row):
    image = {"before" if op == "d" else "after": row}
    about = {"transaction": {"id": tx, "total_order": place}} if tx else {}
    return {"op": op, **image, **about, "source": {"db": "app", "schema": "s", "table": table, "lsn": lsn, "ts_us": lsn}}


def test_transactions_let_nothing_through_before_it_is_whole(spark, out):
    table = CapturedTable("s", "t", {"id": "INT", "v": "VARCHAR"}, ("id",))
    ingest = Ingest(spark, PostgresSource("app", transactional=True), (table,), out)
    end = lambda tx, n: {"status": "END", "id": tx, "event_count": n}
    first = feed(spark, {"status": "BEGIN", "id": "a"}, change("t", 1, tx="a", place=1, id=1, v="x"), change("t", 9, op="r", id=7, v="snap"), change("t", 5, id=8, v="none"))
    second = feed(spark, change("t", 2, tx="a", place=2, id=2, v="y"), change("t", 2, tx="a", place=2, id=2, v="y"), end("a", 2), change("t", 3, tx="b", place=1, id=3, v="z"))
    for _ in range(2):
        ingest.deliver(first, 0)
        assert rows(ingest.read(table)) == [(7, "snap")]
    for _ in range(2):
        ingest.deliver(second, 1)
        ingest.maintain()  # a fold before a replay takes nothing that it needs
        assert rows(ingest.read(table)) == [(1, "x"), (2, "y"), (7, "snap")]
    assert rows(ingest.open_transactions()) == [("b", 1, None, 1)]
    assert rows(ingest.open_transactions(seconds=3600)) == []
    assert rows(read_partitions(spark, f"{out}/_transactions/rejects").select("error")) == [("null transaction id",)]
    ingest.deliver(feed(spark, change("t", 2, tx="a", place=2, id=2, v="y"), end("b", 1)), 2)
    assert rows(ingest.read(table)) == [(1, "x"), (2, "y"), (3, "z"), (7, "snap")]
    assert rows(ingest.open_transactions()) == []


def test_random_transactions_equal_a_plain_replay(spark, out):
    rng = random.Random(2)
    items = [(t, f"{t}.{i}", None) for t in range(12) for i in range(rng.randint(1, 4))]
    sizes = {t: sum(x[0] == t for x in items) for t in range(12)}
    items += [(t, None, n) for t, n in sizes.items() if t % 5]
    items += rng.sample(items, 8)  # repeats
    rng.shuffle(items)
    seen, got = [], []
    for b in range(5):
        part = items[b::5]
        seen += part
        for _ in range(1 + b % 2):
            whole = complete_transactions(spark.createDataFrame(part, "tx long, v string, n long"), b, out, "tx", "n", ["v"], ["v"])
            now = {r.v for r in whole.collect()}
        got.append(now)
        fold_transactions(spark, out, "tx")
        ends = {t for t, v, n in seen if v is None}
        want = {v for t, v, _ in seen if v and t in ends and len({w for s, w, _ in seen if s == t and w}) == sizes[t]}
        assert set().union(*got) == want and sum(map(len, got)) == len(want)
    still = {r.tx for r in open_transactions(spark, out, "tx", "n").collect()}
    assert still == {t for t in sizes if t % 5 == 0}


def test_a_batch_of_transactions_is_read_few_times(spark, out):
    taken = spark.sparkContext.accumulator(0)

    def count(row):
        taken.add(1)
        return row

    for b in range(2):
        items = [(t, f"{t}.{b}", None) for t in range(10)] + [(t, None, 2) for t in range(10) if b and t % 2]
        batch = spark.createDataFrame(spark.sparkContext.parallelize(items, 2).map(count), "tx long, v string, n long")
        before = taken.value
        whole = complete_transactions(batch, b, out, "tx", "n", ["v"], ["v"])
        assert whole.count() == (10 if b else 0)
        assert taken.value - before <= 3 * len(items)  # for null ids, for sizes, for the rows


def test_envelopes_of_transactions_are_parsed_once(spark, out):
    table = CapturedTable("s", "t", {"id": "INT"}, ("id",))
    ingest = Ingest(spark, PostgresSource("app", transactional=True), (table,), out)
    held = ingest._transactional(feed(spark, change("t", 1, tx="a", place=3, id=1), {"payload": {"status": "END", "id": "a", "event_count": 2}}))
    assert held._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    kept = held.select("_schema", "_table", "_kind", "_tx", "_place", "_events")
    assert rows(kept) == [("s", "t", "change", "a", 3, None), (None, None, "end", "a", None, 2)]


def most_rows(df):
    """Rows of the largest partition."""
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_a_batch_of_transactions_is_stored_and_dealt_not_cached(spark, out, monkeypatch):
    table = CapturedTable("s", "t", {"id": "INT"}, ("id",))
    ingest = Ingest(spark, PostgresSource("app", transactional=True), (table,), out)
    found, deliver = [], Ingest._deliver_group

    def look(self, messages, *others):
        found.append((most_rows(messages), "InMemoryTableScan" in messages._jdf.queryExecution().executedPlan().toString()))
        deliver(self, messages, *others)

    monkeypatch.setattr(connect, "dealt", lambda df, same: dealt(df, same, 20))
    monkeypatch.setattr(Ingest, "_deliver_group", look)
    changes = [change("t", i, tx=f"x{i}", place=1, id=i) for i in range(200)]
    ends = [{"status": "END", "id": f"x{i}", "event_count": 1} for i in range(190)]
    for _ in range(2):
        ingest.deliver(feed(spark, *changes, *ends), 0)
        assert rows(ingest.read(table)) == sorted(((i,) for i in range(190)), key=lambda r: str(r[0]))
    assert all(most <= 60 and not cached for most, cached in found) and len(found) == 2
    assert not os.path.exists(f"{out}/_transactions/read/writer=main/batch=0")


def test_messages_of_a_feed_of_transactions_are_made_in_small_pieces(spark, out, monkeypatch):
    monkeypatch.setattr(source_queries, "ROWS_PER_PIECE", 100, raising=False)
    lines = [(k, n) for k in range(1, 301) for n in range(1, 4)] + [(None, 1), (None, 1), (5, None), (5, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int").write.parquet(f"{out}/lineitem.parquet")
    made = source_queries._transaction_feed(spark, out)
    assert most_rows(made) <= 300
    got = [(r.l_orderkey, r.copy, json.loads(bytes(r.value))) for r in made.collect()]
    twice = lambda k: 2 if k and k % 13 == 0 else 1
    different = set(lines)
    counts = {k: sum(o == k for o, _ in different) for k, _ in different if k and k % 10}
    assert len(got) == sum(twice(k) for k, _ in different) + sum(twice(k) for k in counts)
    assert {(k, m["after"].get("l_linenumber")) for k, _, m in got if m.get("op") == "c"} == different
    assert {m["id"]: m["event_count"] - 5 for _, _, m in got if m.get("status") == "END"} == {f"tx{k}": n for k, n in counts.items()}


def plain_step(doc, kind, path, value):
    """One change applied to a document; False if it names no place in it, as a database would report none."""
    *steps, last = path.split(".")
    at = doc
    for s in steps:
        at = at.get(s) if isinstance(at, dict) else None
    if not isinstance(at, dict if not last.isdigit() else list):
        return False
    if kind == "cut":
        if not isinstance(at.get(last), list) or len(at[last]) < value:
            return False
        del at[last][value:]
    elif kind == "remove":
        return at.pop(last, at) is not at
    elif isinstance(at, list):
        if int(last) > len(at):
            return False
        at[int(last) : int(last) + 1] = [json.loads(value)]
    else:
        at[last] = json.loads(value)
    return True


def test_last_change_of_each_path_is_enough():
    """Whatever earlier changes of a path there were, the last of each, in order, make the same document."""
    rng = random.Random(4)
    choices = [("set", "a.b", "2"), ("set", "a.c", '{"d":1}'), ("set", "a.c.d", '"x"'), ("remove", "a.b", None), ("set", "a", '{"n":1}')]
    choices += [("set", "l", "[7,8,9]"), ("set", "l.0", "5"), ("set", "l.3", "6"), ("remove", "a", None), ("remove", "l", None)]
    choices += [("cut", "l", 1), ("cut", "l", 2), ("cut", "l", 3), ("set", "", '{"l":[0,0],"a":{}}')]
    for _ in range(400):
        steps = [("set", "", '{"a":{"b":1},"l":[1,2,3,4]}')]
        doc = json.loads(steps[0][2])
        for kind, path, value in rng.choices(choices, k=rng.randint(0, 12)):
            if not path:
                doc = json.loads(value)
            elif not plain_step(doc, kind, path, value):
                continue
            steps.append((kind, path, value))
        last = {}
        for i, (kind, path, value) in enumerate(steps):
            last[f"{path}#{value}" if kind == "cut" else path] = (i, kind, path, value)
        kept = [
            {"kind": k, "path": f"{p}#{v}" if k == "cut" else p, "value": v if k == "set" else None, "size": v if k == "cut" else None}
            for _, k, p, v in sorted(last.values(), key=lambda r: r[0])
        ]
        assert json.loads(patched(kept)) == doc


def test_documents_come_as_text_objects_and_patches(spark, out):
    source = lambda n: {"collection": "c", "db": "app", "ts_us": n, "ord": 0}
    whole = {"op": "c", "after": json.dumps({"_id": 1, "a": "é", "n": 1.50}), "source": source(1)}
    patch = {"op": "u", "updateDescription": {"updatedFields": '{"a":"b","deep.er":[1]}', "removedFields": ["n"]}, "source": source(2)}
    messages = [
        ({"id": "1"}, whole), ({"id": "1"}, patch), ({"id": '"text"'}, {"op": "r", "after": {"_id": "text"}, "source": source(1)}),
        ({"id": "9"}, {"op": "c", "after": '{"_id":9}', "source": source(1)}), ({"id": "9"}, {"op": "d", "source": source(3)}),
        ({"payload": {"id": '{"$oid":"f0"}'}}, {"payload": {"op": "c", "after": '{"x":1}', "source": source(1)}}),
        ({"id": "2"}, "{bad"), ({"id": "2"}, {"op": "u", "source": source(1)}), (None, {"op": "d", "source": source(1)}),
        ({"id": "2"}, {"op": "c", "after": "no document", "source": source(1)}),
        ({"id": "2"}, {"op": "u", "updateDescription": {"updatedFields": "{"}, "source": source(1)}),
    ]
    table = CapturedTable("app", "c", {"_id": "VARCHAR", "payload": "VARCHAR"}, ("_id",))
    ingest = Ingest(spark, MongoSource("app"), (table,), out)
    decoded = decode.decode_documents(feed(spark, *messages))
    errors = [r["_error"] for r in decoded.filter("_error IS NOT NULL").collect()]
    assert errors == ["malformed JSON", "no after image", "no document id", "malformed document", "malformed document"]
    for i, m in enumerate(reversed(messages)):
        if i % 4 == 0:
            ingest.deliver(feed(spark, *list(reversed(messages))[i : i + 4]), i)
    got = {r["_id"]: r["payload"] for r in ingest.read(table).collect()}
    assert got.pop("1") == '{"_id":1,"a":"b","deep":{"er":[1]}}'
    assert {k: json.loads(v) for k, v in got.items()} == {"text": {"_id": "text"}, '{"$oid":"f0"}': {"x": 1}}


def test_twenty_tables_are_one_write(spark, out):
    tables = tuple(CapturedTable("s", f"t{i}", {"id": "INT", "v": "VARCHAR"}, ("id",)) for i in range(20))
    ingest = Ingest(spark, PostgresSource("app"), tables, out, metadata=("table",))
    messages = [change(f"t{i % 20}", i, id=i, v=str(i)) for i in range(100)] + [change("t3", 1, id=None, v="x"), change("t4", 1, id="no", v="x")]
    written = []
    try:
        from tidegate.sinks import lake

        plain = lake.overwrite
        lake.overwrite = lambda o, path, *p: (written.append((path, p)), plain(o, path, *p))[1]
        for _ in range(2):
            ingest.deliver(feed(spark, *messages), 0)
    finally:
        lake.overwrite = plain
    assert [p for _, p in written if "table" in p] == [("table", "tier", "writer", "batch")] * 2
    for i, t in enumerate(tables):
        assert rows(ingest.read(t)) == [(k, str(k), f"t{i}") for k in sorted(range(i, 100, 20), key=str)]
        assert [p.batch for p in ingest.target(t)._parts()] == [0]
    assert rows(read_partitions(spark, f"{out}/_rejects/t3").select("error")) == [("null key",)]
    assert read_partitions(spark, f"{out}/_rejects/t4").count() == 1 and read_partitions(spark, f"{out}/_rejects/t5").count() == 0


def test_source_patterns_and_settings_hold(spark, out):
    tables = tuple(CapturedTable("s", n, {"id": "INT"}, ("id",)) for n in ("kept", "left"))
    ingest = Ingest(spark, PostgresSource("app", tables="s.kept, other.*"), tables, out)
    ingest.deliver(feed(spark, change("kept", 1, id=1), change("left", 1, id=2)), 0)
    assert rows(ingest.read(tables[0])) == [(1,)] and ingest.read(tables[1]).count() == 0
    with pytest.raises(ValueError):
        Ingest(spark, PostgresSource("app"), tables, out, metadata=("nothing",))
    with pytest.raises(ValueError):
        PostgresSource("app", time_units={"a": "days"})


def test_new_columns_only_where_the_source_may_change(spark, out):
    table = CapturedTable("s", "t", {"id": "INT"}, ("id",))
    for grows, want in ((True, [(1, None), (2, '{"a":1}'), (3, "x")]), (False, [(1,), (2,), (3,)])):
        ingest = Ingest(spark, PostgresSource("app", auto_schema_change=grows), (table,), f"{out}/{grows}")
        ingest.deliver(feed(spark, change("t", 1, id=1)), 0)
        ingest.deliver(feed(spark, change("t", 2, id=2, more={"a": 1}), change("t", 3, id=3, more="x")), 1)
        assert rows(ingest.read(table)) == want


def test_chunk_rows_give_way_to_the_log(spark):
    chunk = spark.createDataFrame([(1, "old"), (2, "old"), (3, "same")], "id int, v string")
    log = spark.createDataFrame([("u", (6, 0), 1, "new"), ("d", (7, 0), 2, None)], "_op string, _order struct<lsn:long,txId:long>, id int, v string")
    got = rows(snapshot_chunk(chunk, log, ["id"], {"lsn": 9}).select("_op", "_order.lsn", "id", "v"))
    assert got == [("r", 9, 3, "same")]


def test_rollup_parts_survive_replays_and_folds(spark, out):
    measures = [Measure("n", F.count(F.lit(1)), F.sum), Measure("top", F.max("x"), F.max)]
    rng = random.Random(6)
    items = [(rng.choice("ab"), f"2024-01-{rng.randint(1, 9):02d} 0{rng.randint(0, 9)}:30:00", rng.randint(0, 99)) for _ in range(90)]
    for i in range(6):
        part = spark.createDataFrame(items[i::6], "k string, at string, x int").withColumn("at", F.col("at").cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(f"{out}/log")
    stream = lambda: spark.readStream.schema("k string, at timestamp_ntz, x int").option("maxFilesPerTrigger", 1).parquet(f"{out}/log")
    rollup_parts(stream(), f"{out}/t", ["k"], "at", "1 hour", measures, f"{out}/cp").awaitTermination()
    want = {}
    for k, at, x in items:
        n, top = want.get((k, at[:13]), (0, -1))
        want[k, at[:13]] = (n + 1, max(top, x))
    read = lambda: {(r.k, str(r.bucket_start)[:13]): (r.n, r.top) for r in read_rollup(spark, f"{out}/t", ["k"], measures).collect()}
    assert read() == want
    fold_rollup(spark, f"{out}/t", ["k"], measures)
    assert read() == want and len(BatchTable(spark, f"{out}/t")._parts()) == 2


def test_times_have_the_unit_of_their_column(spark):
    columns = {"s": "TIMESTAMP", "n": "TIMESTAMP", "m": "TIMESTAMP", "d": "DATE"}
    message = {"s": 1700000000123, "n": 1699999999999999999, "m": 1700000000123457, "d": 1}
    got = accepted(decode.decode_json(feed(spark, message, {"n": -1}), columns, unit={"s": "millis", "n": "nanos"})).collect()
    assert [str(x) for x in got[0]] == ["2023-11-14 22:13:20.123000", "2023-11-14 22:13:19.999999", "2023-11-14 22:13:20.123457", "1970-01-02"]
    assert str(got[1]["n"]) == "1969-12-31 23:59:59.999999"


def test_documents_without_patches_are_not_parsed(spark):
    changes = [
        ("a", 1, "x", "set", "1", None), ("a", 2, "", "set", "as it came", None), ("b", 1, "", "set", "{}", None), ("b", 2, "", "remove", None, None),
        ("c", 1, "", "set", '{"l":[1,2]}', None), ("c", 2, "l#1", "cut", None, 1), ("d", 1, "p.q", "set", "2", None), ("e", 1, "", "set", '{"x":1}', None),
        ("e", 2, "#0", "cut", None, 0), ("f", 2, "", "remove", None, None), ("f", 3, "z", "set", "3", None),
    ]
    frame = spark.createDataFrame([(i, (o,), p, k, v, n) for i, o, p, k, v, n in changes], "_id string, _order struct<ts_us: bigint>, path string, kind string, value string, size int")
    assert rows(assembled(frame)) == [("a", "as it came"), ("c", '{"l":[1]}'), ("d", '{"p":{"q":2}}'), ("f", '{"z":3}')]


def test_documents_are_read_once_beside_the_filter_on_errors(spark):
    read = decode.decode_documents(feed(spark, ({"id": "1"}, {"op": "c", "after": {"_id": 1}, "source": {"ts_us": 1}})))
    good = accepted(read)
    assert good.count() == 1
    times = lambda df: df._jdf.queryExecution().executedPlan().toString().count("$.payload.id")
    assert times(good) == times(read) > 0


def test_a_batch_of_one_large_partition_is_dealt(spark, out, monkeypatch):
    from tidegate import connect
    from tidegate.operators.skew import dealt

    sizes = []

    def small(df, same):
        pieces = dealt(df, same, 50)
        sizes.append([r["n"] for r in pieces.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()])
        return pieces

    monkeypatch.setattr(connect, "dealt", small)
    table = CapturedTable("s", "t", {"id": "INT"}, ("id",))
    ingest = Ingest(spark, PostgresSource("app"), (table,), out)
    batch = feed(spark, *[change("t", i, id=i % 300) for i in range(400)], "none", "none", (None, None)).coalesce(1)
    for _ in range(2):
        ingest.deliver(batch, 0)
        assert rows(ingest.read(table)) == [(i,) for i in sorted(range(300), key=str)]
        assert rows(read_partitions(spark, f"{out}/_rejects/_unplaced")) == [("none", "no table named")] * 2
    assert all(sum(s) == 403 and len(s) > 4 and max(s) < 120 for s in sizes) and len(sizes) == 2


def test_repeats_are_dealt_as_they_lay_and_small_batches_stay(spark):
    from tidegate.operators.skew import dealt

    same = spark.range(0, 400, 1, 4).select(F.lit(None).cast("string").alias("k"), "id")
    got = dealt(same, ["k"], 20)
    assert got.rdd.getNumPartitions() == 20 and rows(got.select("id")) == rows(same.select("id"))
    assert len(got.groupBy(F.spark_partition_id()).count().collect()) > 1
    assert dealt(same, ["k"], 100) is same and dealt(same.limit(0), ["k"], 1).count() == 0


def test_one_table_is_written_without_bringing_it_together(spark, out, monkeypatch):
    from tidegate.sinks import lake

    met = []
    monkeypatch.setattr(lake, "bring_together", lambda df, on: met.append(on) or df)
    tables = tuple(CapturedTable("s", t, {"id": "INT"}, ("id",)) for t in "tu")
    for some, want in ((tables[:1], []), (tables, [["table"]] * 2)):
        ingest = Ingest(spark, PostgresSource("app"), some, f"{out}/{len(some)}")
        ingest.deliver(feed(spark, change("t", 1, id=1), change("t", 2, id=1), change("t", 3, op="d", id=2), change("u", 1, id=1)), 0)
        ingest.deliver(feed(spark, change("t", 2, id=2)), 1)
        for _ in range(2):
            assert met == want and [rows(ingest.read(t)) for t in some] == [[(1,)]] * len(some)
            ingest.maintain()


def test_new_columns_are_found_by_the_parse_that_names_the_table(spark, out):
    tables = [CapturedTable("s", "t", {"id": "INT"}, ("id",)), CapturedTable("s", "u", {"id": "INT", "a": "INT"}, ("id",))]
    ingest = Ingest(spark, PostgresSource("app", auto_schema_change=True), tuple(tables), out)
    wrapped = {"schema": {}, "payload": change("t", 2, id=2, b=None)}
    named = ingest._growing(feed(spark, change("t", 1, id=1, a=1), wrapped, change("u", 3, op="d", id=3, c={"x": 1}), "none", (None, None)), tables)
    assert rows(named.select("_table", "_more")) == [("t", ["a"]), ("t", ["b"]), ("u", ["c"]), (None, None), (None, None)]
    ingest.deliver(feed(spark, change("t", 1, id=1, a=1), wrapped, change("u", 3, id=3)), 0)
    assert rows(ingest.read(tables[0])) == [(1, "1", None), (2, None, None)] and rows(ingest.read(tables[1])) == [(3, None)]


def test_plain_numbers_as_document_ids_are_not_parsed_again(spark):
    ids = {'"7"': "7", "7": "7", '"007"': "007", '"a"': "a", '"\\"q\\""': "q", '{"$oid":"x"}': '{"$oid":"x"}', "-3": "-3"}
    messages = [(f'{{"id":{k}}}', {"op": "c", "after": {"_id": 0}, "source": {"ts_us": 1}}) for k in ids]
    messages.append(('{"payload":{"id":"8"}}', {"op": "c", "after": {"_id": 0}, "source": {"ts_us": 1}}))
    messages.append((None, {"op": "c", "after": {"_id": 9}, "source": {"ts_us": 1}}))
    assert rows(accepted(decode.decode_documents(feed(spark, *messages))).select("_id")) == sorted((v,) for v in [*ids.values(), "8", "9"])
