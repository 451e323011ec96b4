"""Messages as the public formats write them, and what becomes of faulty ones."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate.connect import CapturedTable, Ingest
from tidegate.sinks.config import SearchSink
from tidegate.sinks.jdbc import merge_statements
from tidegate.sinks.lake import LakeTable, merge_sql, read_partitions
from tidegate.sinks.search import bulk_docs, cut_points, deliver, number_batches, pack_requests
from tidegate.functions.typemap import map_type
from tidegate.sources import KafkaSource, PostgresSource, decode
from tidegate.sources.backfill import SplitPlan, range_predicates, sql_literal, uneven_edges, uneven_predicates
from tidegate.topic import Topic


def feed(spark, *values, keys=None):
    keys = keys or [None] * len(values)
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(zip(keys, values))], "key string, value string, offset long")
    return df.withColumn("value", F.col("value").cast("binary")).withColumn("key", F.col("key").cast("binary"))


TYPES = {"id": "BIGINT", "ts": "TIMESTAMP", "tz": "TIMESTAMPTZ", "d": "DATE", "v": "VARCHAR(3)", "j": "JSONB", "b": "BYTEA"}


@pytest.mark.parametrize(
    "text,error",
    [
        ('{"id":1,"ts":"2024-01-02T03:04:05.5","tz":"2024-01-02T03:04:05Z","d":"2024-01-02","v":"abc","j":{"a":1},"b":"AQI="}', None),
        ('{"id":1,"ts":1704164645500000,"tz":1704164645000000,"d":19724}', None),
        ('{"id":1,"ts":null,"extra":2}', None),
        ('{"id":1}{"id":2}', "malformed JSON"),
        ('{"id":1}\n{"id":2}', "malformed JSON"),
        ('{"id":1},{"id":2}', "malformed JSON"),
        ('{"id":"x"}', "malformed JSON"),
        ("", "malformed JSON"),
        (None, "malformed JSON"),
        ('{"id":1,"ts":"yesterday"}', "cast failed: ts"),
        ('{"id":1,"v":"abcd","j":"not json","b":"?","d":"x"}', "cast failed: d,v,j,b"),
    ],
)
def test_json_messages(spark, text, error):
    row = decode.decode_json(feed(spark, text), TYPES).first()
    assert row["_error"] == error and (row["_raw"] == text) == (error is not None or text is None)
    if error is None and "2024" in text:
        assert (row["ts"], row["d"]) == (dt.datetime(2024, 1, 2, 3, 4, 5, 500000), dt.date(2024, 1, 2))
        assert (row["v"], bytes(row["b"])) == ("abc", b"\x01\x02")


@pytest.mark.parametrize("unit,number", [("millis", 1704164645500), ("micros", 1704164645500000), ("nanos", 1704164645500000001)])
def test_units_of_times(spark, unit, number):
    row = decode.decode_json(feed(spark, f'{{"ts":{number}}}'), {"ts": "TIMESTAMP"}, unit=unit).first()
    assert row["ts"] == dt.datetime(2024, 1, 2, 3, 4, 5, 500000)
    with pytest.raises(ValueError):
        PostgresSource("app", time_unit="weeks")


def test_wrapped_and_plain_envelopes(spark):
    plain = '{"op":"c","after":{"id":1},"source":{"db":"a","table":"t","lsn":5,"txId":1,"ts_ms":7}}'
    wrapped = f'{{"schema":{{"type":"struct","fields":[]}},"payload":{plain}}}'
    got = decode.decode_debezium(feed(spark, plain, wrapped, wrapped + plain), {"id": "INT"}).collect()
    assert [r["_error"] for r in got] == [None, None, "malformed JSON"]
    assert got[0]["after"] == got[1]["after"] and got[0]["order_key"] == got[1]["order_key"]
    assert all(r["commit_ts"].microsecond == 7000 for r in got[:2])


def test_maxwell_tells_null_from_unchanged(spark):
    head = '{"database":"d","table":"t","type":"update","ts":1,"xid":2,'
    texts = [
        head + '"data":{"id":1,"a":"x","n":5,"at":"2024-01-02 03:04:05"},"old":{"a":null}}',
        head + '"data":{"id":1,"a":"x","n":5,"at":null},"old":{"n":4,"at":"2024-01-02 03:04:05"}}',
        head + '"data":{"id":1,"a":"x","n":5},"old":{"n":"many"}}',
    ]
    got = decode.decode_maxwell(feed(spark, *texts), {"id": "INT", "a": "VARCHAR", "n": "INT", "at": "TIMESTAMP"}).collect()
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert tuple(got[0]["before"]) == (1, None, 5, at) and tuple(got[1]["before"]) == (1, "x", 4, at)
    assert tuple(got[1]["after"]) == (1, "x", 5, None) and got[2]["_error"] == "cast failed: n"


def test_canal_tells_null_from_unchanged(spark):
    text = (
        '{"data":[{"id":"1","a":"x"},{"id":"2","a":"y"}],"old":[{"a":null},{"id":"9"}],"database":"d","table":"t","type":"UPDATE",'
        '"es":1,"isDdl":false}'
    )
    got = decode.decode_canal(feed(spark, text), {"id": "INT", "a": "VARCHAR"}).collect()
    assert [tuple(r["before"]) for r in got] == [(1, None), (9, "y")]


def test_unreadable_upsert_keys_are_rejected(spark):
    values, keys = ['{"id":1,"v":2}', None, None, '{"v":3}'], ['{"id":1}', "?", '{"id":4}', '{"x":1}']
    got = decode.decode_upsert(feed(spark, *values, keys=keys), {"id": "INT", "v": "INT"}, {"id": "INT"}).collect()
    assert [(r["_op"], r["id"], r["_error"]) for r in got] == [
        ("u", 1, None), ("d", None, "unreadable key"), ("d", 4, None), ("u", None, "unreadable key"),
    ]


def test_header_only_csv_carries_no_row(spark):
    got = decode.decode_csv(feed(spark, "id,v\n1,x", "id,v", "id,v\n"), {"id": "INT", "v": "VARCHAR"}, without_header=False)
    assert [(r["id"], r["v"], r["_error"]) for r in got.collect()] == [(1, "x", None)]


def test_ingest_keeps_what_it_cannot_place(spark, out):
    place = '"source":{"db":"app","schema":"s","table":"%s","lsn":%s,"txId":%s}}'
    texts = [
        '{"op":"c","after":{"id":1,"v":1},' + place % ("t", 1, 1),
        '{"op":"c","after":{"id":null,"v":1},' + place % ("t", 2, 1),
        '{"op":"c","after":{"id":2,"v":1},' + place % ("t", "null", "null"),
        '{"op":"c","after":{"id":3,"v":1},' + place % ("other", 3, 1),
        "garbage",
        None,
    ]
    ingest = Ingest(spark, PostgresSource("app"), (CapturedTable("s", "t", {"id": "INT", "v": "INT"}, ("id",)),), out)
    for _ in range(2):  # a replay changes nothing
        ingest.deliver(feed(spark, *texts), 0)
    assert rows(ingest.read(ingest.tables[0])) == [(1, 1)]
    assert rows(read_partitions(spark, f"{out}/_rejects/t").select("error")) == [("null key",), ("null order key",)]
    assert rows(read_partitions(spark, f"{out}/_rejects/_unplaced")) == [("garbage", "no table named"), (texts[3], "table not declared")]


def test_lake_read_has_added_columns(spark, out):
    table = LakeTable(spark, out, ["k"], ["o"])
    table.append_batch(spark.createDataFrame([(1, 1, "u")], "k int, o int, op string"), 0)
    table.append_batch(spark.createDataFrame([(2, 2, "u", "new")], "k int, o int, op string, c string"), 1)
    assert rows(table.read().select("k", "c")) == [(1, None), (2, "new")]
    table.compact()
    assert rows(table.read().select("k", "c")) == [(1, None), (2, "new")]


def test_upserts_keep_the_later_row():
    sql = merge_sql("t", "s", ["k", "v", "o", "p"], ["k"], order_by=["o", "p"])
    later = "t.`o` IS NULL OR s.`o` > t.`o` OR (s.`o` = t.`o` AND (t.`p` IS NULL OR s.`p` > t.`p` OR s.`p` = t.`p`))"
    assert sql.count(f"AND ({later})") == 2
    delete, insert = merge_statements("t", "s", ["k", "v", "o"], ["k"], order_by=["o"])
    assert delete.endswith("AND (s.\"o\") >= (t.\"o\")") and insert.endswith('WHERE (EXCLUDED."o") >= (t."o")')
    assert '"t" AS t ("k"' in insert


def test_strided_ids_spread_over_lanes(spark):
    docs = spark.range(4000).select((F.col("id") * 1000).alias("id"))
    sizes = [r["count"] for r in number_batches(docs, "id", 50, rows_per_lane=400).groupBy("lane").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 600


def test_cut_points():
    lengths = np.array([5, 5, 50, 1, 1, 1, 9])
    assert cut_points(lengths, float("inf"), 10) == [0, 2, 3, 6]
    assert cut_points(lengths, 2, 100) == [0, 2, 4, 6]
    assert cut_points(lengths[:0], 2, 100) == []


def test_requests_are_bounded_by_default(spark):
    docs = bulk_docs(
        spark.range(40).select("id", F.repeat(F.lit("x"), 500_000).alias("t")).coalesce(1), SearchSink("http://x", "i", primary_key="id")
    )
    got = pack_requests(docs).select("docs", "bytes").collect()
    assert len(got) > 3 and sum(r["docs"] for r in got) == 40 and max(r["bytes"] for r in got) <= 5 * 1024 * 1024


def test_one_request_for_an_id(spark, out, tmp_path):
    changes = spark.createDataFrame([(1, 1, "u"), (1, 2, "d"), (2, 1, "u"), (None, 1, "u")], "k int, o int, op string")
    sink = SearchSink("http://x", "i", primary_key="k")
    with pytest.raises(ValueError):
        deliver(changes, sink, print, order_by=["o"])
    sent = str(tmp_path)

    def send(body):
        import uuid

        with open(f"{sent}/{uuid.uuid4().hex}", "w") as f:
            f.write(body)

    deliver(changes, sink, send, order_by=["o"], reject_path=out)
    text = "".join(p.read_text() for p in tmp_path.iterdir() if p.is_file())
    assert text.count('"_id":"1"') == 1 and '{"delete":{"_index":"i","_id":"1"' in text and '"_id":"2"' in text
    assert rows(spark.read.parquet(out).select("error")) == [("null document id",)]


def test_split_literals(spark):
    assert sql_literal("O'Hara") == "'O''Hara'" and sql_literal(dt.date(2024, 1, 1)) == "DATE '2024-01-01'"
    days = spark.range(1000).select(F.date_add(F.lit("2024-01-01"), (F.col("id") % 300).cast("int")).alias("d"))
    days = days.union(spark.createDataFrame([(None,)], "d date"))
    parts = range_predicates("d", uneven_edges(days, "d", 100))
    assert len(parts) > 5 and sum(days.filter(p).count() for p in parts) == 1001


def test_splits_of_large_keys(spark):
    low = 2**62
    plan = SplitPlan("k", low, low + 99, 10)
    keys = spark.range(100).select((F.lit(low) + F.col("id")).alias("k"))
    assert [r["n"] for r in keys.groupBy(plan.split_of().alias("s")).agg(F.count("*").alias("n")).collect()] == [10] * 10


def test_writers_keep_their_own_batches(spark, out):
    table = LakeTable(spark, out, ["k"], ["o"])
    make = lambda *items: spark.createDataFrame([(*i, "u") for i in items], "k int, o int, op string")
    table.append_batch(make((1, 1), (2, 1)), 0, "snapshot")
    table.append_batch(make((2, 2)), 0, "stream-a")
    table.append_batch(make((3, 3)), 1, "stream-a")
    assert rows(table.read()) == [(1, 1), (2, 2), (3, 3)]
    assert table.compact() == 1
    table.append_batch(make((4, 4)), 0, "stream-b")  # a new checkpoint counts from 0 again
    table.append_batch(make((9, 9)), 1, "stream-a")  # a replay of a folded batch
    want = [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert rows(table.read()) == want
    assert table.expire() == [0, 0, 1] and rows(table.read()) == want
    assert table.compact() == 2 and table.compact() == 2 and rows(table.read()) == want
    with pytest.raises(ValueError):
        table.append_batch(make((1, 1)), 0, "a/b")


def test_csv_messages_of_several_lines(spark):
    got = decode.decode_csv(feed(spark, 'a,1\r\n"b\nc",2\n\n', "d,3", "e,x\nf,4"), {"v": "VARCHAR", "n": "INT"})
    assert rows(got.filter("_error IS NULL").select("v", "n")) == [("a", 1), ("b\nc", 2), ("d", 3), ("f", 4)]
    assert rows(got.filter("_error IS NOT NULL").select("_raw", "_error")) == [("e,x", "cast failed: n")]


@pytest.mark.parametrize(
    "dialect, upstream, target",
    [
        ("mysql", "decimal(10,2)", "DECIMAL(10,2)"),
        ("mysql", "int(10) unsigned", map_type("mysql", "INT UNSIGNED")),
        ("mysql", "bigint(20)", "BIGINT"),
        ("mysql", "varchar(20)", "VARCHAR(20)"),
        ("mysql", "decimal(65,30)", "DECIMAL"),
        ("mysql", "something(3)", "VARCHAR"),
        ("sqlserver", "decimal(18, 2)", "DECIMAL(18,2)"),
        ("sqlserver", "nvarchar(50)", "VARCHAR(50)"),
        ("sqlserver", "nvarchar(max)", "VARCHAR"),
        ("sqlserver", "datetime2(7)", "TIMESTAMP"),
        ("sqlserver", "money", "DECIMAL(19,4)"),
    ],
)
def test_types_with_parameters(dialect, upstream, target):
    assert map_type(dialect, upstream) == target


def test_topics_know_their_units_and_check_headers(spark):
    source = KafkaSource("b:1", "t", time_unit="millis", time_units={"n": "nanos"})
    topic = Topic(source, {"at": "TIMESTAMP", "n": "TIMESTAMP"}, metadata={"header_fields": {"size": "INT", "name": "VARCHAR"}})
    values = ['{"at":1700000000123,"n":1700000000123456999}', '{"at":1}', "bad"]
    heads = [[("size", b"5"), ("name", b"x")], [("size", b"five")], [("size", b"six")]]
    made = [(bytearray(v.encode()), [(k, bytearray(b)) for k, b in h]) for v, h in zip(values, heads)]
    messages = spark.createDataFrame(made, "value binary, headers array<struct<key: string, value: binary>>")
    got = topic.decode(messages).orderBy("_error").collect()
    assert [(r["_error"], r["_raw"]) for r in got] == [(None, None), ("cast failed: size", values[1]), ("malformed JSON", "bad")]
    assert (str(got[0]["at"]), str(got[0]["n"]), got[0]["size"]) == ("2023-11-14 22:13:20.123000", "2023-11-14 22:13:20.123456", 5)
    debezium = Topic(KafkaSource("b:1", "t", format="DEBEZIUM", time_unit="millis"), {"id": "INT", "at": "TIMESTAMP"}, ("id",))
    text = '{"op":"c","after":{"id":1,"at":1700000000123},"source":{"lsn":1}}'
    events = debezium.decode(feed(spark, text)).collect()
    assert str(events[0]["after"]["at"]) == "2023-11-14 22:13:20.123000"


@pytest.mark.parametrize("second", [None, "s"])
def test_uneven_predicates_take_every_row_once(spark, second):
    keys = [None] * 300 + [5] * 400 + list(range(200))
    df = spark.createDataFrame([(k, i if i % 50 else None) for i, k in enumerate(keys)], "k int, s int")
    df = df.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), "k"))
    for column in ("k", "day"):
        found = uneven_predicates(df, column, 50, second)
        sizes = [df.filter(p).count() for p in found]
        assert sum(sizes) == len(keys) and df.filter(" OR ".join(found)).count() == len(keys)
        assert not second or max(sizes) <= 110
    assert uneven_predicates(df.limit(0), "k", 50, second) == ["(k IS NOT NULL)", "(k IS NULL)"]
