import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate.sources import (
    KafkaSource,
    MongoSource,
    MySqlSource,
    PostgresSource,
    SqlServerSource,
    accepted,
    after_offsets,
    decode_bytes,
    decode_canal,
    decode_csv,
    decode_debezium,
    decode_json,
    decode_key,
    decode_maxwell,
    decode_upsert,
    end_offsets,
    from_timestamp,
    metadata_columns,
    plan_even_splits,
    range_predicates,
    rejected,
    uneven_edges,
)
from tidegate.sources.feed import FEED_SCHEMA

COLUMNS = {"id": "BIGINT", "name": "VARCHAR", "at": "TIMESTAMP", "raw": "BYTEA"}


def feed(spark, *values, keys=None):
    def text(v):
        return None if v is None else bytearray((v if isinstance(v, str) else json.dumps(v)).encode())

    data = [
        (text(k), text(v), "t", i % 2, i, None, [])
        for i, (v, k) in enumerate(zip(values, keys or [None] * len(values)))
    ]
    return spark.createDataFrame(data, FEED_SCHEMA)


def test_json(spark):
    df = decode_json(
        feed(spark, {"id": 1, "name": "a", "at": 1_000_001, "raw": "aGk="}, {"id": "x"}, "{oops", {"id": 2}, None),
        COLUMNS,
        metadata_columns(offset=True),
    )
    good = accepted(df).orderBy("id").collect()
    assert [(r.id, r.name, r.raw, r.kafka_offset) for r in good] == [(1, "a", bytearray(b"hi"), 0), (2, None, None, 3)]
    assert good[0]["at"].microsecond == 1
    assert rows(rejected(df).select("kafka_offset", "_raw")) == [(1, '{"id": "x"}'), (2, "{oops"), (4, None)]


@pytest.mark.parametrize("header", [False, True])
def test_csv(spark, header):
    lines = ['1;"a;b";2.5', "x;c;1", "2;d"]
    values = [f"id;name;n\n{line}" if header else line for line in lines]
    df = decode_csv(feed(spark, *values), {"id": "INT", "name": "VARCHAR", "n": "DOUBLE"}, ";", without_header=not header)
    assert rows(accepted(df)) == [(1, "a;b", 2.5)]
    assert rows(rejected(df).select("_error")) == [("cast failed: id",), ("malformed CSV",)]


def test_bytes_and_key(spark):
    df = feed(spark, "abc", keys=[{"id": 7}])
    assert bytes(decode_bytes(df).first().id) == b"abc"
    assert df.select(decode_key({"id": "INT"})["id"]).first()[0] == 7
    assert bytes(df.select(decode_key(None, "BYTES")).first()[0]) == b'{"id": 7}'
    with pytest.raises(ValueError):
        decode_key(None, "JSON")


def test_debezium(spark):
    src = {"lsn": 5, "ts_us": 1, "db": "d", "schema": "s", "table": "t", "txId": 3}
    df = decode_debezium(
        feed(
            spark,
            {"op": "c", "after": {"id": 1}, "source": src},
            {"op": "d", "before": {"id": 1}, "source": src},
            None,
            {"op": "u", "before": {"id": 1}, "source": src},
            {"op": "t", "source": src},
            {"op": "d", "after": {"id": 1}},
            "nope",
        ),
        {"id": "BIGINT"},
    )
    assert [(r.op, r.before, r.after, r.order_key.lsn, r.db, r.schema, r.table, r.txid) for r in accepted(df).collect()] == [
        ("c", None, (1,), 5, "d", "s", "t", 3),
        ("d", (1,), None, 5, "d", "s", "t", 3),
    ]
    assert rows(rejected(df).select("_error")) == [
        ("malformed JSON",),
        ("no after image",),
        ("no before image",),
        ("unknown operation",),
    ]


def test_maxwell(spark):
    df = decode_maxwell(
        feed(
            spark,
            {"type": "bootstrap-start", "table": "t"},
            {"type": "bootstrap-insert", "data": {"id": 1, "name": "a"}},
            {"type": "update", "data": {"id": 2, "name": "b"}, "old": {"id": 1}},
            {"type": "delete", "data": {"id": 2, "name": "b"}},
            {"type": "table-alter"},
        ),
        {"id": "BIGINT", "name": "VARCHAR"},
    )
    assert rows(accepted(df).select("op", "before", "after")) == [
        ("d", (2, "b"), None),
        ("r", None, (1, "a")),
        ("u", (1, "b"), (2, "b")),
    ]
    assert rows(rejected(df).select("_error")) == [("unknown operation",)]


def test_canal(spark):
    df = decode_canal(
        feed(
            spark,
            {"type": "CREATE", "isDdl": True},
            {"type": "INSERT", "isDdl": False, "data": [{"id": "1", "name": "a"}, {"id": "2", "name": None}]},
            {"type": "UPDATE", "data": [{"id": "3", "name": "n"}], "old": [{"id": "1"}]},
            {"type": "DELETE", "data": [{"id": "x", "name": "n"}]},
        ),
        {"id": "INT", "name": "VARCHAR"},
    )
    assert rows(accepted(df).select("op", "before", "after", "order_key")) == [
        ("c", None, (1, "a"), (1, 0)),
        ("c", None, (2, None), (1, 1)),
        ("u", (1, "n"), (3, "n"), (2, 0)),
    ]
    assert rows(rejected(df).select("_error")) == [("cast failed: id",)]


def test_upsert(spark):
    df = decode_upsert(
        feed(spark, {"id": 1, "name": "a"}, None, "{bad", {"id": 4}, keys=[{"id": 1}, {"id": 2}, {"id": 3}, None]),
        {"id": "BIGINT", "name": "VARCHAR"},
        {"id": "BIGINT"},
    )
    assert rows(accepted(df).select("_op", "id", "name")) == [("d", 2, None), ("u", 1, "a")]
    assert rows(rejected(df).select("_error")) == [("malformed JSON",), ("no key",)]


def test_key_names():
    def names(**kwargs):
        return [c._jc.toString().split(" AS ")[-1] for c in metadata_columns(key=True, payload=True, **kwargs)]

    pytest.importorskip("pyspark")
    assert names() == ["kafka_key", "kafka_payload"]
    assert names(message_format="UPSERT") == ["rw_key", "kafka_payload"]
    assert names(message_format="UPSERT", stored=False) == ["kafka_key", "kafka_payload"]
    assert names(encode="BYTES") == ["kafka_key"]


def test_scans(spark):
    df = feed(spark, *"abcdef").withColumn("timestamp", F.timestamp_seconds("offset"))
    assert [r.offset for r in from_timestamp(df, 4000).orderBy("offset").collect()] == [4, 5]
    ends = end_offsets(df.filter("offset < 3"))
    assert [r.offset for r in after_offsets(df, ends).orderBy("offset").collect()] == [3, 4, 5]
    assert after_offsets(df, ends.filter("partition = 0")).count() == 1 + 3


def test_splits_cover_every_row_once(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 50 != 0, F.col("id") * F.col("id") % 997).alias("k"))
    plan = plan_even_splits(df, "k", 90)
    assert plan.splits == 12
    for predicates in (plan.predicates(), range_predicates("k", uneven_edges(df, "k", 90))):
        assert sum(df.filter(p).count() for p in predicates) == 1000
        assert sum(df.filter(f"k IS NULL AND {p}").count() for p in predicates) == 20
    by_split = df.groupBy(plan.split_of().alias("s")).count().collect()
    assert {r.s: r["count"] for r in by_split} == {i: df.filter(p).count() for i, p in enumerate(plan.predicates()) if df.filter(p).count()}
    sizes = [df.filter(p).count() for p in range_predicates("k", uneven_edges(df, "k", 90))]
    assert max(sizes[1:]) < 130
    assert plan_even_splits(df.filter("k < 0"), "k", 10).predicates() == ["1 = 1"]


@pytest.mark.parametrize(
    "kwargs",
    [
        {"format": "NOPE"},
        {"encode": "XML"},
        {"start": "middle"},
        {"start": "timestamp"},
        {"format": "UPSERT", "encode": "CSV"},
        {"format": "DEBEZIUM", "encode": "AVRO"},
        {"topic": ""},
    ],
)
def test_bad_topics(kwargs):
    with pytest.raises(ValueError):
        KafkaSource(**{"bootstrap_servers": "b:9092", "topic": "t", **kwargs})


def test_topic_options():
    source = KafkaSource("b:9092", "app.user-events", start="timestamp", start_millis=5, options={"minPartitions": "64"})
    assert source.table_name == "app_user_events"
    assert source.reader_options() == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "app.user-events",
        "startingTimestamp": "5",
        "minPartitions": "64",
    }
    assert KafkaSource("b", "t", start="latest").reader_options()["startingOffsets"] == "latest"


def test_database_sources():
    assert PostgresSource("d").order == ("lsn", "txId")
    assert SqlServerSource("d", tables="dbo.*, sales.orders, hr.employees, x").schemas == ["dbo", "sales", "hr"]
    assert MySqlSource("d", server_time_zone="Asia/Tokyo").order_ddl == "file string, pos bigint"
    assert MongoSource("d", tables="db1.*, db2.orders").patterns == ["db1.*", "db2.orders"]
    for bad in ({"database": " "}, {"database": "d", "tables": ""}, {"database": "d", "snapshot_batch_size": 0}):
        with pytest.raises(ValueError):
            PostgresSource(**bad)
