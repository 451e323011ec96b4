import json

import pytest

from tests.conftest import rows
from tests.test_decode import feed
from tidegate import KafkaSource, Topic
from tidegate.operators import collection_stats

COLUMNS = {"id": "BIGINT", "name": "VARCHAR"}


def topic(fmt="PLAIN", encode="JSON", **kwargs):
    return Topic(KafkaSource("b:9092", "app.users-1", format=fmt, encode=encode), **{"columns": COLUMNS, **kwargs})


def stored(spark, t, path, *batches):
    for i, batch in enumerate(batches):
        t.store(batch, i, path)
    return rows(t.stored(batches[0], path))


def test_plain_topics_append(spark, out):
    t = topic(metadata={"offset": True, "key": True})
    one = feed(spark, {"id": 1, "name": "a"}, "{bad", {"id": 1, "name": "a"})
    got = stored(spark, t, out, one, feed(spark, {"id": 2}))
    assert got == [(1, "a", None, 0), (1, "a", None, 2), (2, None, None, 0)]
    t.store(one, 0, out)
    assert rows(t.stored(one, out)) == got
    assert rows(spark.read.parquet(f"{out}/_rejects/app_users_1").drop("writer")) == [("{bad", "malformed JSON", 0)]
    assert t.view(one) == "app_users_1"
    assert spark.table("app_users_1").count() == 2


def test_csv_and_bytes_topics(spark, out):
    assert rows(topic(encode="CSV").rows(feed(spark, "1,a", "x,b"))) == [(1, "a")]
    data = topic(encode="BYTES", columns={"body": "BYTEA"})
    assert [bytes(r[0]) for r in stored(spark, data, out, feed(spark, "abc"))] == [b"abc"]


def test_upsert_topics(spark, out):
    messages = [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}, None, {"id": 2, "name": "c"}]
    keys = [{"id": 1}, {"id": 2}, {"id": 1}, {"id": 2}]
    df = feed(spark, *messages, keys=keys)
    named = topic("UPSERT", primary_key=("id",), key_columns={"id": "BIGINT"})
    assert rows(named.rows(df)) == [(2, "c")]
    assert stored(spark, named, out, df.filter("offset >= 2"), df.filter("offset < 2")) == [(2, "c")]
    with_offset = topic("UPSERT", primary_key=("id",), key_columns={"id": "BIGINT"}, metadata={"key": True, "offset": True})
    assert rows(with_offset.rows(df)) == [(2, "c", 3)]
    assert rows(topic("UPSERT").rows(df)) == [('{"id": 2}', 2, "c")]


@pytest.mark.parametrize(
    "fmt, messages",
    [
        ("DEBEZIUM", [{"op": o, k: v, "source": {"lsn": n}} for n, (o, k, v) in enumerate(
            [("c", "after", {"id": 1, "name": "a"}), ("c", "after", {"id": 2, "name": "b"}), ("d", "before", {"id": 1})])]),
        ("MAXWELL", [{"type": t, "data": d} for t, d in
            [("insert", {"id": 1, "name": "a"}), ("insert", {"id": 2, "name": "b"}), ("delete", {"id": 1, "name": "a"})]]),
        ("CANAL", [{"type": t, "data": [d]} for t, d in
            [("INSERT", {"id": "1", "name": "a"}), ("INSERT", {"id": "2", "name": "b"}), ("DELETE", {"id": "1"})]]),
    ],
)
def test_change_topics(spark, out, fmt, messages):
    t = topic(fmt, primary_key=("id",))
    df = feed(spark, *map(json.dumps, messages))
    assert rows(t.rows(df)) == [(2, "b")]
    with_metadata = topic(fmt, primary_key=("id",), metadata={"offset": True, "partition": True})
    assert rows(with_metadata.rows(df)) == [(2, "b", 1, 1)]
    # the delete arrives before the insert it undoes
    assert stored(spark, t, out, df.filter("offset >= 1"), df.filter("offset < 1")) == [(2, "b")]


def test_topics_refused():
    for kwargs in ({"encode": "AVRO"}, {"encode": "PARQUET"}, {"columns": {}}, {"fmt": "DEBEZIUM"}, {"fmt": "UPSERT", "primary_key": ("id",)}):
        with pytest.raises(ValueError):
            topic(**kwargs)


def test_system_collections(spark):
    df = spark.createDataFrame(
        [("app", "users", "{}"), ("app", "system.indexes", "{}"), ("admin", "x", "{}"), ("app", "users", None)],
        "db string, collection string, payload string",
    )
    assert rows(collection_stats(df, database="db")) == [("app", "users", 2, 2)]
