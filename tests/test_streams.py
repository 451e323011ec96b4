import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate import CapturedTable, ColumnSelection, Ingest, LakeTable, PostgresSource, TableColumns, TableSelector
from tidegate.operators import apply_latest, flatten_events
from tidegate.plans import fixtures as fx
from tidegate.session import shared_dir
from tidegate.sources import decode_changes
from tidegate.sources.feed import FEED_SCHEMA
from tidegate.streaming import complete_transactions, stream_to_lake

import pytest

SF_DIR = "/root/testdata/sf0.001"


def _files(df, path, n, seed):
    """Rows of ``df`` in n files, at random."""
    data = df.collect()
    random.Random(seed).shuffle(data)
    for i in range(n):
        df.sparkSession.createDataFrame(data[i::n], df.schema).coalesce(1).write.mode("append").parquet(path)


def test_shuffled_stream_equals_batch(spark, out):
    changes = fx.change_log(spark, SF_DIR)
    _files(changes, f"{out}/log", 6, seed=1)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/log")
    table = LakeTable(spark, f"{out}/table", ["user_id"], ["ts", "event_id"])
    stream_to_lake(stream, table, f"{out}/cp").awaitTermination()
    assert [len(b) for b in table._batches("delta").values()] == [6]
    expected = apply_latest(changes, ["user_id"], ["ts", "event_id"])
    assert rows(table.read()) == rows(expected)
    # a stream that starts over with a new checkpoint delivers everything again
    stream_to_lake(stream, table, f"{out}/cp2").awaitTermination()
    assert rows(table.read()) == rows(expected)


def test_rejects_are_kept(spark, out):
    log = fx.debezium_log(spark, SF_DIR)
    bad = spark.createDataFrame([(None, bytearray(b"{bad"), "t", 0, -1, None, [])], FEED_SCHEMA)
    log.unionByName(bad).write.parquet(f"{out}/log")

    def decode(batch):
        events = decode_changes(batch, PostgresSource("app"), fx.EVENT_COLUMNS)
        good = flatten_events(events.filter("_error IS NULL"))
        return good.unionByName(events.filter("_error IS NOT NULL").select("_raw", "_error"), allowMissingColumns=True)

    table = LakeTable(spark, f"{out}/table", ["user_id"], ["_order"], op="_op")
    stream = spark.readStream.schema(FEED_SCHEMA).parquet(f"{out}/log")
    stream_to_lake(stream, table, f"{out}/cp", decode, f"{out}/rejects").awaitTermination()
    assert rows(spark.read.parquet(f"{out}/rejects").drop("writer")) == [("{bad", "malformed JSON", 0)]
    expected = apply_latest(fx.change_log(spark, SF_DIR), ["user_id"], ["ts", "event_id"])
    assert rows(table.read().select("event_id")) == rows(expected.select("event_id"))


def _ingest(spark, out, **kwargs):
    take = TableColumns(
        "orders",
        (ColumnSelection("o_orderkey", "INT", primary_key=True), ColumnSelection("o_totalprice")),
        target_table="clean",
    )
    orders = CapturedTable("sales", "orders", fx.ORDER_COLUMNS, ("o_orderkey",), take)
    ingest = Ingest(spark, PostgresSource("app"), (orders,), out, TableSelector(include=("sales.o*",)), **kwargs)
    return ingest, orders


def test_ingest_stream(spark, out):
    log = fx.captured_log(spark, SF_DIR)
    _files(log, f"{out}/log", 3, seed=2)
    ingest, orders = _ingest(spark, f"{out}/lake")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/log")
    ingest.run(stream, f"{out}/cp").awaitTermination()
    source = fx.load(spark, SF_DIR, "orders")
    expected = source.filter("NOT (o_orderkey % 7 = 0 AND o_orderstatus = 'F')").select(
        F.col("o_orderkey").cast("int"), F.expr("o_totalprice + IF(o_orderkey % 7 = 0, 1, 0)").alias("o_totalprice")
    )
    assert ingest.read(orders).columns == ["o_orderkey", "o_totalprice"]
    assert rows(ingest.read(orders)) == rows(expected)
    ingest.maintain()
    assert rows(ingest.read(orders)) == rows(expected)


def test_ingest_without_snapshot(spark, out):
    ingest, orders = _ingest(spark, out, snapshot=False)
    ingest.deliver(fx.captured_log(spark, SF_DIR), 0)
    changed = fx.load(spark, SF_DIR, "orders").filter("o_orderkey % 7 = 0 AND o_orderstatus <> 'F'")
    assert ingest.read(orders).count() == changed.count()


def test_captured_table_needs_its_key():
    with pytest.raises(ValueError):
        CapturedTable("s", "t", {"id": "INT"}, ())
    with pytest.raises(ValueError):
        CapturedTable("s", "t", {"id": "INT", "v": "INT"}, ("id",), TableColumns("t", (ColumnSelection("v"),)))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_transactions_wait_until_they_are_whole(spark, out):
    def batch(*items):
        return spark.createDataFrame(list(items), "tx long, v string, n long")

    def step(batch_id, *items):
        return rows(complete_transactions(batch(*items), batch_id, out, "tx", "n", ["v"]))

    assert step(0, (1, "a", None), (2, "b", None), (2, None, 1), (3, None, 2)) == [(2, "b")]
    assert step(1, (1, None, 2), (3, "c", None)) == []
    second = ((1, "d", None), (4, "e", None))
    assert step(2, *second) == [(1, "a"), (1, "d")]
    # a replay finds the same transactions
    assert step(2, *second) == [(1, "a"), (1, "d")]
    assert step(3, (3, "f", None), (4, None, 1)) == [(3, "c"), (3, "f"), (4, "e")]
    assert step(4, (9, "z", None)) == []


def test_ingest_with_a_column_added_and_one_widened(spark, out):
    def feed(*after):
        values = [f'{{"op":"c","after":{a},"source":{{"schema":"s","table":"t","lsn":{i}}}}}' for i, a in enumerate(after)]
        return spark.createDataFrame([(bytearray(v.encode()),) for v in values], "value binary")

    def ingest(columns):
        table = CapturedTable("s", "t", columns, ("id",))
        return Ingest(spark, PostgresSource("app", auto_schema_change=True), (table,), out), table

    first, table = ingest({"id": "INT", "n": "INT"})
    first.deliver(feed('{"id":1,"n":5}'), 0)
    second, table = ingest({"id": "INT", "n": "BIGINT", "extra": "VARCHAR"})
    second.deliver(feed('{"id":2,"n":5000000000,"extra":"x"}'), 1)
    expected = [(1, 5, None), (2, 5000000000, "x")]
    assert rows(second.read(table)) == expected
    second.maintain()
    assert rows(second.read(table)) == expected
