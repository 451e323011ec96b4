import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate.sinks import (
    FileSink,
    JdbcSink,
    LakeSink,
    LakeTable,
    SearchSink,
    append_table,
    bulk_docs,
    deliver_tables,
    encode_debezium,
    encode_upsert,
    fan_out,
    fan_out_table,
    merge_sql,
    merge_statements,
    ndjson,
    number_batches,
    pack_requests,
    read_files,
    route,
    send_requests,
    sink_input,
    split_unkeyed_docs,
    split_unknown_fields,
    upsert_rows,
    write_files,
    write_ndjson,
)

LOG = "k long, v string, pos long, op string"


def log(spark, *items):
    return spark.createDataFrame(list(items), LOG)


@pytest.fixture
def table(spark, out):
    return LakeTable(spark, out, ["k"], ["pos"])


def state(table):
    return {r.k: r.v for r in table.read().collect()}


def test_lake_random_batches_with_upkeep(spark, table):
    rng = random.Random(3)
    items = [(rng.randrange(20), str(i), i, rng.choice("cuud")) for i in range(200)]
    expected = {}
    for k, v, _, op in items:
        expected.pop(k, None) if op == "d" else expected.update({k: v})
    rng.shuffle(items)
    for batch in range(5):
        table.append_batch(log(spark, *items[batch * 40 : batch * 40 + 40]), batch)
        if batch == 2:
            assert table.compact() == 2
            assert table.expire() == [0, 1, 2]
    assert state(table) == expected
    assert table.compact() == 4
    assert state(table) == expected
    assert table.expire(keep_batches=1) == [3]
    assert state(table) == expected
    # compacting again after everything was folded must not lose the base
    assert table.compact() == 4
    assert state(table) == expected
    table.append_batch(log(spark, *items[160:]), 4)
    assert state(table) == expected


def test_late_change_loses_to_a_folded_tombstone(spark, table):
    table.append_batch(log(spark, (1, "new", 5, "u"), (2, None, 6, "d")), 0)
    table.compact()
    table.expire()
    table.append_batch(log(spark, (1, "late", 4, "u"), (2, "late", 3, "u")), 1)
    assert state(table) == {1: "new"}


def test_unfinished_base_is_not_trusted(spark, table):
    table.append_batch(log(spark, (1, "a", 1, "u")), 0)
    table.append_batch(log(spark, (2, "b", 2, "u")), 1)
    # a base without its mark, as a compaction that died leaves it
    table._write(log(spark, (1, "a", 1, "u")), "base", 1)
    assert table.expire() == []
    assert table.compact() == 1
    assert table.expire() == [0, 1]
    assert state(table) == {1: "a", 2: "b"}


def test_lake_columns_may_be_added(spark, table):
    table.append_batch(log(spark, (1, "a", 1, "u")), 0)
    table.append_batch(log(spark, (2, "b", 2, "u")).withColumn("extra", F.lit(7)), 1)
    assert rows(table.read(evolving=True).select("k", "extra")) == [(1, None), (2, 7)]
    table.compact()
    table.expire()
    assert rows(table.read(evolving=True).select("k", "extra")) == [(1, None), (2, 7)]


def test_append_table(spark, out):
    sink = LakeSink(out, "db", "t")
    append_table(log(spark, (1, "a", 1, "c"), (1, None, 2, "d")), sink)
    append_table(log(spark, (2, "b", 3, "u")), sink)
    assert rows(spark.read.parquet(sink.path).select("k", "v")) == [(1, "a"), (2, "b")]


def test_merge_text():
    assert merge_sql("`c`.`d`.`t`", "s", ["k", "v"], ["k"]) == (
        "MERGE INTO `c`.`d`.`t` t USING s s ON t.`k` = s.`k` "
        "WHEN MATCHED AND s.`op` = 'd' THEN DELETE WHEN MATCHED THEN UPDATE SET t.`v` = s.`v` "
        "WHEN NOT MATCHED AND s.`op` <> 'd' THEN INSERT (`k`, `v`) VALUES (s.`k`, s.`v`)"
    )


def test_jdbc_text_and_rows(spark):
    delete, insert = merge_statements("public.t", "public.t_stage", ["k", 'a"b'], ["k"])
    assert delete == 'DELETE FROM "public"."t" AS t USING "public"."t_stage" AS s WHERE t."k" = s."k" AND s."op" = \'d\''
    assert insert == (
        'INSERT INTO "public"."t" ("k", "a""b") SELECT "k", "a""b" FROM "public"."t_stage" WHERE "op" <> \'d\' '
        'ON CONFLICT ("k") DO UPDATE SET "a""b" = EXCLUDED."a""b"'
    )
    assert merge_statements("t", "s", ["k"], ["k"])[1].endswith('ON CONFLICT ("k") DO NOTHING')
    staged = upsert_rows(log(spark, (1, "a", 1, "c"), (1, "b", 2, "r"), (2, None, 3, "d")), ["k"], ["pos"])
    assert rows(staged.select("k", "v", "op")) == [(1, "b", "u"), (2, None, "d")]


@pytest.mark.parametrize("encode", ["PARQUET", "JSON", "CSV"])
def test_files_keep_values(spark, out, encode):
    df = spark.createDataFrame([(1, 'a "quoted", text', 1.5), (2, "", -0.1), (3, None, None), (4, "  blanks\\N ", 1e300)], "k long, v string, d double")
    df = df.withColumn("t", F.expr("TIMESTAMP_NTZ'2024-01-02 03:04:05.000007' + make_dt_interval(0, 0, 0, k)"))
    sink = FileSink(out, encode=encode)
    write_files(df, sink)
    assert rows(read_files(spark, sink, df.schema)) == rows(df)


def test_file_formats(spark, tmp_path):
    changes = log(spark, (1, "a", 1, "c"), (2, None, 2, "d"))
    write_files(changes, FileSink(str(tmp_path / "plain")), ["k"])
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 1
    assert rows(encode_upsert(changes, ["k"])) == [('{"k":1}', '{"k":1,"v":"a","pos":1}'), ('{"k":2}', None)]
    assert [json.loads(r.value) for r in encode_debezium(changes).collect()] == [
        {"op": "c", "before": None, "after": {"k": 1, "v": "a", "pos": 1}},
        {"op": "d", "before": {"k": 2, "v": None, "pos": 2}, "after": None},
    ]
    write_files(changes, FileSink(str(tmp_path / "env"), format="DEBEZIUM", encode="JSON"), ["k"])
    assert spark.read.json(str(tmp_path / "env")).columns == ["value"]


@pytest.mark.parametrize(
    "make",
    [
        lambda: FileSink("p", data_type="upsert"),
        lambda: FileSink("p", format="AVRO"),
        lambda: FileSink("p", encode="ORC"),
        lambda: FileSink(""),
        lambda: JdbcSink("jdbc:x", "t", data_type="upsert"),
        lambda: JdbcSink("jdbc:x", "t", data_type="merge"),
        lambda: LakeSink("w", "d", "t", data_type="upsert"),
        lambda: LakeSink("w", "d", "t", catalog_type="glue"),
        lambda: LakeSink("w", "d", "t", catalog_type="rest"),
        lambda: LakeSink("w", "", "t"),
        lambda: SearchSink("ftp://x", "i"),
        lambda: SearchSink("http://x"),
        lambda: SearchSink("http://x", "i", index_column="c"),
        lambda: SearchSink("http://x", "i", batch_size_kb=0),
    ],
)
def test_bad_sinks(make):
    with pytest.raises(ValueError):
        make()


def test_sink_settings():
    assert LakeSink("w/", "d", "t", data_type="upsert", primary_key="id, ts").keys == ["id", "ts"]
    assert LakeSink("w", "d", "t", catalog_type="rest", catalog_name="c", catalog_uri="http://u").identifier == "`c`.`d`.`t`"
    fast = SearchSink.high_throughput("http://x", "i", batch_num_messages=2000)
    assert (fast.batch_num_messages, fast.batch_size_kb, fast.concurrent_requests) == (2000, 5000, 5)


SEARCH = SearchSink("http://x", "idx", primary_key="k,v", delimiter="|", routing_column="v")


def test_documents(spark, out):
    df = log(spark, (1, "a", 1, "u"), (2, "b", 2, "d"), (3, None, 3, "u"))
    good, bad = split_unkeyed_docs(df, SEARCH.keys)
    assert (good.count(), rows(bad.select("k"))) == (2, [(3,)])
    docs = bulk_docs(df, SEARCH)
    assert rows(docs) == [
        ("idx", "1|a", "a", "index", '{"k":1,"v":"a","pos":1}'),
        ("idx", "2|b", "b", "delete", None),
    ]
    text = sorted(r.value for r in ndjson(docs).collect())
    assert text == [
        '{"delete":{"_index":"idx","_id":"2|b","routing":"b"}}',
        '{"index":{"_index":"idx","_id":"1|a","routing":"a"}}\n{"k":1,"v":"a","pos":1}',
    ]
    write_ndjson(docs, out)
    assert spark.read.text(out).count() == 3


def _docs(spark, n, partitions):
    df = spark.range(n).select(
        F.col("id").alias("k"), F.expr("repeat('é', CAST(id % 700 AS INT))").alias("v")
    ).repartition(partitions, "k")
    return bulk_docs(df, SearchSink("http://x", "idx", primary_key="k"))


@pytest.mark.parametrize("max_docs, max_kb", [(7, None), (None, 1), (5, 2), (None, None)])
def test_packing_against_brute_force(spark, max_docs, max_kb):
    docs = _docs(spark, 300, 3).cache()
    requests = pack_requests(docs, max_docs, max_kb).collect()
    lines = [r.value + "\n" for r in ndjson(docs).collect()]
    assert sorted("".join(r.body for r in requests).split("\n")) == sorted("".join(lines).split("\n"))
    for r in requests:
        assert r.bytes == len(r.body.encode())
        assert r.docs == r.body.count('{"index"')
        assert max_docs is None or r.docs <= max_docs
        assert max_kb is None or r.bytes <= max_kb * 1024 or r.docs == 1
    # greedy per task: no request could have taken the first document of the next one
    sizes = [len(line.encode()) for line in lines]
    expected, count, size = [], 0, 0
    bounds = [r.n for r in docs.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()]
    taken = 0
    for n in bounds:
        for b in sizes[taken : taken + n]:
            if count and ((max_docs and count >= max_docs) or (max_kb and size + b > max_kb * 1024)):
                expected.append((count, size))
                count = size = 0
            count, size = count + 1, size + b
        expected.append((count, size))
        count = size = 0
        taken += n
    assert [(r.docs, r.bytes) for r in requests] == expected
    docs.unpersist()


def test_sending(spark, tmp_path):
    folder = str(tmp_path)

    def send(body):
        import hashlib

        with open(f"{folder}/{hashlib.md5(body.encode()).hexdigest()}", "w") as f:
            f.write(body)

    requests = pack_requests(_docs(spark, 50, 2), max_docs=4)
    send_requests(requests, send, concurrency=3)
    sent = "".join(open(f"{folder}/{n}").read() for n in os.listdir(folder))
    assert sent.count('{"index"') == 50

    def broken(body):
        raise RuntimeError("refused")

    with pytest.raises(Exception, match="refused"):
        send_requests(requests, broken, concurrency=2)


def test_routing_keeps_documents(spark):
    docs = bulk_docs(
        spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("r")),
        SearchSink("http://x", "idx", primary_key="k", routing_column="r"),
    )
    assert rows(route(docs)) == rows(docs)


def test_number_batches(spark):
    got = number_batches(spark.range(5000), "id", max_docs=30, rows_per_lane=500)
    sizes = got.groupBy("lane", "batch").count().collect()
    assert len({r.lane for r in sizes}) == 10
    assert max(r["count"] for r in sizes) == 30
    assert sum(r["count"] for r in sizes) == 5000


def test_unknown_fields(spark):
    df = spark.createDataFrame([('{"a":1}',), ('{"a":1,"b":2,"c":3}',), ("nope",)], "value string")
    good, bad = split_unknown_fields(df, ["a"])
    assert rows(good) == [('{"a":1}',)]
    assert rows(bad) == [("nope", "?"), ('{"a":1,"b":2,"c":3}', "b,c")]


def test_failing_target_does_not_stop_the_rest(spark, out):
    def write(df, name):
        if name == "b":
            raise RuntimeError("disk full\nmore")
        df.write.parquet(f"{out}/{name}")

    frames = {n: spark.range(i) for i, n in enumerate("abc", 1)}
    result = deliver_tables(spark, "s", write, frames=frames, queries={"q": "SELECT 1 AS x", "bad": "SELECT * FROM nowhere"})
    got = {r.table: (r.rows, r.ok, r.error) for r in result.collect()}
    assert got["a"] == (1, True, None) and got["c"] == (3, True, None) and got["q"] == (1, True, None)
    assert got["b"] == (0, False, "disk full")
    assert not got["bad"][1] and "nowhere" in got["bad"][2]
    with pytest.raises(ValueError):
        sink_input(spark)
    with pytest.raises(ValueError):
        sink_input(spark, "t", "SELECT 1")


def test_fan_out(spark, out):
    feed = spark.createDataFrame(
        [("s", "a", '{"x":1}'), ("s", "b", '{"y":2}'), ("t", "a", '{"x":3}')], "schema string, table string, after string"
    )
    fan_out(feed, out)
    from pyspark.sql import types as T

    assert rows(fan_out_table(spark, out, "s", "a", T.StructType().add("x", "long"))) == [(1,)]
    assert rows(fan_out_table(spark, out, "t", "a")) == [('{"x":3}',)]
