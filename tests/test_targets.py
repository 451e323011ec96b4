"""Targets that keep the last change whatever order batches come in; statements run in an embedded engine."""

import itertools
import json

import duckdb
import pytest

from tests.conftest import rows
from tidegate import LakeTable
from tidegate.sinks import JdbcSink, LakeSink, SearchSink, upsert_table
from tidegate.sinks.fanout import fan_out, fan_out_table
from tidegate.sinks.jdbc import merge_statements, upsert_rows, write_jdbc
from tidegate.sinks.lake import merge_sql, read_partitions
from tidegate.sinks.search import deliver, ndjson, prepare

#: Batches of changes (key, value, position, operation).
BATCHES = (((1, "a", 1, "u"), (2, "a", 1, "u")), ((1, None, 5, "d"), (3, "x", 2, "u")), ((1, "late", 3, "u"), (2, "b", 4, "u"), (3, None, 1, "d")))
WANT = [(2, "b"), (3, "x")]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_upsert_with_tombstones_in_any_order(order):
    con = duckdb.connect()
    con.execute('CREATE SCHEMA public; CREATE TABLE public.t (k INT PRIMARY KEY, v VARCHAR, o INT, gone BOOLEAN)')
    for i in order:
        con.execute("CREATE OR REPLACE TABLE public.s (k INT, v VARCHAR, o INT, op VARCHAR)")
        con.executemany("INSERT INTO public.s VALUES (?, ?, ?, ?)", BATCHES[i])
        for _ in range(2):
            for statement in merge_statements("public.t", "public.s", ["k", "v", "o"], ["k"], order_by=["o"], tombstone="gone"):
                con.execute(statement)
    assert con.execute("SELECT k, v FROM public.t WHERE NOT gone ORDER BY k").fetchall() == WANT
    assert con.execute("SELECT o FROM public.t WHERE k = 1 AND gone").fetchall() == [(5,)]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_merge_with_tombstones_in_any_order(order):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k INT, v VARCHAR, o INT, gone BOOLEAN)")
    for i in order:
        con.execute("CREATE OR REPLACE TABLE s (k INT, v VARCHAR, o INT, op VARCHAR)")
        con.executemany("INSERT INTO s VALUES (?, ?, ?, ?)", BATCHES[i])
        sql = merge_sql("t", "s", ["k", "v", "o"], ["k"], order_by=["o"], tombstone="gone").replace("t.`v` =", "`v` =")
        con.execute(sql.replace("SET t.", "SET ").replace(", t.", ", ").replace("`", '"').replace("INTO t t USING s s", "INTO t USING s"))
    assert con.execute("SELECT k, v FROM t WHERE NOT gone ORDER BY k").fetchall() == WANT


def test_upserts_need_an_order(spark, out):
    changes = spark.createDataFrame([(1, "a", 1, "u")], "k int, v string, o int, op string")
    sink = SearchSink("http://x", "i", primary_key="k")
    for call in (
        lambda: upsert_rows(changes, ["k"], []),
        lambda: write_jdbc(changes, JdbcSink("jdbc:x", "t", data_type="upsert", primary_key="k")),
        lambda: deliver(changes, sink, print),
        lambda: upsert_table(changes, LakeSink(out, "d", "t", data_type="upsert", primary_key="k"), [], 0),
        lambda: merge_statements("t", "s", ["k"], ["k"], tombstone="gone"),
    ):
        with pytest.raises(ValueError):
            call()


def test_jdbc_rejects_before_it_connects(spark, out):
    changes = spark.createDataFrame([(1, "a", 1, "u"), (None, "b", 1, "u"), (2, "c", None, "u")], "k int, v string, o int, op string")
    sink = JdbcSink("jdbc:none:x", "t", data_type="upsert", primary_key="k")
    with pytest.raises(ValueError):
        write_jdbc(changes, sink, ["o"])
    with pytest.raises(Exception, match="(?i)driver"):
        write_jdbc(changes, sink, ["o"], reject_path=out)
    assert rows(read_partitions(spark, out).select("error")) == [("null key",), ("null order key",)]


def test_actions_have_versions_and_rejects_come_once(spark, out, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", 3, "u", None), (1, None, 4, "d", None), (2, "b", 5, "u", "?"), (None, "c", 1, "u", None), (3, "d", None, "u", None)],
        "k int, v string, o int, op string, odd string",
    )
    sink = SearchSink("http://x", "i", primary_key="k")
    docs, rejects = prepare(df, sink, order_by=["o"], fields=["k", "v"], version="o")
    (line,) = [r["value"] for r in ndjson(docs).collect()]
    assert json.loads(line) == {"delete": {"_index": "i", "_id": "1", "version": 4, "version_type": "external_gte"}}
    want = [("null document id",), ("null order key",), ("unknown fields: odd",)]
    assert rows(rejects.select("error")) == want
    for _ in range(2):
        deliver(df, sink, lambda body: None, order_by=["o"], reject_path=out, fields=["k", "v"], batch_id=3)
    assert rows(read_partitions(spark, out).select("error")) == want
    open_ = SearchSink("http://x", "i", primary_key="k", auto_schema_change=True)
    docs, rejects = prepare(df, open_, order_by=["o"], fields=["k", "v"])
    assert rejects.count() == 2 and json.loads(docs.filter("_id = '2'").first()["source"])["odd"] == "?"


def test_fan_out_replays_change_nothing(spark, out):
    feed = spark.createDataFrame([("s", "a", "1"), ("s", "b", "2"), ("s", "a", "3")], "schema string, table string, after string")
    for _ in range(2):
        fan_out(feed, out, batch_id=0, writer="w")
    fan_out(feed.filter("after = '3'"), out, batch_id=1, writer="w")
    assert rows(fan_out_table(spark, out, "s", "a")) == [("1",), ("3",), ("3",)]
    fan_out(feed, out)
    fan_out(feed, out)
    assert fan_out_table(spark, out, "s", "b").count() == 3


def test_direct_lake_deliveries_keep_null_keys(spark, out):
    sink = LakeSink(out, "db", "t", data_type="upsert", primary_key="k")
    changes = spark.createDataFrame([(1, 1, "u"), (None, 1, "u"), (3, None, "u")], "k int, o int, op string")
    upsert_table(changes, sink, ["o"], 0)
    assert rows(LakeTable(spark, sink.path, ["k"], ["o"]).read()) == [(1, 1)]
    assert rows(read_partitions(spark, f"{sink.path}_rejects").select("error")) == [("null key",), ("null order key",)]
