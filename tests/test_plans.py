"""Plans of the queries: what reaches the scan, what is shuffled, and what must not appear."""

import re

import pytest

from tidegate.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"
#: Documents are put together, and requests packed, in Arrow batches.
IN_PYTHON = {"es_request_packing", "cdc_mongo_patches", "ingest_documents"}
STREAMED = {n for n in QUERIES if n.startswith("stream_")} | {"scan_parquet_feed"}


def plan(spark, name):
    execution = QUERIES[name](spark, SF_DIR)._jdf.queryExecution()
    return execution.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED - IN_PYTHON))
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("project_include", "c_custkey:bigint,c_name:string,c_nationkey:int"),
        ("top10_revenue", "l_partkey:bigint,l_quantity:double,l_extendedprice:double"),
        ("monthly_counts", "o_orderstatus:string,o_orderdate:timestamp_ntz"),
        ("es_batches", "event_id:bigint"),
        ("pk_violations_composite", "l_orderkey:bigint,l_linenumber:int"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("hourly_rollup_last_day", "GreaterThanOrEqual(ts,2024-01-29T00:00)"),
        ("monthly_counts", "EqualTo(o_orderstatus,O)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    text = plan(spark, name)
    assert pushed in text


@pytest.mark.parametrize("name", ["apply_latest", "apply_latest_composite", "cdc_postgres_apply", "kafka_upsert_latest"])
def test_latest_is_one_shuffle_after_partial_aggregation(spark, name):
    text = plan(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_max_by" in text


@pytest.mark.parametrize("name", ["decode_json", "decode_debezium", "decode_maxwell", "decode_canal", "cdc_postgres_apply"])
def test_messages_are_parsed_once(spark, name):
    wrapped = {"decode_json": 2}  # the second one parses the nested document
    assert plan(spark, name).count("from_json(") == wrapped.get(name, 1)


def test_recent_rows_are_not_sorted_whole(spark):
    assert "TakeOrderedAndProject" in plan(spark, "recent_100")
