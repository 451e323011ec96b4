import fnmatch
import itertools

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidegate.operators import (
    ColumnSelection,
    TableColumns,
    TableSelector,
    glob_regex,
    missing_tables,
    pattern_condition,
    project_columns,
    require_tables,
    resolve_specific,
    select_specific,
    selection_findings,
)

NAMES = ["users", "public.users", "fact_sales", "dim_a", "sales.users_temp", "x", "a.b.c", "user\n", "a-b", "w[1]"]
GLOBS = ["*", "users", "*.users", "fact_*", "?", "u?ers", "[uf]*", "[!u]*", "*_temp", "a.*", "*s", "[a", "w[[]1]", "*[]]", "a[-x]b", "U*"]


def test_globs_match_like_a_shell(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    hits = df.select("n", *[F.lower("n").rlike(glob_regex(g)).alias(f"g{i}") for i, g in enumerate(GLOBS)]).collect()
    for row, (i, g) in itertools.product(hits, enumerate(GLOBS)):
        assert row[f"g{i}"] == fnmatch.fnmatchcase(row.n.lower(), g.lower()), (row.n, g)


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(
        [("public", "users", 1), ("public", "users", 2), ("sales", "users", 3), ("sales", "orders", 4), ("hr", "staff", 5)],
        "schema string, table string, id long",
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_include_then_exclude(feed):
    assert ids(TableSelector(include=("users",)).select(feed)) == [1, 2, 3]
    assert ids(TableSelector(include=("users",), exclude=("sales.*",)).select(feed)) == [1, 2]
    assert ids(TableSelector(include_all=True, exclude=("STAFF",)).select(feed)) == [1, 2, 3, 4]
    assert ids(TableSelector().select(feed)) == []


def test_specific_first_hit_and_placeholders(feed):
    found = resolve_specific(feed, ["users", "sales.users", "a.b.c", "nope", "users"]).orderBy("position")
    assert [tuple(r)[1:] for r in found.collect()] == [
        ("users", "public", "users", 2, True),
        ("sales.users", "sales", "users", 1, True),
        ("a.b.c", "a", "b.c", 0, False),
        ("nope", "public", "nope", 0, False),
        ("users", "public", "users", 2, True),
    ]
    assert ids(select_specific(feed, ["users", "hr.staff", "users"])) == [1, 2, 5]
    assert ids(TableSelector(specific=("orders",), exclude=("*",)).select(feed)) == [4]
    known = [("sales", "users"), ("public", "users"), ("sales", "orders")]
    assert ids(TableSelector(specific=("users", "sales.orders", "hr.staff")).select(feed, known=known)) == [3, 4]


def test_missing_tables(feed):
    assert rows(missing_tables(feed, ["users", "b", "a.x"])) == [("a.x",), ("b",)]
    with pytest.raises(ValueError, match="a.x, b"):
        require_tables(feed, ["b", "users", "a.x"])
    require_tables(feed, ["users"])


def test_pattern_text(feed):
    assert ids(feed.filter(pattern_condition("sales.*, hr.staff", "public"))) == [3, 4, 5]
    assert ids(feed.filter(pattern_condition("users", "sales"))) == [3]
    assert ids(feed.filter(pattern_condition("Sales.*", "public"))) == []


def test_column_lists(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project_columns(df, ["c", "a"]).columns == ["a", "c"]
    assert project_columns(df, ["a", "b"], ["b"]).columns == ["a"]
    assert project_columns(df, None, ["b"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        project_columns(df, ["a", "z"])


def test_table_columns(spark):
    picked = TableColumns(
        "users",
        (ColumnSelection("id", "INT", primary_key=True), ColumnSelection("name"), ColumnSelection("n", "SMALLINT")),
        target_table="clean_users",
    )
    assert (picked.target, picked.primary_key) == ("clean_users", ["id"])
    assert TableColumns("users").target == "users"
    df = spark.createDataFrame([("1", "a", "7", "x"), ("2", "b", "70000", "x")], "id string, name string, n string, pw string")
    out = picked.project(df)
    assert out.columns == ["id", "name", "n", "reject_reason", "reject_row"]
    assert rows(out.select("id", "name", "n", "reject_reason")) == [(1, "a", 7, None), (2, "b", None, "cast failed: n")]


def findings(df, picked, **kwargs):
    return {(r.rule, r.column, r.severity): r.violating_rows for r in selection_findings(df, picked, **kwargs).collect()}


def test_selection_rules(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, name string")
    ok = [ColumnSelection("id", primary_key=True), ColumnSelection("name")]
    assert findings(df.dropDuplicates(["id"]), ok, upstream_pk=["id"]) == {}
    assert findings(df, ok, upstream_pk=["id"]) == {("duplicate key", "id", "error"): 2}
    assert findings(df, [ColumnSelection("name")], upstream_pk=["id"]) == {
        ("no primary key", "", "error"): 3,
        ("upstream key left out", "id", "error"): 3,
    }
    strict = [ColumnSelection("id", primary_key=True), ColumnSelection("name", nullable=False)]
    assert findings(df.filter("name IS NOT NULL"), strict, upstream_pk=["id"]) == {("nullability override", "name", "warning"): 0}
    assert findings(df.filter("name IS NOT NULL"), strict, upstream_pk=["id"], upstream_not_null=["name"]) == {}


def test_document_rules(spark):
    docs = spark.createDataFrame([("1", "{}")], "_id string, payload string")
    assert findings(docs, [ColumnSelection("payload", primary_key=True)], upstream_pk=["_id"], document=True) == {
        ("not an upstream key", "payload", "error"): 1,
        ("upstream key left out", "_id", "error"): 1,
        ("_id left out", "_id", "error"): 1,
    }
    assert ("_id not the key", "_id", "error") in findings(docs, [ColumnSelection("_id")], upstream_pk=["_id"], document=True)
