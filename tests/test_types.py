from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import rows
from tidegate.functions import cast_to_target, map_type, mysql_type, postgres_type, spark_type, split_rejects, typed_projection


@pytest.mark.parametrize(
    "upstream, target",
    [
        ("integer", "INT"),
        ("INT2", "SMALLINT"),
        ("double precision", "DOUBLE"),
        ("varchar(255)", "VARCHAR(255)"),
        ("numeric(10,2)", "NUMERIC(10,2)"),
        ("timestamp(6) with time zone", "TIMESTAMPTZ"),
        ("timestamp(3) without time zone", "TIMESTAMP"),
        ("timestamp(3)", "TIMESTAMP"),
        ("time with time zone", "VARCHAR"),
        ("money", "VARCHAR"),
        ("interval", "VARCHAR"),
        ("xml", "VARCHAR"),
        ("ARRAY", "VARCHAR"),
        ("integer[]", "INT[]"),
        ("varchar(9)[]", "VARCHAR[]"),
        ("point[]", "VARCHAR[]"),
        ("jsonb", "JSONB"),
        ("bytea", "BYTEA"),
    ],
)
def test_postgres(upstream, target):
    assert postgres_type(upstream) == target


@pytest.mark.parametrize(
    "upstream, length, target",
    [
        ("tinyint", None, "SMALLINT"),
        ("int unsigned", None, "BIGINT"),
        ("bigint unsigned", None, "DECIMAL(20,0)"),
        ("varchar", 40, "VARCHAR(40)"),
        ("varchar", None, "VARCHAR"),
        ("text", 40, "TEXT"),
        ("year", None, "SMALLINT"),
        ("timestamp", None, "TIMESTAMPTZ"),
        ("datetime", None, "TIMESTAMP"),
        ("enum", None, "VARCHAR"),
        ("polygon", None, "TEXT"),
        ("what", None, "VARCHAR"),
    ],
)
def test_mysql(upstream, length, target):
    assert mysql_type(upstream, length) == target


@pytest.mark.parametrize(
    "upstream, target",
    [
        ("int", "INTEGER"),
        ("bigint", "BIGINT"),
        ("decimal", "DECIMAL"),
        ("float", "DOUBLE PRECISION"),
        ("varchar", "VARCHAR"),
        ("nvarchar", "VARCHAR"),
        ("text", "TEXT"),
        ("datetime", "TIMESTAMP"),
        ("datetimeoffset", "TIMESTAMPTZ"),
        ("date", "DATE"),
        ("time", "TIME"),
        ("bit", "BOOLEAN"),
        ("money", "DECIMAL(19,4)"),
        ("uniqueidentifier", "UUID"),
        ("unknown", "TEXT"),
    ],
)
def test_sqlserver(upstream, target):
    assert map_type("sqlserver", upstream) == target


def test_spark_types():
    assert spark_type("DECIMAL") == T.DecimalType(38, 18)
    assert spark_type("NUMERIC(10,2)") == T.DecimalType(10, 2)
    assert spark_type("DECIMAL(20,0)") == T.DecimalType(20, 0)
    assert spark_type("VARCHAR(9)") == T.StringType()
    assert spark_type("TIMESTAMP") == T.TimestampNTZType()
    assert spark_type("TIMESTAMPTZ") == T.TimestampType()
    assert spark_type("INT[]") == T.ArrayType(T.IntegerType())
    with pytest.raises(ValueError):
        spark_type("NOPE")
    with pytest.raises(ValueError):
        map_type("oracle", "int")


def test_every_mapped_type_has_a_spark_type():
    from tidegate.functions import typemap

    for table in (typemap.POSTGRES_TYPES, typemap.MYSQL_TYPES, typemap.SQLSERVER_TYPES):
        for target in table.values():
            spark_type(target)


@pytest.mark.parametrize(
    "text, target, value",
    [
        ("12", "INT", 12),
        ("x", "INT", None),
        ("3000000000", "INT", None),
        ("18446744073709551615", "DECIMAL(20,0)", Decimal("18446744073709551615")),
        ("abc", "VARCHAR(3)", "abc"),
        ("abcd", "VARCHAR(3)", None),
        ('{"a": 1}', "JSONB", '{"a": 1}'),
        ("{a", "JSONB", None),
        ("aGk=", "BYTEA", bytearray(b"hi")),
        ("true", "BOOLEAN", True),
        ("[1,2]", "INT[]", [1, 2]),
        ("12:30:00", "TIME", "12:30:00"),
    ],
)
def test_cast(spark, text, target, value):
    df = spark.createDataFrame([(text,)], "t string").select(cast_to_target(F.col("t"), target).alias("v"))
    assert df.first().v == value


def test_rejects_keep_their_input(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "y"), (None, "1")], "a string, b string")
    good, bad = split_rejects(typed_projection(df, {"a": "INT", "b": "DOUBLE"}))
    assert rows(good) == [(1, 2.5), (None, 1.0)]
    assert rows(bad) == [(None, None, "cast failed: a,b", '{"a":"x","b":"y"}')]
