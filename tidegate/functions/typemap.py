"""Upstream column types -> target type names -> Spark types."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import types as T

# PostgreSQL type -> target type.
POSTGRES_TYPES = {
    "smallint": "SMALLINT",
    "int2": "SMALLINT",
    "integer": "INT",
    "int": "INT",
    "int4": "INT",
    "bigint": "BIGINT",
    "int8": "BIGINT",
    "decimal": "DECIMAL",
    "numeric": "DECIMAL",
    "real": "REAL",
    "float4": "REAL",
    "double precision": "DOUBLE",
    "float8": "DOUBLE",
    "character varying": "VARCHAR",
    "varchar": "VARCHAR",
    "character": "VARCHAR",
    "char": "VARCHAR",
    "text": "VARCHAR",
    "boolean": "BOOLEAN",
    "bool": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp without time zone": "TIMESTAMP",
    "timestamp with time zone": "TIMESTAMPTZ",
    "timestamptz": "TIMESTAMPTZ",
    "date": "DATE",
    "time": "TIME",
    "time without time zone": "TIME",
    "json": "JSONB",
    "jsonb": "JSONB",
    "array": "VARCHAR",
    "uuid": "VARCHAR",
    "bytea": "BYTEA",
}
POSTGRES_KEEP_PARAMETERS = {"character varying", "varchar", "character", "char", "decimal", "numeric"}
POSTGRES_FALLBACK = "VARCHAR"

# MySQL type -> target type. Unsigned integers take the next larger type.
MYSQL_TYPES = {
    "TINYINT": "SMALLINT",
    "SMALLINT": "SMALLINT",
    "MEDIUMINT": "INTEGER",
    "INT": "INTEGER",
    "INTEGER": "INTEGER",
    "BIGINT": "BIGINT",
    "TINYINT UNSIGNED": "INTEGER",
    "SMALLINT UNSIGNED": "INTEGER",
    "MEDIUMINT UNSIGNED": "BIGINT",
    "INT UNSIGNED": "BIGINT",
    "INTEGER UNSIGNED": "BIGINT",
    "BIGINT UNSIGNED": "DECIMAL(20,0)",
    "DECIMAL": "DECIMAL",
    "NUMERIC": "DECIMAL",
    "DEC": "DECIMAL",
    "FIXED": "DECIMAL",
    "FLOAT": "REAL",
    "REAL": "REAL",
    "DOUBLE": "DOUBLE PRECISION",
    "DOUBLE PRECISION": "DOUBLE PRECISION",
    "CHAR": "VARCHAR",
    "VARCHAR": "VARCHAR",
    "TINYTEXT": "VARCHAR(255)",
    "TEXT": "TEXT",
    "MEDIUMTEXT": "TEXT",
    "LONGTEXT": "TEXT",
    "BINARY": "BYTEA",
    "VARBINARY": "BYTEA",
    "TINYBLOB": "BYTEA",
    "BLOB": "BYTEA",
    "MEDIUMBLOB": "BYTEA",
    "LONGBLOB": "BYTEA",
    "DATE": "DATE",
    "TIME": "TIME",
    "DATETIME": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMPTZ",
    "YEAR": "SMALLINT",
    "JSON": "JSONB",
    "BOOLEAN": "BOOLEAN",
    "BOOL": "BOOLEAN",
    "ENUM": "VARCHAR",
    "SET": "VARCHAR",
    "GEOMETRY": "TEXT",
    "POINT": "TEXT",
    "LINESTRING": "TEXT",
    "POLYGON": "TEXT",
    "MULTIPOINT": "TEXT",
    "MULTILINESTRING": "TEXT",
    "MULTIPOLYGON": "TEXT",
    "GEOMETRYCOLLECTION": "TEXT",
    "BIT": "BIT",
}
MYSQL_LENGTH_TYPES = {"CHAR", "VARCHAR"}
MYSQL_FALLBACK = "VARCHAR"

# SQL Server type -> target type.
SQLSERVER_TYPES = {
    "tinyint": "SMALLINT",
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "decimal": "DECIMAL",
    "numeric": "DECIMAL",
    "float": "DOUBLE PRECISION",
    "real": "REAL",
    "money": "DECIMAL(19,4)",
    "smallmoney": "DECIMAL(10,4)",
    "char": "CHAR",
    "varchar": "VARCHAR",
    "text": "TEXT",
    "nchar": "CHAR",
    "nvarchar": "VARCHAR",
    "ntext": "TEXT",
    "date": "DATE",
    "time": "TIME",
    "datetime": "TIMESTAMP",
    "datetime2": "TIMESTAMP",
    "smalldatetime": "TIMESTAMP",
    "datetimeoffset": "TIMESTAMPTZ",
    "binary": "BYTEA",
    "varbinary": "BYTEA",
    "image": "BYTEA",
    "bit": "BOOLEAN",
    "uniqueidentifier": "UUID",
    "xml": "TEXT",
    "sql_variant": "TEXT",
}
SQLSERVER_FALLBACK = "TEXT"

_PARAMETERS = re.compile(r"\s*\(([^)]*)\)")


def postgres_type(upstream: str) -> str:
    name = upstream.strip()
    if name.endswith("[]"):
        element = POSTGRES_TYPES.get(name[:-2].lower(), POSTGRES_FALLBACK)
        return element + "[]"
    # the parameter may sit inside the name: "timestamp(6) with time zone"
    bare = _PARAMETERS.sub("", name).lower()
    if bare != name.lower() and bare in POSTGRES_KEEP_PARAMETERS:
        return name.upper()
    return POSTGRES_TYPES.get(bare, POSTGRES_FALLBACK)


def _with_parameters(target: str, numbers: str | None) -> str:
    """A target type with the length or precision that the upstream type names, where it takes one."""
    given = [n.strip() for n in (numbers or "").split(",")]
    if not all(n.isdigit() for n in given) or "(" in target:
        return target
    if target == "DECIMAL" and 0 < int(given[0]) <= 38:
        return f"DECIMAL({','.join(given)})"
    return f"{target}({given[0]})" if target in ("VARCHAR", "CHAR") and int(given[0]) else target


def _bare(upstream: str) -> tuple[str, str | None]:
    """``int(10) unsigned`` as its name in lower case and what stands in the parentheses."""
    found = _PARAMETERS.search(upstream)
    return " ".join(_PARAMETERS.sub(" ", upstream).lower().split()), found.group(1) if found else None


def mysql_type(upstream: str, length: int | None = None) -> str:
    name, numbers = _bare(upstream)
    if length and name.upper() in MYSQL_LENGTH_TYPES:
        return f"VARCHAR({length})"
    for known in (name, name.removesuffix(" zerofill"), name.removesuffix(" zerofill").removesuffix(" unsigned")):
        if known.upper() in MYSQL_TYPES:
            return _with_parameters(MYSQL_TYPES[known.upper()], numbers)
    return MYSQL_FALLBACK


def sqlserver_type(upstream: str) -> str:
    name, numbers = _bare(upstream)
    return _with_parameters(SQLSERVER_TYPES.get(name, SQLSERVER_FALLBACK), numbers)


_DIALECTS = {"postgres": postgres_type, "mysql": mysql_type, "sqlserver": sqlserver_type}


def map_type(dialect: str, upstream: str) -> str:
    if dialect not in _DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}, expected one of {sorted(_DIALECTS)}")
    return _DIALECTS[dialect](upstream)


# Target type -> Spark type. TIME and UUID have no enabled Spark type and stay text; JSONB stays JSON text.
SPARK_TYPES = {
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "REAL": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "DECIMAL": T.DecimalType(38, 18),
    "BOOLEAN": T.BooleanType(),
    "CHAR": T.StringType(),
    "CHARACTER": T.StringType(),
    "CHARACTER VARYING": T.StringType(),
    "VARCHAR": T.StringType(),
    "TEXT": T.StringType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMPTZ": T.TimestampType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),
    "JSONB": T.StringType(),
    "UUID": T.StringType(),
    "BYTEA": T.BinaryType(),
    "BIT": T.BinaryType(),
}


def split_target(target: str) -> tuple[str, list[int]]:
    """``"DECIMAL(10,2)"`` -> ``("DECIMAL", [10, 2])``."""
    found = _PARAMETERS.search(target)
    numbers = [int(n) for n in found.group(1).split(",")] if found else []
    return _PARAMETERS.sub("", target).strip().upper(), numbers


def spark_type(target: str) -> T.DataType:
    if target.strip().endswith("[]"):
        return T.ArrayType(spark_type(target.strip()[:-2]))
    base, numbers = split_target(target)
    if base in ("DECIMAL", "NUMERIC") and numbers:
        return T.DecimalType(numbers[0], numbers[1] if len(numbers) > 1 else 0)
    if base == "NUMERIC":
        base = "DECIMAL"
    if base not in SPARK_TYPES:
        raise ValueError(f"unknown target type {target!r}")
    return SPARK_TYPES[base]


def struct_of(columns: Mapping[str, str]) -> T.StructType:
    """Declared ``{column: target type}`` as a Spark schema."""
    return T.StructType([T.StructField(name, spark_type(target)) for name, target in columns.items()])
