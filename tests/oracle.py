"""Compare registered queries with their SQL run by DuckDB: python -m tests.oracle [sf or folder] [name…]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_string(t) or pa.types.is_large_string(t) or "json" in str(t).lower():
        return "string"
    return str(t)


def _canonical(table: pa.Table) -> tuple[list[tuple[str, str]], list[tuple]]:
    names = sorted(table.column_names)
    schema = [(n, _kind(table.schema.field(n).type)) for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    rows = list(zip(*columns)) if columns else []
    return schema, sorted(rows, key=lambda r: tuple((v is None, "" if v is None else str(v)) for v in r))


def differences(spark_table: pa.Table, duck_table: pa.Table) -> str | None:
    s_schema, s_rows = _canonical(spark_table)
    d_schema, d_rows = _canonical(duck_table)
    if s_schema != d_schema:
        return f"schema {[x for x in s_schema if x not in d_schema]} != {[x for x in d_schema if x not in s_schema]}"
    if len(s_rows) != len(d_rows):
        return f"rows {len(s_rows)} != {len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            return f"values {a} != {b}"
    return None


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> str | None:
    result = query(spark, sf_dir).toArrow()
    if sql is None:
        return None if result.num_rows else "no rows"
    return differences(result, con.sql(sql).to_arrow_table())


def main(sf: str = "0.01", *names: str) -> int:
    from tidegate.plans import QUERIES, SQL
    from tidegate.session import build_session

    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    sf_dir = sf if sf.startswith("/") else f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            problem = compare(spark, con, name, QUERIES[name], SQL.get(name), sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names or QUERIES)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
