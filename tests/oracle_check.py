"""Compare a registered query with its SQL: columns by name, rows as a multiset."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    spark_names, spark_rows = _rows(df.columns, df.collect())
    result = connection.execute(sql)
    sql_names, sql_rows = _rows([d[0] for d in result.description], result.fetchall())
    if spark_names != sql_names:
        return [f"columns {spark_names} != {sql_names}"]
    found = []
    if spark_rows != sql_rows:
        only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
        found.append(f"rows {spark_rows.total()} / {sql_rows.total()}, differing {only_spark.total()} / {only_sql.total()}")
        found += [f"spark {r}" for r in sorted(only_spark, key=str)[:3]]
        found += [f"sql   {r}" for r in sorted(only_sql, key=str)[:3]]
    return found
