"""Compare a registered query with its SQL, types and values."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.workload import QUERIES

TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB connection with the tables of a folder as views."""
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(
            f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(0.0 if row[i] == 0 and isinstance(row[i], float) else row[i]
                         for i in order) for row in rows)


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and the SQL result, None when nothing does."""
    relation = connection.sql(sql)
    wanted = {c: TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    found = {f.name: f.dataType.simpleString() for f in result.schema.fields}
    if wanted != found:
        keys = sorted(set(wanted) | set(found))
        return "; ".join(f"{k}: {found.get(k)} instead of {wanted.get(k)}"
                         for k in keys if wanted.get(k) != found.get(k))
    ours = _rows(result.columns, (tuple(r) for r in result.collect()))
    theirs = _rows(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    extra, lacking = ours - theirs, theirs - ours
    return (f"{sum(ours.values())} rows, {sum(theirs.values())} expected;"
            f" {sum(extra.values())} extra such as {next(iter(extra), None)};"
            f" {sum(lacking.values())} lacking such as {next(iter(lacking), None)}")


def check(spark: SparkSession, folder: str, name: str) -> str | None:
    return difference(QUERIES[name](spark, folder), connect(folder), ORACLE[name])
