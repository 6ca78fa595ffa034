"""Catalog tables in Spark SQL, for sessions whose catalog rather than the store holds the data.

Names that go into SQL text are checked against what a name may be; values go
in as parameters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..errors import StoreError
from ..operators import merge
from ..schemas import TABLES

_NAME = re.compile(r"[a-z][a-z0-9_]*(\.[a-z_][a-z0-9_]*){0,2}")
COMMENTS = {
    "raw_events": "Verified events as they landed, by log coordinate",
    "ingested_batches": "Batches whose events are in raw_events",
    "canonical_native": "Canonical events by the native rules",
    "rejected_native": "Events that failed the native rules",
    "canonical_events": "Canonical events by the contract, once for each logical commit",
    "quarantine": "Events that failed the contract, with the reason",
    "duplicate_occurrences": "Log occurrences of commits that are canonical already",
    "schema_observations": "Structures seen, with the contract's version",
    "post_windows": "Five-minute counts of created posts by event time, corrected by late events",
}


def identifier(name: str, allowed: set[str] | None = None) -> str:
    """The name, if it is one and among the allowed ones."""
    if not _NAME.fullmatch(name) or (allowed is not None and name not in allowed):
        raise StoreError(f"not an allowed name: {name!r}")
    return name


def create_statement(table: str, schema: T.StructType, comment: str = "") -> str:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
    said = comment.replace("'", "''")
    return f"CREATE TABLE IF NOT EXISTS {identifier(table)} ({columns}) USING parquet COMMENT '{said}'"


def create_all(spark: SparkSession, database: str) -> list[str]:
    """Creates the database and every table that isn't there."""
    spark.sql("SET TIME ZONE 'UTC'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(database)}")
    names = [f"{database}.{t}" for t in TABLES]
    for name, (table, schema) in zip(names, TABLES.items(), strict=True):
        spark.sql(create_statement(name, schema, COMMENTS[table]))
    return names


@contextmanager
def empty_clone(spark: SparkSession, like: str) -> Iterator[str]:
    """A temporary table with the columns of ``like`` and no rows, dropped at the end."""
    name = identifier(f"{identifier(like)}_t{uuid4().hex[:10]}")
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT * FROM {like} WHERE 1 = 0")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def temporary_view(df: DataFrame) -> Iterator[str]:
    name = f"incoming_{uuid4().hex}"
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def insert_new(spark: SparkSession, table: str, incoming: DataFrame, key: list[str], allowed: set[str] | None = None) -> None:
    """Insert-only merge into a catalog table: appends the rows whose key it hasn't."""
    identifier(table, allowed)
    unknown = set(key) - set(incoming.columns)
    if unknown:
        raise StoreError(f"no such key columns: {sorted(unknown)}")
    new = merge.new_rows(spark.table(table), merge.require_unique(incoming, key), key)
    with temporary_view(new.select(*spark.table(table).columns)) as view:
        spark.sql(f"INSERT INTO {table} SELECT * FROM {view}")


def insert_values(spark: SparkSession, table: str, **values) -> None:
    """One row as literals; columns that aren't given are null."""
    schema = spark.table(identifier(table)).schema
    row = ", ".join(f"CAST(:{f.name} AS {f.dataType.simpleString()})" if f.name in values else "NULL" for f in schema.fields)
    spark.sql(f"INSERT INTO {table} SELECT {row}", args=values)
