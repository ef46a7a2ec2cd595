"""Bulk ingest: copy tables to Parquet."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import CancelledError, ThreadPoolExecutor
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from patronage.sources import parquet, versions
from patronage.sources.catalog import CatalogDatabase
from patronage.sources.jdbc import JdbcDatabase

MANIFEST = "table_name string, path string, row_count bigint, column_count int"


def ingest(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    tables: Sequence[str],
    base: str,
    at_once: int = 1,
    run: str | None = None,
    fault_keys: Callable[[str], Sequence[str]] | None = None,
) -> DataFrame:
    """Copy each table to ``{base}/{table}.parquet``; returns one manifest row per table.

    Each copy is a Spark job of its own and replaces the table in one step when it is whole.
    ``at_once`` lets small tables share the cluster. After a failure no further copy is started, and
    the failure is raised; tables copied by then stay. Called again with the same name of a ``run``,
    it copies only the rest. ``fault_keys`` names the columns that identify a row whose values
    do not fit, see :func:`patronage.sources.parquet.write_table`.
    """

    failed = Event()

    def copy(name: str) -> tuple[str, str, int, int]:
        if failed.is_set():
            raise CancelledError(f"{name} was not copied: another table failed")
        path = parquet.table_path(base, name)
        done = versions.current(spark, path) if run is not None else None
        if done and done.run == run:
            return name, path, done.rows, len(T.StructType.fromJson(json.loads(done.schema)))
        try:
            table = read(name)
            keys = fault_keys(name) if fault_keys else None
            path, rows = parquet.write_table(table, base, name, run, fault_keys=keys)
        except BaseException:
            failed.set()
            raise
        return name, path, rows, len([column for column in table.columns if column != parquet.FAULTS])

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        manifest = list(pool.map(copy, tables))
    return spark.createDataFrame(manifest, MANIFEST)


def ingest_catalog(
    database: CatalogDatabase,
    base: str,
    tables: Sequence[str] | None = None,
    at_once: int = 1,
    run: str | None = None,
) -> DataFrame:
    """Copy the named tables of a catalog's database, or all of them."""
    chosen = _checked(tables, database.list_tables())
    return ingest(database.spark, database.read_table, chosen, base, at_once, run)


def ingest_parquet(
    spark: SparkSession,
    source: str,
    base: str,
    tables: Sequence[str] | None = None,
    at_once: int = 1,
    run: str | None = None,
) -> DataFrame:
    """Copy the named tables below ``source``, or all of them."""
    known = parquet.list_tables(spark, source)
    chosen = _checked(tables, known)
    return ingest(spark, lambda name: parquet.read_table(spark, source, name), chosen, base, at_once, run)


def ingest_jdbc(
    database: JdbcDatabase,
    base: str,
    tables: Sequence[str] | None = None,
    keys: Mapping[str, str | Sequence[str]] | None = None,
    policy: str = "source",
    at_once: int = 1,
    partitions: int | None = None,
    by_hash: Sequence[str] = (),
    run: str | None = None,
) -> DataFrame:
    """Copy the named tables of a database, or all of them, under their stored types.

    ``keys`` names the column or columns per table to split the read by, where these are not the
    primary key; tables in ``by_hash`` are split by a hash of all columns. ``partitions`` is the
    number of reads per table. Values that do not fit their column's type fail the table with one
    error that names all columns, counts and the rows.
    """
    chosen = _checked(tables, database.list_tables())

    def read(name: str) -> DataFrame:
        key = (keys or {}).get(name)
        table = database.read_table(name, key, partitions, by_hash=name in by_hash)
        return parquet.located_cast(table, database.declared_schema(name), policy)

    def fault_keys(name: str) -> list[str]:
        declared = dict(database.declared_schema(name))
        return database.ordered_key(name, declared) or list(declared)

    return ingest(database.spark, read, chosen, base, at_once, run, fault_keys)


def _checked(tables: Sequence[str] | None, known: Sequence[str]) -> list[str]:
    unknown = sorted(set(tables or ()) - set(known))
    if unknown:
        raise ValueError(f"no such tables: {unknown}")
    return list(tables or known)
