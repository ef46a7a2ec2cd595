"""Parquet tables below a base folder, one ``{name}.parquet`` each.

The base may be any URI Spark can write to; an object store is a base like any other. Tables that are
written here have versions, see :mod:`patronage.sources.versions`; plain files and folders of
Parquet files are read as they are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.model import stored_type
from patronage.session import file_system
from patronage.sources import listing, versions

declared_schema = listing.declared_schema

_SUFFIX = ".parquet"
_PLAIN = re.compile(r"[A-Za-z0-9_$-]")
_CODED = re.compile(r"=([0-9a-f]+)=")


def file_name(table: str) -> str:
    """File name of a table of any name: characters with a meaning in paths stand as ``=hex=``."""
    if not table:
        raise ValueError("a table name is empty")
    return "".join(c if _PLAIN.match(c) else f"={ord(c):x}=" for c in table) + _SUFFIX


def table_name(file: str) -> str:
    """The inverse of :func:`file_name`; other names stand for themselves."""
    return _CODED.sub(lambda code: chr(int(code[1], 16)), file.removesuffix(_SUFFIX))


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{file_name(name)}"


def data_path(spark: SparkSession, base: str, name: str) -> str:
    """Where the table's rows are now: the committed version's folder, or the table itself."""
    table = table_path(base, name)
    made = versions.current(spark, table)
    return versions.folder_of(table, made.folder) if made else table


def read_table(
    spark: SparkSession, base: str, name: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """The whole table; filters and column choices made on it reach the Parquet scan.

    A known ``schema`` saves the job that would look it up in the files; a commit has one.
    """
    table = table_path(base, name)
    made = versions.current(spark, table)
    if made:
        table = versions.folder_of(table, made.folder)
        schema = schema or T.StructType.fromJson(json.loads(made.schema))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table)


def list_tables(spark: SparkSession, base: str) -> list[str]:
    """Names of the tables right below ``base``, in order; nothing below them is listed.

    A table whose first write has not been committed is not there yet.
    """
    system, path = file_system(spark, base)
    names = [status.getPath().getName() for status in system.listStatus(path)]
    tables = sorted(table_name(name) for name in names if name.endswith(_SUFFIX))
    return [name for name in tables if _exists(spark, table_path(base, name))]


def _exists(spark: SparkSession, table: str) -> bool:
    if not versions.is_versioned(spark, table) or versions.commits(spark, table):
        return True
    others = versions._names(spark, table)
    return any(name not in (versions.VERSIONS, versions.COMMITS) for name in others)


def table_counts(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, row_count) of every table below ``base``."""
    return listing.count_tables(spark, list_tables(spark, base), lambda name: read_table(spark, base, name))


def table_schemas(spark: SparkSession, base: str, counted: bool = False) -> DataFrame:
    """(table_name, position, column_name, data_type) of every table below ``base``.

    ``counted`` adds ``row_count``, for which every table is scanned.
    """
    return listing.describe_tables(
        spark, list_tables(spark, base), lambda name: read_table(spark, base, name), counted
    )


def _cast(df: DataFrame, name: str, type_name: str, policy: str, located: bool = False) -> Column:
    """A column under its stored type; ``located`` gives null for a value that does not fit."""
    value, stored = F.col(name), stored_type(type_name, policy)
    if isinstance(df.schema[name].dataType, T.DateType) and isinstance(stored, T.IntegerType):
        value = F.year(value)  # a driver may deliver a year as a date
    value = value.try_cast(stored) if located else value.cast(stored)
    if type_name.strip().lower().startswith("datetime"):
        seconds = F.extract(F.lit("SECOND"), value) % F.lit(0.001).cast("decimal(6,6)")
        value = value - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return value


def typed_cast(
    df: DataFrame, declared: list[tuple[str, str]], policy: str = "source"
) -> DataFrame:
    """Columns in declared order, each cast to the stored type of its declared type.

    A ``datetime`` is cut to whole milliseconds. See :func:`patronage.model.stored_type`.
    """
    return df.select(*[_cast(df, name, kind, policy).alias(name) for name, kind in declared])


#: Column that :func:`located_cast` adds.
FAULTS = "_cast_faults"


def located_cast(
    df: DataFrame, declared: list[tuple[str, str]], policy: str = "source"
) -> DataFrame:
    """As :func:`typed_cast`, but a value that does not fit becomes null, whatever the session's mode.

    The map ``_cast_faults`` has the text of each such value by its column; rows without any have an
    empty map.
    """
    faults, columns = [], []
    for name, kind in declared:
        value = _cast(df, name, kind, policy, located=True)
        columns.append(value.alias(name))
        if df.schema[name].dataType != stored_type(kind, policy):
            lost = F.col(name).isNotNull() & value.isNull()
            faults.append(F.when(lost, F.struct(F.lit(name).alias("key"), F.col(name).cast("string").alias("value"))))
    found = F.map_from_entries(F.filter(F.array(*faults), lambda fault: fault.isNotNull())) if faults else F.create_map()
    return df.select(*columns, found.cast("map<string,string>").alias(FAULTS))


class CastFaults(ValueError):
    """Values that do not fit their declared type: how many in each column, and where their rows are listed."""

    def __init__(self, table: str, counts: dict[str, int], path: str):
        self.counts, self.path = counts, path
        held = ", ".join(f"{count} of {column}" for column, count in counts.items())
        super().__init__(f"table {table!r}: values do not fit their type: {held}; their rows are in {path}")


def clustered(df: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows in ranges of ``keys``, as many rows in each, sorted inside, one file per range.

    Ties are broken by a hash of the whole row, so a key that very many rows share spreads over files
    too. Filters on the first key then read few files and row groups, by the statistics Parquet keeps.
    The rows are computed twice, once for the borders.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns if not _holds_map(df.schema[c].dataType)])
    order = [F.col(key) for key in keys]
    ranged = df.repartitionByRange(files, *order, spread) if files else df.repartitionByRange(*order, spread)
    return ranged.sortWithinPartitions(*order)


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def write_table(
    df: DataFrame,
    base: str,
    name: str,
    run: str | None = None,
    cluster_by: Sequence[str] = (),
    files: int | None = None,
    fault_keys: Sequence[str] | None = None,
) -> tuple[str, int]:
    """Write the table as a new version and commit it; returns the table's path and row count.

    Readers see the old rows until the commit, and go on seeing them if the write fails. The rows are
    counted while they are written, so nothing is read twice. ``run`` names the run in the commit.
    ``cluster_by`` and ``files`` are as for :func:`clustered`. If ``df`` comes from
    :func:`located_cast`, its faults are counted on the write as well; with any, nothing is
    committed, the rows with faults are listed with their ``fault_keys`` (all columns by default) in a
    table of their own, and one :class:`CastFaults` names every column.
    """
    spark, path = df.sparkSession, table_path(base, name)
    table = _folder_for(spark, path)
    number, folder = versions.new_version(spark, table)
    checked = [field.name for field in df.schema.fields if field.name != FAULTS] if FAULTS in df.columns else []
    out = clustered(df, cluster_by, files) if cluster_by else df
    written = Observation()
    lost = [F.count_if(F.map_contains_key(FAULTS, F.lit(column))).alias(f"lost_{i}") for i, column in enumerate(checked)]
    counted = out.observe(written, F.count(F.lit(1)).alias("rows"), *lost).drop(FAULTS)
    counted.write.parquet(versions.folder_of(table, folder))
    found = written.get
    faults = {column: found[f"lost_{i}"] for i, column in enumerate(checked) if found[f"lost_{i}"]}
    if faults:
        side = f"{versions.folder_of(table, folder)}-faults"
        keys = [F.col(key) for key in (fault_keys or checked)]
        df.where(F.size(FAULTS) > 0).select(*keys, F.col(FAULTS).alias("faults")).write.parquet(side)
        raise CastFaults(name, faults, side)
    versions.commit(spark, table, versions.Commit(number, folder, found["rows"], counted.schema.json(), run))
    versions.remove_old(spark, table)
    if table != path:
        system, single = file_system(spark, path)
        _, made = file_system(spark, table)
        system.delete(single, False)
        system.rename(made, single)
    return path, found["rows"]


def _folder_for(spark: SparkSession, path: str) -> str:
    """The table's folder; where a single file stands in its place, one beside it that then replaces the file."""
    system, hadoop_path = file_system(spark, path)
    return f"{path}-new" if system.exists(hadoop_path) and not system.isDirectory(hadoop_path) else path
