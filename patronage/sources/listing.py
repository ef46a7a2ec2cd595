"""What every source of tables can say of them: columns, types and row counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def declared_schema(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) in column order; a table without columns is an error."""
    if not df.schema.fields:
        raise ValueError("the table has no columns")
    return [(field.name, field.dataType.simpleString()) for field in df.schema.fields]


def count_tables(
    spark: SparkSession, names: Sequence[str], read: Callable[[str], DataFrame]
) -> DataFrame:
    """(table_name, row_count) of the named tables; no rows without any."""
    counts = [
        read(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts) if counts else spark.createDataFrame([], "table_name string, row_count bigint")


def describe_tables(
    spark: SparkSession, names: Sequence[str], read: Callable[[str], DataFrame], counted: bool = False
) -> DataFrame:
    """(table_name, position, column_name, data_type) of the named tables.

    ``counted`` adds ``row_count``, for which every table is scanned.
    """
    rows = [
        (name, position, column, data_type)
        for name in names
        for position, (column, data_type) in enumerate(declared_schema(read(name)), start=1)
    ]
    described = spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")
    return described.join(count_tables(spark, names, read), "table_name") if counted else described
