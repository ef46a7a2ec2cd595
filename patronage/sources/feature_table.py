"""The typed feature table, as a Parquet folder or as a catalog table that keeps its constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.model import FEATURE_TABLE

#: Table property that lists the columns declared NOT NULL, as Spark forgets that of file tables.
NOT_NULL = "patronage.not_null"


def _without_null(value: Column, name: str, kind: T.DataType) -> Column:
    """The value, or an error where it is null."""
    message = F.lit(f"null in NOT NULL column {name}")
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(message).cast(kind))


def typed_features(df: DataFrame, schema: T.StructType = FEATURE_TABLE) -> DataFrame:
    """The schema's columns, cast to its types; a null in a NOT NULL column fails the job."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = _without_null(value, field.name, field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def write_features(df: DataFrame, path: str, schema: T.StructType = FEATURE_TABLE) -> None:
    """Replace the Parquet table at ``path`` with the typed columns of ``df``."""
    typed_features(df, schema).write.mode("overwrite").parquet(path)


def create_features(spark: SparkSession, table: str, schema: T.StructType = FEATURE_TABLE) -> None:
    """Create the catalog table with its types and constraints, unless it is there."""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in schema.fields
    )
    kept = ",".join(field.name for field in schema.fields if not field.nullable)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet TBLPROPERTIES ('{NOT_NULL}' = '{kept}')")


def declared_features(spark: SparkSession, table: str) -> T.StructType:
    """The catalog table's columns, types and constraints."""
    properties = dict(tuple(row) for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect())
    kept = properties.get(NOT_NULL, "").split(",")
    return T.StructType([T.StructField(f.name, f.dataType, f.name not in kept) for f in spark.table(table).schema.fields])


def insert_features(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Add rows to the catalog table, or replace its rows, under its constraints.

    Columns go by name; one that the table lacks, or that ``df`` lacks, is an error. Values are
    assigned as a database stores them: a type that does not convert safely is refused before
    anything is written, a value that does not fit and a null in a NOT NULL column fail the job.
    """
    declared = declared_features(df.sparkSession, table)
    if set(df.columns) != set(declared.names):
        raise ValueError(f"columns differ from those of {table}: {sorted(set(df.columns) ^ set(declared.names))}")
    columns = [
        F.col(f.name) if f.nullable else _without_null(F.col(f.name), f.name, df.schema[f.name].dataType).alias(f.name)
        for f in declared.fields
    ]
    df.select(*columns).write.insertInto(table, overwrite=overwrite)


def save_features(df: DataFrame, table: str, schema: T.StructType = FEATURE_TABLE) -> None:
    """Replace the rows of the catalog table with those of ``df``, creating the table if need be.

    A table of other columns or types under that name is an error.
    """
    spark = df.sparkSession
    create_features(spark, table, schema)
    declared = declared_features(spark, table)
    if declared != schema:
        raise ValueError(f"{table} is not a feature table of this schema")
    insert_features(typed_features(df, schema), table, overwrite=True)


#: What stands for a value that cannot occur, to tell Spark that the column has no null.
_NEVER = {T.IntegerType(): 0, T.LongType(): 0, T.DoubleType(): 0.0, T.StringType(): ""}


def read_features(spark: SparkSession, table: str) -> DataFrame:
    """The catalog table under its declared schema, NOT NULL included; a null that got in otherwise fails the job."""
    columns = []
    for field in declared_features(spark, table).fields:
        value = F.col(field.name)
        if not field.nullable:
            never = F.lit(_NEVER.get(field.dataType, 0)).cast(field.dataType)
            value = F.coalesce(_without_null(value, field.name, field.dataType), never).alias(field.name)
        columns.append(value)
    return spark.table(table).select(*columns)


def stored_features(spark: SparkSession, place: str) -> DataFrame:
    """The feature table at a path, which has a slash or a colon, or of a catalog name."""
    return spark.read.parquet(place) if "/" in place or ":" in place else read_features(spark, place)
