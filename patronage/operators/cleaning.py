"""Row filters, duplicate removal, casts and column housekeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_any_null(df: DataFrame) -> DataFrame:
    """Keep rows without a null in any column."""
    return df.na.drop("any")


def drop_null_in(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows without a null in the named columns."""
    return df.na.drop("any", subset=list(columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows. Copies meet in the map-side aggregate before the shuffle."""
    return df.dropDuplicates()


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remove columns; an unknown name is an error, unlike in ``DataFrame.drop``."""
    missing = set(columns) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.drop(*columns)


def to_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to int, cutting off fractions.

    A null, a text that is no number or a number beyond int fails the job, ANSI mode or not.
    """
    casts = {}
    for name in columns:
        refused = F.raise_error(F.lit(f"cannot cast null in {name} to int, or a value beyond it"))
        casts[name] = F.coalesce(F.col(name).try_cast("int"), refused.cast("int"))
    return df.withColumns(casts)


def add_date(df: DataFrame, alias: str, year: str, month: str, day: str) -> DataFrame:
    """Date from its parts; a missing part gives null.

    Parts that are no calendar date fail the job, ANSI mode or not.
    """
    parts = [F.col(name) for name in (year, month, day)]
    text = F.format_string("%04d-%02d-%02d", *parts)
    refused = F.raise_error(F.concat(F.lit("no calendar date: "), text)).cast("date")
    known = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    return df.withColumn(alias, F.when(known, F.coalesce(text.try_cast("date"), refused)))


def move_column(df: DataFrame, name: str, position: int) -> DataFrame:
    """The same columns with ``name`` at ``position``, counted from 0."""
    rest = [column for column in df.columns if column != name]
    return df.select(*rest[:position], name, *rest[position:])
