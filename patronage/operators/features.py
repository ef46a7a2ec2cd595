"""Standard scaling and label encoding."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.operators.lookups import BROADCAST_BUDGET, lookup_join, row_bytes


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, without the excluded ones."""
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in exclude
    ]


def _moments(name: str) -> tuple[Column, Column]:
    value = F.col(name).cast("double")
    return F.avg(value), F.stddev_pop(value)


def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std) with the population deviation; nulls are ignored.

    One aggregate over all columns, whose single row is then turned on its side.
    """
    aggregates = []
    for name in columns:
        mean, std = _moments(name)
        aggregates.append(F.struct(F.lit(name).alias("column"), mean.alias("mean"), std.alias("std")).alias(name))
    sideways = F.explode(F.array(*columns)).alias("stats")
    return df.agg(*aggregates).select(sideways).select("stats.*")


def observed_stats(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Callable[[], list[dict]]]:
    """``df`` with the statistics of :func:`scaler_stats` taken while it is written, and a function
    that gives them once it has been, so that no scan of its own is needed."""
    if not columns:
        return df, list
    seen, aggregates = Observation(), []
    for i, name in enumerate(columns):
        mean, std = _moments(name)
        aggregates += [mean.alias(f"mean_{i}"), std.alias(f"std_{i}")]

    def stats() -> list[dict]:
        found = seen.get
        return [{"column": name, "mean": found[f"mean_{i}"], "std": found[f"std_{i}"]} for i, name in enumerate(columns)]

    return df.observe(seen, *aggregates), stats


def standard_scale(
    df: DataFrame, columns: Sequence[str], stats: DataFrame | Sequence[dict] | None = None
) -> DataFrame:
    """``(x - mean) / std`` as double; a constant column is only centred, nulls stay null.

    The statistics, one row per column, are the only thing that reaches the driver.
    """
    stats = scaler_stats(df, columns) if stats is None else stats
    rows = stats.collect() if isinstance(stats, DataFrame) else stats
    scaled = {}
    for row in rows:
        value = F.col(row["column"]).cast("double")
        if row["mean"] is None:
            scaled[row["column"]] = value
        else:
            scaled[row["column"]] = (value - F.lit(row["mean"])) / F.lit(row["std"] or 1.0)
    return df.withColumns(scaled)


def label_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (column, value) of columns of one type, nulls left out, in one pass."""
    pairs = [F.struct(F.lit(name).alias("column"), F.col(name).alias("value")) for name in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .where(F.col("value").isNotNull())
        .distinct()
    )


@dataclass(frozen=True)
class Ranked:
    """(column, value, code) of labels, and for each column how many there are and what they take in memory."""

    codes: DataFrame
    counts: dict[str, int]
    sizes: dict[str, int]


#: Rows below this number of a partition keep their place in it in the lower bits of a row number.
_PLACES = 33


def rank_labels(pairs: DataFrame, scratch: str) -> Ranked:
    """Codes count from 0 in value order within each column, for any number of labels.

    The distinct pairs are written once, so that the borders of their range partitions cannot move,
    and again in these, sorted, with their row numbers. A code is a row's place in its partition, less
    that of the column's first row there, plus the column's rows in the partitions before: one job
    counts these, one row per column and partition. NaN ranks after all numbers. ``scratch`` is an
    unused folder for these tables; the result reads it.
    """
    spark = pairs.sparkSession
    pairs.write.parquet(f"{scratch}/pairs")
    written = spark.read.schema(pairs.schema).parquet(f"{scratch}/pairs")
    ordered = written.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    ordered.withColumn("number", F.monotonically_increasing_id()).write.parquet(f"{scratch}/placed")
    placed = spark.read.schema(pairs.schema.add("number", "long")).parquet(f"{scratch}/placed")
    placed = placed.withColumn("block", F.shiftright("number", _PLACES))
    held = placed.groupBy("column", "block").agg(
        F.min("number").alias("first"), F.count(F.lit(1)).alias("labels"), F.sum(row_bytes(pairs)).alias("bytes")
    )
    counts: dict[str, int] = {}
    sizes: dict[str, int] = {}
    offsets = []
    for row in sorted(held.collect(), key=lambda row: (row["column"], row["block"])):
        name = row["column"]
        offsets.append((name, row["block"], row["first"] - counts.get(name, 0)))
        counts[name] = counts.get(name, 0) + row["labels"]
        sizes[name] = sizes.get(name, 0) + row["bytes"]
    starts = spark.createDataFrame(offsets, "column string, block long, start long")
    code = (F.col("number") - F.col("start")).cast("int").alias("code")
    codes = placed.join(F.broadcast(starts), ["column", "block"]).select("column", "value", code)
    return Ranked(codes, counts, sizes)


def label_map(df: DataFrame, columns: Sequence[str], scratch: str) -> DataFrame:
    """(column, value, code) of columns of one type, codes as in :func:`label_encode`."""
    return rank_labels(label_pairs(df, columns), scratch).codes


def label_encode(
    df: DataFrame,
    columns: Sequence[str],
    scratch: str,
    fit_on: DataFrame | None = None,
    budget: int = BROADCAST_BUDGET,
) -> DataFrame:
    """Replace each value by its rank among the column's sorted distinct values, from 0.

    A missing value gets the code after the last. NaN is a value like any other, the last one.
    ``fit_on`` may name another frame to take the labels from; a value it lacks fails the job.
    The labels are found in one pass over ``fit_on``, ranked whatever their number, and joined to;
    a column's map is broadcast if it measures up to ``budget`` bytes. ``scratch`` is an unused
    folder for the maps, which the result reads.
    """
    by_type: dict[T.DataType, list[str]] = {}
    for name in columns:
        by_type.setdefault(df.schema[name].dataType, []).append(name)
    encoded = df
    for number, names in enumerate(by_type.values()):
        ranked = rank_labels(label_pairs(df if fit_on is None else fit_on, names), f"{scratch}/labels{number}")
        encoded = _encode_by_join(encoded, names, ranked, budget)
    return encoded.select(df.columns)


def _encode_by_join(df: DataFrame, names: Sequence[str], ranked: Ranked, budget: int) -> DataFrame:
    codes = ranked.codes
    maps = {
        name: codes.where(F.col("column") == name).select(
            F.col("value").alias(f"{name}_label"), F.col("code").alias(f"{name}_label_code")
        )
        for name in names
    }
    for name in names:
        label, code = f"{name}_label", f"{name}_label_code"
        joined = lookup_join(df, maps[name], name, label, "left", ranked.sizes.get(name, 0) <= budget)
        value = F.col(name)
        unseen = F.concat(F.lit(f"unseen label in {name}: "), value.cast("string"))
        found = (
            F.when(value.isNull(), F.lit(ranked.counts.get(name, 0)))
            .when(F.col(code).isNotNull(), F.col(code))
            .otherwise(F.raise_error(unseen).cast("int"))
        )
        df = joined.withColumn(name, found.cast("int")).drop(label, code)
    return df
