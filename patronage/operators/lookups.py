"""Joins to dimension tables with a unique key.

A dimension is broadcast only after its size has been measured. Beyond the budget the join
shuffles, rows without a key are spread over all tasks, and adaptive execution splits
a partition that a hot key made too large.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BUDGET = 64 * 1024 * 1024
NULL_KEY_SPREAD = 4096

_ROW_OVERHEAD = 32
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def row_bytes(frame: DataFrame) -> Column:
    """In-memory size of a row of the frame."""
    width = F.lit(_ROW_OVERHEAD + 16 * len(frame.columns)).cast("long")
    for field in frame.schema.fields:
        if not isinstance(field.dataType, _FIXED_WIDTH):
            length = F.octet_length(F.col(field.name).cast("string"))
            width = width + F.coalesce(length, F.lit(0))
    return width


def measured_bytes(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """In-memory size of each frame, from one job that returns one number per frame."""
    widths = [frame.select(F.lit(name).alias("name"), row_bytes(frame).alias("width")) for name, frame in frames.items()]
    total = reduce(DataFrame.unionByName, widths).groupBy("name").agg(F.sum("width"))
    return {**dict.fromkeys(frames, 0), **dict(total.collect())}


def fits_broadcast(
    frames: Mapping[str, DataFrame], budget: int = BROADCAST_BUDGET
) -> dict[str, bool]:
    """Which of the frames are small enough to send to every executor."""
    return {name: size <= budget for name, size in measured_bytes(frames).items()}


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    left_key: str,
    lookup_key: str,
    how: str,
    fits: bool,
) -> DataFrame:
    """Join to a frame unique on ``lookup_key``; ``how`` is ``inner`` or ``left``.

    Both key columns stay in the result.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup join must be inner or left, not {how!r}")
    same_key = F.col(left_key) == F.col(lookup_key)
    if fits:
        return left.join(F.broadcast(lookup), same_key, how)
    if how == "inner":
        return left.join(lookup, same_key, how)
    # Null keys never match, yet all would hash to one task. The second join column moves
    # them apart; it is computed from the row, so a retried task repeats it exactly. On the
    # lookup side it is always 0, but computed: a literal would be folded out of the join keys.
    row_hash = F.pmod(F.xxhash64(*left.columns), F.lit(NULL_KEY_SPREAD))
    spread = F.when(F.col(left_key).isNull(), row_hash + 1).otherwise(0)
    salted = left.withColumn("left_spread", spread.cast("long"))
    zero = F.pmod(F.xxhash64(lookup_key), F.lit(1))
    plain = lookup.withColumn("lookup_spread", zero.cast("long"))
    both = same_key & (F.col("left_spread") == F.col("lookup_spread"))
    return salted.join(plain, both, how).drop("left_spread", "lookup_spread")
