"""Column expressions of the customer queries. All of them compile to JVM code."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.model import RATE, TOTAL


def null_default(value: Column, dtype: T.DataType | str) -> Column:
    """``value``, or zero of the same type. An untyped zero would widen a decimal."""
    return F.coalesce(value.cast(dtype), F.lit(0).cast(dtype))


def presence_flag(value: Column) -> Column:
    """1 where ``value`` is present, else 0."""
    return F.when(value.isNotNull(), F.lit(1)).otherwise(F.lit(0))


def channel_value(channel: Column, name: str, value: Column) -> Column:
    """``value`` on rows of the named channel, 0 on all others."""
    return F.when(channel == F.lit(name), value).otherwise(F.lit(0))


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; 0 where ``whole`` is null, zero or negative."""
    ratio = part.cast("double") / whole.cast("double")
    return F.when(whole > 0, ratio).otherwise(F.lit(0.0))


def return_percentage(returned: Column, sold: Column) -> Column:
    """Returns as a percentage of sales, 0 where sales are null, zero or negative.

    The factor 100 comes before the division: Spark gives a wide decimal quotient six
    decimals, and multiplying afterwards would leave only four good ones.
    """
    percent = returned.cast(TOTAL) * F.lit(100) / sold.cast(TOTAL)
    return F.when(sold > 0, percent).otherwise(F.lit(0)).cast(RATE)


def total_of(*parts: Column) -> Column:
    """Sum of columns; null as soon as one part is null."""
    return reduce(add, parts)


def net_amount(sold: Column, returned: Column, dtype: T.DataType | str) -> Column:
    """Sales less returns, a missing side counting as zero."""
    return null_default(sold, dtype) - null_default(returned, dtype)
