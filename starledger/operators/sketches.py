"""Approximate numbers of distinct values by HyperLogLog sketches that can be stored and merged.

A sketch has a fixed size, whatever the number of values. One pass fills one per column, and sketches of batches merge
into the sketch of all of them, so a batch that has been profiled need not be read again.
"""

from __future__ import annotations

import math
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, StringType

# Base-2 logarithm of a sketch's slots: 4,096 slots, a few KB per column.
LG_SLOTS = 12


def relative_error(lg_slots: int = LG_SLOTS) -> float:
    """Three standard errors of an estimate: 999 of 1,000 lie within."""
    return 3 * 1.04 / math.sqrt(2**lg_slots)


def _hashable(column: Column, data_type: DataType) -> Column:
    if isinstance(data_type, (IntegerType, LongType, StringType)):
        return column
    if isinstance(data_type, (FloatType, DoubleType)):
        return (column + F.lit(0.0)).cast("string")  # one zero instead of two
    return column.cast("string")


def value_sketches(df: DataFrame, ignore: Collection[str] = (), lg_slots: int = LG_SLOTS) -> DataFrame:
    """``column_name, sketch, has_null``, a row per column of ``df``: one aggregate, one scan, nothing sorted or shuffled
    but a sketch per column and task."""
    fields = [f for f in df.schema.fields if f.name not in ignore]
    if not fields:
        raise ValueError("no column left to profile")
    found = []
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        found.append(F.hll_sketch_agg(_hashable(column, field.dataType), F.lit(lg_slots)).alias(f"sketch_{i}"))
        found.append(F.coalesce(F.bool_or(column.isNull()), F.lit(False)).alias(f"null_{i}"))
    rows = [
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"sketch_{i}").alias("sketch"), F.col(f"null_{i}").alias("has_null"))
        for i, f in enumerate(fields)
    ]
    return df.agg(*found).select(F.inline(F.array(*rows)))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per column from those of several batches. A batch that is given twice changes nothing."""
    return sketches.groupBy("column_name").agg(
        F.hll_union_agg("sketch").alias("sketch"), F.bool_or("has_null").alias("has_null")
    )


def counts_of_sketches(sketches: DataFrame) -> DataFrame:
    """``column_name, unique_values``: estimates, NULL counted as one value."""
    estimate = F.hll_sketch_estimate("sketch") + F.col("has_null").cast("bigint")
    return sketches.select("column_name", estimate.alias("unique_values"))


def unique_value_counts_approx(df: DataFrame, ignore: Collection[str] = (), lg_slots: int = LG_SLOTS) -> DataFrame:
    """``column_name, unique_values`` like ``unique_value_counts``, within ``relative_error(lg_slots)`` of it."""
    return counts_of_sketches(value_sketches(df, ignore, lg_slots))
