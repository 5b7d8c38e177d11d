"""Duplicate audit and removal. NULL counts as a key value of its own throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_report(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row: rows in all, rows that are unique on the keys, and the duplicates between the two.

    Rows are counted per key before the shuffle, so a key with very many copies travels as one row per task.
    """
    copies = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    totals = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0).cast("bigint")).alias("total_rows"), F.count("*").alias("unique_rows")
    )
    return totals.select(
        F.lit(name).alias("table_name"),
        "total_rows",
        "unique_rows",
        (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_rows"),
    )


def remove_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever comes first; where the choice matters use ``keep_first``."""
    return df.dropDuplicates(list(keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of each key that is first by ``order``; give a total order and the outcome is the same on every run.

    Spark turns ``row_number = 1`` into a group limit on both sides of the shuffle, so a task sends at most one row per
    key, however many copies it holds.
    """
    rank = "__rank"
    in_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(in_key)).filter(F.col(rank) == 1).drop(rank)
