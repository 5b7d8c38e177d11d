"""Values that ended up in the wrong column: set them apart, drop them, count them.

A NULL matches nothing and differs from nothing, so the filters that keep the rest drop NULL as well; the reports count
it apart, and kept + matching + null is the total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A bracketed year with a quote mark somewhere after it, the trace of a title that broke apart. Equivalent to the fixed
# pattern with '.*' before the bracket, without that lead-in: a search starts anywhere as it is.
LEAKED_TITLE = r'\(\d{4}\).*"'


def only_matching(df: DataFrame, column: str, pattern: str = LEAKED_TITLE) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def drop_matching(df: DataFrame, column: str, pattern: str = LEAKED_TITLE) -> DataFrame:
    return df.filter(~F.col(column).rlike(pattern))


def drop_value(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) != value)


def _report(df: DataFrame, hit: Column, column: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(hit).alias("removed_rows"),
        F.count_if(~hit).alias("kept_rows"),
        F.count_if(F.col(column).isNull()).alias("null_rows"),
    )


def matching_report(df: DataFrame, column: str, pattern: str = LEAKED_TITLE) -> DataFrame:
    """One row on what ``drop_matching`` does, counted in one pass."""
    return _report(df, F.col(column).rlike(pattern), column)


def value_report(df: DataFrame, column: str, value: object) -> DataFrame:
    """One row on what ``drop_value`` does, counted in one pass."""
    return _report(df, F.col(column) == value, column)
