"""Missing values: shares per column, removal, and a report; each is one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions import is_present, ratio


def null_ratios(df: DataFrame) -> DataFrame:
    """One row: the share of NULL in every column, under the column's own name; NULL for an empty table."""
    return df.agg(*[ratio(F.count_if(F.col(c).isNull()), F.count("*")).alias(c) for c in df.columns])


def _complete(df: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [is_present(F.col(f.name), f.dataType) for f in df.schema.fields])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without a NULL or NaN in any column.

    Same rows as ``na.drop()``, but stated per column: the tests then reach the scan and move below joins.
    """
    return df.filter(_complete(df))


def null_drop_report(df: DataFrame, name: str) -> DataFrame:
    """One row: rows before, rows that ``drop_incomplete`` removes, rows after."""
    counts = df.agg(F.count("*").alias("rows_before"), F.count_if(_complete(df)).alias("rows_after"))
    return counts.select(
        F.lit(name).alias("table_name"),
        "rows_before",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
        "rows_after",
    )
