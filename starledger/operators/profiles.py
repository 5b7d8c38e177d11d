"""Distinct values of columns, all columns in one job and one scan.

Every column is a grouping set of its own: Spark turns a row into one narrow row per column, typed as it was, and makes
those distinct. Values become text after that. A row format such as CSV is then read once, however many columns there
are. ``per_column=True`` makes each column distinct in a branch of its own, which reads a columnar source about once in
total and a row format once per column; the caller knows which it has.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_COLUMN = "__column"


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def _names(df: DataFrame, ignore: Collection[str]) -> list[str]:
    names = [c for c in df.columns if c not in ignore]
    if not names:
        raise ValueError("no column left to profile")
    return names


def _distinct_of_all(df: DataFrame, names: list[str]) -> DataFrame:
    """The distinct values of all columns: ``__column`` is a column's place, and only that column holds the value."""
    # A grouping set leaves its column's bit at 0; the first column has the highest bit.
    places = {((1 << len(names)) - 1) ^ (1 << (len(names) - 1 - i)): i for i in range(len(names))}
    place = F.coalesce(*[F.when(F.col("g") == g, i) for g, i in places.items()])
    sets = df.select(*[F.col(f"`{c}`") for c in names]).groupingSets([[F.col(f"`{c}`")] for c in names], *[F.col(f"`{c}`") for c in names])
    return sets.agg(F.grouping_id().alias("g")).withColumn(_COLUMN, place)


def _named(names: list[str]):
    return F.element_at(F.array(*[F.lit(c) for c in names]), F.col(_COLUMN) + 1).alias("column_name")


def _per_column(df: DataFrame, names: list[str], summary: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [summary(distinct_values(df, name), name) for name in names])


def unique_values(
    df: DataFrame, limit: int | None = 20, ignore: Collection[str] = (), per_column: bool = False
) -> DataFrame:
    """``column_name, value``: distinct values as text, NULL being one.

    Per column the first ``limit`` in text order (NULL first), or all with ``None``. Each task keeps no more than
    ``limit`` values of a column before those of a column come together.
    """
    names = _names(df, ignore)
    if per_column:

        def values(distinct: DataFrame, name: str) -> DataFrame:
            texts = distinct.select(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"))
            return texts if limit is None else texts.orderBy("value").limit(limit)

        return _per_column(df, names, values)
    value = F.coalesce(*[F.when(F.col(_COLUMN) == i, F.col(f"`{c}`").cast("string")) for i, c in enumerate(names)])
    texts = _distinct_of_all(df, names).select(_named(names), value.alias("value"))
    if limit is None:
        return texts
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    return texts.withColumn("rank", rank).filter(F.col("rank") <= limit).drop("rank")


def unique_value_counts(df: DataFrame, ignore: Collection[str] = (), per_column: bool = False) -> DataFrame:
    """``column_name, unique_values``: the exact number of distinct values, NULL counted as one."""
    names = _names(df, ignore)
    if per_column:

        def counted(distinct: DataFrame, name: str) -> DataFrame:
            return distinct.agg(F.count("*").alias("unique_values")).select(F.lit(name).alias("column_name"), "unique_values")

        return _per_column(df, names, counted)
    found = _distinct_of_all(df, names).groupBy(_COLUMN).agg(F.count("*").alias("unique_values"))
    # A table without rows has no values, and a row for each column all the same.
    every = df.sparkSession.range(len(names)).select(F.col("id").cast("int").alias(_COLUMN))
    counts = every.join(F.broadcast(found), _COLUMN, "left")
    return counts.select(_named(names), F.coalesce("unique_values", F.lit(0)).cast("bigint").alias("unique_values"))
