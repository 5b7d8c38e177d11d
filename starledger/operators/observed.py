"""Reports that cost no pass of their own: counted while a table is written.

Spark carries the counts along with the rows (``DataFrame.observe``), so one job writes the table and knows what became
of every row. A count sits between two steps; filters do not move across it, so tests that would reach a scan run on the
rows instead. Counts are those of the job that wrote the table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starledger.operators.duplicates import keep_first
from starledger.operators.misfiled import LEAKED_TITLE
from starledger.operators.missing import drop_incomplete


@dataclass
class Watched:
    """Cleaned rows, and what will be known of them once they have been written."""

    rows: DataFrame
    columns: list[str]
    read: Observation
    sound: Observation
    complete: Observation
    kept: Observation


def _count(df: DataFrame, *more: Column) -> tuple[DataFrame, Observation]:
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *more), observation


def watched(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], leaked: str | None = None, pattern: str = LEAKED_TITLE
) -> Watched:
    """Rows without leaked values in column ``leaked``, without missing values, one per key, the first by ``order``."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)]
    hit = F.col(f"`{leaked}`").rlike(pattern) if leaked else F.lit(False)
    rows, read = _count(df, F.count_if(hit).alias("leaked"), *nulls)
    # A NULL is no leak here; it goes with the missing values.
    rows, sound = _count(rows.filter(~F.coalesce(hit, F.lit(False))))
    rows, complete = _count(drop_incomplete(rows))
    rows, kept = _count(keep_first(rows, keys, order))
    return Watched(rows, df.columns, read, sound, complete, kept)


def _measured(observation: Observation) -> dict[str, int]:
    """The counts; all 0 where Spark knew beforehand that there are no rows and dropped the counting with them."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return defaultdict(int)


def store_clean(
    df: DataFrame,
    path: str,
    name: str,
    keys: Sequence[str],
    order: Sequence[str | Column],
    leaked: str | None = None,
    pattern: str = LEAKED_TITLE,
) -> DataFrame:
    """Write the rows of ``watched`` to ``path``, in place of what is there, and report on them.

    The report has ``table_name, measure, column_name, value``: the share of NULL per column as read (NULL for an empty
    table), rows read, leaked rows, rows dropped for missing values, duplicate rows, and rows written.
    """
    found = watched(df, keys, order, leaked, pattern)
    found.rows.write.mode("overwrite").parquet(path)
    read, sound, complete, kept = map(_measured, (found.read, found.sound, found.complete, found.kept))
    counts = {
        "rows_read": read["rows"],
        "leaked_rows": read["leaked"],
        "incomplete_rows": sound["rows"] - complete["rows"],
        "duplicate_rows": complete["rows"] - kept["rows"],
        "rows_written": kept["rows"],
    }
    rows = [(name, measure, None, float(n)) for measure, n in counts.items()]
    shares = [read[f"null_{i}"] / read["rows"] if read["rows"] else None for i in range(len(found.columns))]
    rows += [(name, "null_share", c, share) for c, share in zip(found.columns, shares, strict=True)]
    spark: SparkSession = df.sparkSession
    return spark.createDataFrame(rows, "table_name string, measure string, column_name string, value double")
