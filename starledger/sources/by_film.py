"""Films and ratings stored by film: bucketed tables that are grouped by film and joined on it without a shuffle.

The shuffle is paid once, by the write. Both tables must have the same number of buckets; about the size of the ratings
divided by 1 GB is a good one. A bucket is one task's work, so a film with very many ratings makes its bucket long; sums
per film stream through it in bounded memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starledger.session import shared_folder

BUCKETS = 16


def store_by_film(df: DataFrame, table: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Write a table with a column ``movieId`` under a name of the catalogue, in place of what is there.

    Rows are shuffled by film before the write, so every bucket is one file. ``path`` is where the files lie; without it
    that is a new folder in the shared place.
    """
    path = path or shared_folder(df.sparkSession, table)
    dealt = df.repartition(buckets, "movieId")
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, "movieId").sortBy("movieId")
    writer.saveAsTable(table)


def read_by_film(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
