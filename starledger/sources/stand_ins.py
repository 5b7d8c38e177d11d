"""Movies and ratings derived from order-line and part tables, for data sets that hold no ratings of their own.

Both are narrow projections of one scan, so they grow with the tables they come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions import NO_GENRES

# A title that broke apart in a CSV file and was read as a genre.
LEAKED_GENRE = ' Friend"" (2014)"'


# The largest id of the schemas.
MOST_ID = 2**31 - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _id(key: str) -> Column:
    """A key as a 32-bit id, as the schemas have them. A key beyond that makes the query fail: two would share an id."""
    beyond = F.raise_error(F.concat(F.lit(f"{key} is no 32-bit id: "), F.col(key).cast("string"))).cast("int")
    return F.when(F.col(key).between(-MOST_ID - 1, MOST_ID) | F.col(key).isNull(), F.col(key).try_cast("int")).otherwise(beyond)


def ratings_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One rating per order line: 0.0 to 5.0 in halves, 0.0 being invalid."""
    return lineitem.select(
        _id("l_orderkey").alias("userId"),
        _id("l_partkey").alias("movieId"),
        (F.floor(F.col("l_discount") * 100 + 0.5) / 2).cast("float").alias("rating"),
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("int").alias("timestamp"),
    )


def _year_text() -> Column:
    return (F.lit(1950) + F.col("p_partkey") % 60).cast("string")


def _title() -> Column:
    with_year = F.concat("p_name", F.lit(" ("), _year_text(), F.lit(")"))
    return F.when(F.col("p_partkey") % 37 == 0, F.col("p_name")).otherwise(with_year)


def _genres() -> Column:
    return (
        F.when(F.col("p_partkey") % 41 == 0, F.lit(NO_GENRES))
        .when(F.col("p_size") % 3 == 0, F.col("p_type"))
        .when(F.col("p_size") % 3 == 1, F.concat_ws("|", "p_type", F.substring("p_name", 1, 3)))
        .otherwise(F.concat_ws("|", "p_type", F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))))
    )


def movies_from_part(part: DataFrame) -> DataFrame:
    """One film per part: some without a year, some without a genre, the number of genres varying within a year."""
    return part.select(_id("p_partkey").alias("movieId"), _title().alias("title"), _genres().alias("genres"))


def leaky_movies_from_part(part: DataFrame) -> DataFrame:
    """The same films, but the genre field of some holds what a badly read CSV file leaves there."""
    leaked_title = F.concat(F.lit(" "), F.col("p_name"), F.lit('"" ('), _year_text(), F.lit(')"'))
    return part.select(
        _id("p_partkey").alias("movieId"),
        _title().alias("title"),
        F.when(F.col("p_partkey") % 53 == 0, F.lit(LEAKED_GENRE))
        .when(F.col("p_partkey") % 29 == 0, leaked_title)
        .otherwise(_genres())
        .alias("genres"),
    )


def quoted_movies_from_part(part: DataFrame) -> DataFrame:
    """The same films with quote marks and a comma in every title, the hard case of a CSV file."""
    quoted = F.concat(F.lit('"'), F.replace(F.col("p_name"), F.lit(" "), F.lit('", ')), F.lit(" ("), _year_text(), F.lit(")"))
    return part.select(_id("p_partkey").alias("movieId"), quoted.alias("title"), _genres().alias("genres"))


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return movies_from_part(table(spark, folder, "part"))


def leaky_movies(spark: SparkSession, folder: str) -> DataFrame:
    return leaky_movies_from_part(table(spark, folder, "part"))


def quoted_movies(spark: SparkSession, folder: str) -> DataFrame:
    return quoted_movies_from_part(table(spark, folder, "part"))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return ratings_from_lineitem(table(spark, folder, "lineitem"))
