"""SQL over the two views. Values are bound as named parameters, never pasted into the text.

Each ``ORDER BY`` ends in keys that break ties. The result is then the same on every run, and a full sort can spread one
value of the first key over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.operators.joins import BROADCAST_LIMIT, ROWS_PER_SPLIT, may_match, measured_bytes, split_join
from starledger.sources.views import MOVIES_VIEW, RATINGS_VIEW


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """A preview of any table: its first ``n`` rows by ``order``, or any ``n`` rows without one."""
    return (df.orderBy(*order) if order else df).limit(n)


def first_movies(spark: SparkSession, n: int = 10) -> DataFrame:
    return spark.sql(
        f"SELECT title, genres FROM {MOVIES_VIEW} ORDER BY movieId, title, genres LIMIT :n", args={"n": n}
    )


def movies_like(spark: SparkSession, pattern: str) -> DataFrame:
    """Movies whose title fits a LIKE pattern; a pattern that only ends in ``%`` is tested in the scan."""
    return spark.sql(f"SELECT * FROM {MOVIES_VIEW} WHERE title LIKE :pattern", args={"pattern": pattern})


def ratings_above(spark: SparkSession, rating: float, n: int | None = None) -> DataFrame:
    """Ratings above a value, highest first: all of them, or the first ``n``."""
    limit = "" if n is None else "LIMIT :n"
    return spark.sql(
        f"""
        SELECT userId, movieId, rating FROM {RATINGS_VIEW} WHERE rating > :rating
        ORDER BY rating DESC, userId, movieId {limit}
        """,
        args={"rating": rating} if n is None else {"rating": rating, "n": n},
    )


def total_ratings(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT count(*) AS total_ratings FROM {RATINGS_VIEW}")


def most_rated(spark: SparkSession, n: int = 5) -> DataFrame:
    """The ``n`` films with the most ratings."""
    return spark.sql(
        f"""
        SELECT movieId, count(*) AS num_ratings FROM {RATINGS_VIEW}
        GROUP BY movieId ORDER BY num_ratings DESC, movieId LIMIT :n
        """,
        args={"n": n},
    )


def ratings_of_title(
    spark: SparkSession, title: str, broadcast_limit: int = BROADCAST_LIMIT, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """The ratings of every film of that title.

    The matching films are measured first. Few, as is usual, are broadcast and the ratings stay where they are; beyond
    the limit both sides are shuffled, a film with very many ratings in splits. A filter of bounded size keeps ratings of
    other films out of that shuffle.
    """
    matches = spark.table(MOVIES_VIEW).filter(F.col("title") == title).select("movieId", "title")
    if measured_bytes(matches) > broadcast_limit:
        rated = spark.table(RATINGS_VIEW).select("movieId", "userId", "rating")
        rated = may_match(rated, matches, "movieId")
        return split_join(rated, matches, "movieId", rows_per_split).select("title", "userId", "rating")
    return spark.sql(
        f"""
        SELECT /*+ BROADCAST(m) */ m.title, r.userId, r.rating
        FROM {MOVIES_VIEW} m JOIN {RATINGS_VIEW} r ON m.movieId = r.movieId
        WHERE m.title = :title
        """,
        args={"title": title},
    )
