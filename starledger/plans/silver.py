"""Cleaned tables: one row per film and genre, one row per rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions import (
    epoch_to_timestamp,
    genre_list,
    real_genre,
    real_genres,
    release_year,
    valid_rating,
)


def films(movies: DataFrame) -> DataFrame:
    """One row per film: ``movieId, title, year, genre_list``.

    Of several rows with one id the greatest by title and genres stays, a NULL losing to any text. The rule makes the
    result independent of the order in which rows arrive, so a repeated task agrees with the first. Genres stay in an
    array, so what follows joins one row per film and unfolds genres last.
    """
    kept = movies.groupBy("movieId").agg(F.max(F.struct("title", "genres")).alias("kept"))
    return kept.select(
        "movieId",
        F.col("kept.title").alias("title"),
        release_year(F.col("kept.title")).alias("year"),
        genre_list(F.col("kept.genres")).alias("genre_list"),
    )


def unfold_genres(df: DataFrame) -> DataFrame:
    """One row per genre in place of the array, the marker text as NULL; a row without an array goes."""
    others = [c for c in df.columns if c != "genre_list"]
    unfolded = df.select(*others, F.explode("genre_list").alias("genre"))
    return unfolded.withColumn("genre", real_genre(F.col("genre")))


def movies_silver(movies: DataFrame) -> DataFrame:
    """``movieId, title, year, genre``, one row per film and genre."""
    return unfold_genres(films(movies))


def ratings_silver(ratings: DataFrame) -> DataFrame:
    """``userId, movieId, rating, timestamp, rating_timestamp``, invalid ratings as NULL and the epoch as a long."""
    return ratings.select(
        "userId",
        "movieId",
        valid_rating(F.col("rating")).alias("rating"),
        F.col("timestamp").cast("bigint").alias("timestamp"),
        epoch_to_timestamp(F.col("timestamp")).alias("rating_timestamp"),
    )


def complete_films(movies: DataFrame) -> DataFrame:
    """Films of which at least one genre row is complete, with the genres of those rows."""
    return (
        films(movies)
        .filter(F.col("movieId").isNotNull() & F.col("title").isNotNull() & F.col("year").isNotNull())
        .withColumn("genre_list", real_genres(F.col("genre_list")))
        .filter(F.size("genre_list") > 0)
    )


def complete_ratings(ratings: DataFrame) -> DataFrame:
    """Silver ratings without missing values, the tests put on the columns as read so that they reach the scan."""
    present = (
        F.col("userId").isNotNull()
        & F.col("movieId").isNotNull()
        & F.col("timestamp").isNotNull()
        & (F.col("rating") > 0)
        & ~F.isnan("rating")
    )
    return ratings_silver(ratings.filter(present))
