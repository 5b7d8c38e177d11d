"""Tables under names that SQL text can use."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The names the SQL queries use.
MOVIES_VIEW = "movies_view"
RATINGS_VIEW = "ratings_view"


def register_views(
    movies: DataFrame, ratings: DataFrame, movies_view: str = MOVIES_VIEW, ratings_view: str = RATINGS_VIEW
) -> None:
    movies.createOrReplaceTempView(movies_view)
    ratings.createOrReplaceTempView(ratings_view)
