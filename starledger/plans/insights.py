"""Answers over gold rows: per genre and per release year.

Every mean is over gold rows, so a rating weighs as many times as its film has genres; the one exception says so in its
name.

Each insight needs only counts and sums per group. They can be taken from a gold table (``genre_totals``,
``year_totals``), or from the tables as read without building gold rows: ``film_totals`` sums the ratings of each film,
``genre_totals_of_films`` and ``year_totals_of_films`` go on from there. That is at most one row per film and task to
shuffle, whatever the number of ratings and however uneven they are spread, and genres unfold on films instead of
ratings. Both ways give the same totals. Written once, the film totals serve every insight without another look at the
ratings.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions import percent, ratio
from starledger.operators.joins import ROWS_PER_SPLIT, split_join
from starledger.plans import silver
from starledger.session import shared_folder

# Fixed value: the number of ratings from which a genre's own mean outweighs the mean of all.
RELIABLE_RATINGS = 1000

# Accuracy of quantile sketches: about 1.3 % of the rows at 200, a sketch having a few KB.
QUANTILE_K = 200

# Totals carried per group: gold rows, rows with a rating, and the sum of those ratings.
_ROWS, _RATED, _SUM = "rows", "rated_rows", "rating_sum"


def _totals(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias(_ROWS), F.count("rating").alias(_RATED), F.sum("rating").alias(_SUM)
    )


def _added(totals: DataFrame, key: str, weight: Column | None = None) -> DataFrame:
    """Totals of finer groups added up, each counted ``weight`` times."""

    def total(name: str) -> Column:
        value = F.col(name) if weight is None else F.col(name) * weight
        return F.sum(value).alias(name)

    return totals.groupBy(key).agg(total(_ROWS), total(_RATED), total(_SUM))


def genre_totals(gold: DataFrame) -> DataFrame:
    return _totals(gold, "genre")


def year_totals(gold: DataFrame) -> DataFrame:
    return _totals(gold.filter(F.col("year").isNotNull()), "year")


def film_totals(
    movies: DataFrame,
    ratings: DataFrame,
    drop_nulls: bool = True,
    by_rating: bool = False,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Rating totals per film (and rating value, if ``by_rating``) with the film's title, year and genres.

    Both sides of the join hold one row per film and are shuffled by its id, so the join needs no further shuffle. With
    ``by_rating`` a film has a row per rating value, of which a fine scale gives very many: the totals are shuffled once
    more, by film, and a film with many values is split. They are written to the shared folder first, as the keys are
    counted before they are joined.
    """
    rating_rows = silver.complete_ratings(ratings) if drop_nulls else silver.ratings_silver(ratings)
    film_rows = silver.complete_films(movies) if drop_nulls else silver.films(movies)
    if by_rating:
        totals, folder = _totals(rating_rows, "movieId", "rating"), shared_folder(ratings.sparkSession, "rating-totals")
        totals.write.parquet(folder)
        stored = ratings.sparkSession.read.schema(totals.schema).parquet(folder)
        return split_join(stored, film_rows, "movieId", rows_per_split)
    return _totals(rating_rows, "movieId").join(film_rows, "movieId", "inner")


def store_film_totals(movies: DataFrame, ratings: DataFrame, path: str, drop_nulls: bool = True) -> None:
    """Write the totals of all films, in place of what is there: one pass over the ratings for every insight."""
    film_totals(movies, ratings, drop_nulls).write.mode("overwrite").parquet(path)


def read_film_totals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def add_rating_totals(ratings: DataFrame, path: str, batch: str, drop_nulls: bool = True) -> None:
    """Store the totals per film of one batch of ratings beside those of other batches: only the batch is read.

    A batch has a folder of its own, so one that is given again, after a failure or by mistake, takes its own place and
    counts once.
    """
    rating_rows = silver.complete_ratings(ratings) if drop_nulls else silver.ratings_silver(ratings)
    _totals(rating_rows, "movieId").write.mode("overwrite").parquet(_batch_folder(path, batch))


def _batch_folder(path: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]*[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
        raise ValueError("a batch is named by letters, digits and _ . -")
    return f"{path.rstrip('/')}/batch={batch}"


def merged_film_totals(movies: DataFrame, path: str, drop_nulls: bool = True) -> DataFrame:
    """What ``film_totals`` gives for the ratings of all stored batches, films being those of now."""
    film_rows = silver.complete_films(movies) if drop_nulls else silver.films(movies)
    stored = movies.sparkSession.read.parquet(path).drop("batch")
    return _added(stored, "movieId").join(film_rows, "movieId", "inner")


def genre_totals_of_films(films: DataFrame) -> DataFrame:
    return _added(silver.unfold_genres(films), "genre")


def year_totals_of_films(films: DataFrame, genre_weighted: bool = True) -> DataFrame:
    """Totals per year; a film's totals count once per genre, or once if not ``genre_weighted``."""
    in_gold = films.filter(F.col("year").isNotNull() & (F.size("genre_list") > 0))
    return _added(in_gold, "year", F.size("genre_list") if genre_weighted else None)


def genre_popularity(totals: DataFrame) -> DataFrame:
    """``genre, num_ratings``, most rated first."""
    return totals.select("genre", F.col(_RATED).alias("num_ratings")).orderBy(F.desc("num_ratings"), "genre")


def genre_avg_rating(totals: DataFrame) -> DataFrame:
    """``genre, avg_rating``, best first."""
    return totals.select("genre", _mean().alias("avg_rating")).orderBy(F.desc("avg_rating"), "genre")


def genre_bayesian_avg(totals: DataFrame, reliable: float = RELIABLE_RATINGS) -> DataFrame:
    """``genre, v, R, C, adjusted_rating``: the genre mean R drawn towards the mean of all rows C.

    R weighs ``v / (v + reliable)`` with v ratings, C the rest. C is a scalar subquery over the same totals.
    """
    overall = totals.agg(ratio(F.sum(_SUM), F.sum(_RATED))).scalar()
    v, own, everyone = F.col("v"), F.col("R"), F.col("C")
    weights = v + F.lit(reliable)
    return (
        totals.select("genre", F.col(_RATED).alias("v"), _mean().alias("R"), overall.alias("C"))
        .withColumn("adjusted_rating", ratio(v, weights) * own + ratio(F.lit(reliable), weights) * everyone)
        .orderBy(F.desc("adjusted_rating"), "genre")
    )


def genre_share_pct(totals: DataFrame, genre: str, of_genre: str) -> DataFrame:
    """One row: the gold rows of ``genre`` in percent of those of ``of_genre``, NULL if the latter has none."""

    def rows_of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("genre") == name, F.col(_ROWS))), F.lit(0))

    wanted = totals.filter(F.col("genre").isin(genre, of_genre))
    return wanted.agg(percent(rows_of(genre), rows_of(of_genre)).alias("share_pct"))


def avg_rating_by_year(totals: DataFrame) -> DataFrame:
    """``year, avg_rating`` in order of years."""
    return totals.select("year", _mean().alias("avg_rating")).orderBy("year")


def ratings_long(gold: DataFrame) -> DataFrame:
    """``genre, rating``, one row per gold row."""
    return gold.select("genre", "rating")


def rating_histogram(gold: DataFrame) -> DataFrame:
    """``genre, rating, num_rows``: what a distribution chart needs of the long table."""
    return gold.groupBy("genre", "rating").agg(F.count("*").alias("num_rows"))


def rating_histogram_of_films(films_by_rating: DataFrame) -> DataFrame:
    """The same from totals per film and rating value."""
    return silver.unfold_genres(films_by_rating).groupBy("genre", "rating").agg(F.sum(_ROWS).alias("num_rows"))


def rating_sketches(movies: DataFrame, ratings: DataFrame, drop_nulls: bool = True, k: int = QUANTILE_K) -> DataFrame:
    """``movieId, sketch`` with year and genres of the film: a KLL sketch of each film's ratings.

    For scales too fine to count every value. A sketch has a bounded size, so a film with very many ratings is no larger
    than another; a task sends one per film. Sketches of batches or films merge.
    """
    rating_rows = silver.complete_ratings(ratings) if drop_nulls else silver.ratings_silver(ratings)
    film_rows = silver.complete_films(movies) if drop_nulls else silver.films(movies)
    sketches = rating_rows.groupBy("movieId").agg(F.kll_sketch_agg_float("rating", F.lit(k)).alias("sketch"))
    return sketches.join(film_rows, "movieId", "inner")


def rating_quantiles(films: DataFrame, shares: Sequence[float], k: int = QUANTILE_K) -> DataFrame:
    """``genre, share, rating``: per genre the rating below which about that share of its gold rows lies.

    The rank of the result is off by at most ``quantile_error(k)`` of all rows, with 99 % confidence.
    """
    genres = silver.unfold_genres(films).groupBy("genre").agg(F.kll_merge_agg_float("sketch", F.lit(k)).alias("sketch"))
    each = [
        F.struct(F.lit(float(share)).alias("share"), F.kll_sketch_get_quantile_float("sketch", F.lit(float(share))).alias("rating"))
        for share in shares
    ]
    return genres.select("genre", F.inline(F.array(*each)))


def quantile_error(k: int = QUANTILE_K) -> float:
    """The published fit of a KLL sketch's normalised rank error."""
    return 2.296 / k**0.9021


def _mean() -> Column:
    return ratio(F.col(_SUM), F.col(_RATED))
