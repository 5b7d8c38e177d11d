"""Column functions; each builds on Spark's own functions and stays inside code generation."""

from starledger.functions.genres import NO_GENRES, genre_list, real_genre, real_genres
from starledger.functions.titles import YEAR_PATTERN, release_year
from starledger.functions.values import epoch_to_timestamp, is_present, percent, ratio, valid_rating

__all__ = [
    "NO_GENRES",
    "YEAR_PATTERN",
    "epoch_to_timestamp",
    "genre_list",
    "is_present",
    "percent",
    "ratio",
    "real_genre",
    "real_genres",
    "release_year",
    "valid_rating",
]
