"""Typed sources, the partitioned gold table, and SQL views."""

from starledger.sources import stand_ins
from starledger.sources.by_film import read_by_film, store_by_film
from starledger.sources.csv import MOVIES_FILE, RATINGS_FILE, corrupt_report, read_csv, read_movies, read_ratings, write_csv
from starledger.sources.gold_table import read_gold, replace_gold, write_gold
from starledger.sources.schemas import GOLD_CLEAN_SCHEMA, GOLD_RAW_SCHEMA, MOVIES_SCHEMA, RATINGS_SCHEMA
from starledger.sources.views import MOVIES_VIEW, RATINGS_VIEW, register_views

__all__ = [
    "GOLD_CLEAN_SCHEMA",
    "GOLD_RAW_SCHEMA",
    "MOVIES_FILE",
    "MOVIES_SCHEMA",
    "MOVIES_VIEW",
    "RATINGS_FILE",
    "RATINGS_SCHEMA",
    "RATINGS_VIEW",
    "read_by_film",
    "read_csv",
    "read_gold",
    "read_movies",
    "read_ratings",
    "corrupt_report",
    "register_views",
    "replace_gold",
    "stand_ins",
    "store_by_film",
    "write_csv",
    "write_gold",
]
