"""The pipe-separated genre field."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator (as a regular expression) and the text that stands for "no genre".
GENRE_SEPARATOR = r"\|"
NO_GENRES = "(no genres listed)"


def real_genre(genre: Column) -> Column:
    """NULL in place of the marker text."""
    return F.nullif(genre, F.lit(NO_GENRES))


def genre_list(genres: Column) -> Column:
    """The genres as an array in their written order, the marker text still among them.

    A NULL field gives a NULL array (no rows when unfolded), an empty text one empty genre.
    """
    return F.split(genres, GENRE_SEPARATOR)


def real_genres(genre_list: Column) -> Column:
    """The array without the marker text."""
    return F.array_remove(genre_list, NO_GENRES)
