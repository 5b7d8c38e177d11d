"""What can be read out of a title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: four digits in round brackets, the first such group in the title.
YEAR_PATTERN = r"\((\d{4})\)"


def release_year(title: Column) -> Column:
    """The first bracketed four-digit year of a title as int, NULL if there is none."""
    digits = F.regexp_extract(title, YEAR_PATTERN, 1)
    return F.nullif(digits, F.lit("")).cast("int")
