"""Numbers, times and missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def valid_rating(rating: Column) -> Column:
    """The rating if it is above zero, else NULL; NaN stays, because Spark orders it above every number."""
    return F.when(rating > 0, rating)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a timestamp.

    Goes by the number, not by a local-time text, so the two passes of an hour at the autumn clock change stay apart.
    """
    return F.timestamp_seconds(seconds)


def is_present(column: Column, data_type: DataType) -> Column:
    """Neither NULL nor NaN."""
    if isinstance(data_type, (FloatType, DoubleType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL for an empty or missing whole."""
    return F.try_divide(part, whole)


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, unrounded."""
    return ratio(part, whole) * 100
