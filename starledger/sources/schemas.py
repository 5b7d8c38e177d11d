"""Column names, types and orders of the stored tables. All columns are nullable."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _schema(columns: dict[str, str]) -> StructType:
    schema = StructType()
    for name, type_name in columns.items():
        schema = schema.add(name, type_name)
    return schema


MOVIES_SCHEMA = _schema({"movieId": "integer", "title": "string", "genres": "string"})
RATINGS_SCHEMA = _schema({"userId": "integer", "movieId": "integer", "rating": "float", "timestamp": "integer"})

# The join key comes first, the partition column keeps its place among the film columns.
GOLD_RAW_SCHEMA = _schema(
    {
        "movieId": "integer",
        "userId": "integer",
        "rating": "float",
        "rating_timestamp": "timestamp",
        "title": "string",
        "year": "integer",
        "genre": "string",
    }
)
GOLD_CLEAN_SCHEMA = _schema(
    {
        "movieId": "integer",
        "userId": "integer",
        "rating": "float",
        "timestamp": "long",
        "title": "string",
        "year": "integer",
        "genre": "string",
    }
)
