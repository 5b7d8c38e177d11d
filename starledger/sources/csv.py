"""CSV with a header and a stated schema, so no pass over the data is spent on inferring types.

Records lie on one line each, which keeps large files splittable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starledger.sources.schemas import MOVIES_SCHEMA, RATINGS_SCHEMA

# File names below the base path.
MOVIES_FILE = "movies.csv"
RATINGS_FILE = "ratings.csv"

QUOTE = '"'
# Stands for an empty field while a file is parsed, so that an empty text in quotes stays one.
NO_TEXT = "\x01"


def read_csv(
    spark: SparkSession, path: str, schema: StructType, doubled_quotes: bool = True, corrupt_column: str | None = None
) -> DataFrame:
    """Scan a CSV file or folder.

    ``doubled_quotes`` reads ``""`` inside a quoted field as one quote mark. With ``False`` Spark's default escape is in
    force: a field with a quote and a comma then breaks apart, and part of the title ends up in the genres.
    A value that does not fit its type becomes NULL, a short row is filled with NULL, surplus fields are ignored. With
    ``corrupt_column`` such a record's line is kept in a column of that name, NULL for sound records; ``corrupt_report``
    counts them. An empty field is NULL, an empty text in quotes is an empty text.
    """
    reader = spark.read.option("header", True).option("nullValue", NO_TEXT).option("emptyValue", "")
    if doubled_quotes:
        reader = reader.option("escape", QUOTE)
    if corrupt_column is not None:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def corrupt_report(df: DataFrame, corrupt_column: str) -> DataFrame:
    """One row: records in all, and those that did not fit the schema."""
    # All columns are read: with the corrupt column alone Spark would parse none, and find nothing wrong.
    read = df.select(F.struct(*df.columns).alias("record"), F.col(corrupt_column).isNotNull().alias("bad"))
    return read.agg(
        F.count("record").alias("total_records"), F.count(F.when(F.col("bad"), F.col("record"))).alias("corrupt_records")
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Write a CSV folder, in place of what is there, that ``read_csv`` reads back unchanged.

    A record lies on one line, so a text with a line break can't be written and makes the write fail.
    """

    def one_line(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, StringType):
            return column
        broken = F.raise_error(F.lit(f"a value of {field.name} holds a line break")).cast("string")
        return F.when(column.rlike("[\\r\\n]"), broken).otherwise(column).alias(field.name)

    lines = df.select(*[one_line(f) for f in df.schema.fields])
    writer = lines.write.mode("overwrite").option("header", True).option("escape", QUOTE)
    # Blanks at the ends of a text stay; an empty text is two quote marks, NULL is nothing at all.
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("emptyValue", QUOTE + QUOTE).option("nullValue", "").csv(path)


def _below(base_path: str, name: str) -> str:
    return f"{base_path.rstrip('/')}/{name}"


def read_movies(
    spark: SparkSession,
    base_path: str,
    file_name: str = MOVIES_FILE,
    doubled_quotes: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    return read_csv(spark, _below(base_path, file_name), MOVIES_SCHEMA, doubled_quotes, corrupt_column)


def read_ratings(
    spark: SparkSession, base_path: str, file_name: str = RATINGS_FILE, corrupt_column: str | None = None
) -> DataFrame:
    return read_csv(spark, _below(base_path, file_name), RATINGS_SCHEMA, corrupt_column=corrupt_column)
