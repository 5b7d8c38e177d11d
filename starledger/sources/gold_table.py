"""The stored gold table, one folder per year.

The format is a parameter: ``parquet`` by default, ``delta`` where its connector is on the class path. Atomic
replacement and versions come with the latter only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starledger.sources.schemas import GOLD_CLEAN_SCHEMA, GOLD_RAW_SCHEMA

PARTITION_COLUMN = "year"
# The file that names the table's folder, where it was written by ``replace_gold``.
CURRENT = "CURRENT"


def gather(df: DataFrame, partition_by: str = PARTITION_COLUMN) -> DataFrame:
    """Bring the rows of a year together for the write.

    The hint keeps the number of files near the number of years, and lets AQE deal a year that is much larger than the
    rest over several tasks and files, by its measured size. Without AQE a year would be one task, however large, so it
    must be on.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("set spark.sql.adaptive.enabled: a large year is split by it")
    return df.hint("rebalance", partition_by)


def write_gold(
    gold: DataFrame,
    path: str,
    file_format: str = "parquet",
    partition_by: str = PARTITION_COLUMN,
    gathered: bool = False,
) -> None:
    """Replace the table at ``path``, its schema included; ``gold`` must not read from ``path``.

    ``gathered`` says that the rows of a year already lie together, as ``plans.store_gold`` has them.
    """
    rows = gold if gathered else gather(gold, partition_by)
    (
        rows.write.format(file_format)
        .mode("overwrite")
        .option("overwriteSchema", "true")
        .option("partitionOverwriteMode", "static")  # whatever the session says: years that are gone must go
        .partitionBy(partition_by)
        .save(path)
    )


def replace_gold(gold: DataFrame, path: str, partition_by: str = PARTITION_COLUMN, gathered: bool = False) -> None:
    """Replace the table at ``path`` so that readers see the old one or the new one, and a failed job leaves the old one.

    The new table is written beside the old one. Then a small file, which ``read_gold`` follows, is put in the place of
    the one before in a single rename, and what it no longer names is deleted. There is one table at a time, no history;
    of two writers at once the later one stays. ``gold`` may read from ``path``.
    """
    spark, name = gold.sparkSession, f"table-{uuid.uuid4().hex}"
    write_gold(gold, f"{path.rstrip('/')}/{name}", partition_by=partition_by, gathered=gathered)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs_path(path).toUri(), conf)
    fresh = fs_path(f"{path.rstrip('/')}/{CURRENT}-{name}")
    folder = fs_path(path).getFileSystem(conf)
    stream = folder.create(fresh, True)
    stream.write(bytearray(name.encode()))
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, fs_path(f"{path.rstrip('/')}/{CURRENT}"), overwrite)
    for status in folder.listStatus(fs_path(path)):
        old = status.getPath().getName()
        if old.startswith("table-") and old != name:
            folder.delete(status.getPath(), True)


def _current(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's files now."""
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{CURRENT}")
    if not pointer.getFileSystem(spark._jsc.hadoopConfiguration()).exists(pointer):
        return path
    name = spark.read.option("wholetext", True).text(f"{path.rstrip('/')}/{CURRENT}").first()[0]
    return f"{path.rstrip('/')}/{name}"


def read_gold(
    spark: SparkSession, path: str, schema: StructType | None = None, file_format: str = "parquet"
) -> DataFrame:
    """Read the table back in its column order; a filter on year reads only the folders it needs.

    Columns and types are those stored. ``schema`` names the columns to return and fails if one is missing; without it the
    table is taken for a clean or a raw one by the time column it has. Only the type of the partition column is stated,
    so that it is an int whatever its values look like.
    """
    path = _current(spark, path)
    reader = spark.read.format(file_format)
    stored = reader.load(path).schema
    if schema is None:
        schema = GOLD_CLEAN_SCHEMA if "timestamp" in stored.fieldNames() else GOLD_RAW_SCHEMA
    if missing := [c for c in schema.fieldNames() if c not in stored.fieldNames()]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    if file_format != "delta":
        typed = [schema[f.name] if f.name == PARTITION_COLUMN else f for f in stored.fields]
        reader = reader.schema(StructType(typed))
    return reader.load(path).select(schema.fieldNames())
