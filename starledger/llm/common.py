"""What several operators share: tables, written intermediate results, and per-batch helpers for Arrow tasks."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import starledger
from starledger.session import shared_folder

# Texts of one Arrow batch are handled in slices of about this many characters, so that what a task holds beside the
# batch itself doesn't grow with the batch.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, purpose: str, large_rows: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors.

    ``large_rows`` looks at the size of a page after every row. Otherwise that is done after 100, and pages of rows of
    some MB are buffered outside the heap until then.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    writer = df.write
    if large_rows:
        writer = writer.option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1)
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later step reads, and let the driver forget finished shuffles.

    What was derived from them has been written itself, so a lost executor needs none of them.
    """
    for df in tables:
        jvm = df.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tables[0].sparkSession._jvm.System.gc()


def per_batch(
    df: DataFrame, columns: dict[str, str], fields: str, function: Callable[[pa.RecordBatch], Iterator[dict]]
) -> DataFrame:
    """Apply ``function`` to Arrow batches of the selected columns in every task.

    ``columns`` maps names inside the task to columns of ``df``, so other columns and their names play no part.
    ``function`` yields dictionaries of Python lists or Arrow arrays by output column; ``fields`` is their schema in DDL
    form, in which ``$name`` stands for the type of the input column ``name``.
    """
    picked = df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])
    types = {field.name: field.dataType.simpleString() for field in picked.schema.fields}
    fields = re.sub(r"\$(\w+)", lambda m: types[m[1]], fields)
    schema = _nullable(StructType.fromDDL(fields))
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in function(batch):
                yield pa.RecordBatch.from_arrays(
                    [x.cast(f.type) if isinstance(x := out[f.name], pa.Array) else pa.array(x, f.type) for f in arrow], schema=arrow
                )
        _give_back()

    return picked.mapInArrow(run, schema)


def _give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after a task, beside its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def filter_rows(df: DataFrame, columns: dict[str, str], keep: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """The rows of ``df`` for which ``keep`` gives true, all columns unchanged, in one pass.

    ``columns`` maps names inside the task to columns of ``df``; columns of any other name may clash with none of them.
    """
    others = {f"c{i}": c for i, c in enumerate(df.columns)}
    fields = ", ".join(f"{name} ${name}" for name in others)

    def chosen(batch: pa.RecordBatch) -> Iterator[dict]:
        mask = keep(batch)
        yield {name: batch.column(name).filter(mask) for name in others}

    return per_batch(df, columns | others, fields, chosen).toDF(*df.columns)


def by_position(docs: DataFrame, apply: Callable[..., DataFrame], **columns: str) -> DataFrame:
    """``apply`` to ``docs`` with its columns named by their places, and the result named as ``docs`` is.

    ``columns`` are the columns that ``apply`` is told of. No other column's name then clashes with anything, not even one
    that differs from another only in case.
    """
    names = docs.columns
    placed = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return apply(placed, **{role: f"c{names.index(name)}" for role, name in columns.items()}).toDF(*names)


def text_start(text: str, most_bytes: int) -> Column:
    """The text, or the whole characters among its first ``most_bytes`` bytes, except the last."""
    head = F.make_valid_utf8(F.substring(F.col(text).cast("binary"), 1, most_bytes).cast("string"))
    return F.when(F.octet_length(text) <= most_bytes, F.col(text)).otherwise(F.left(head, F.length(head) - 1))


def hash_share(key: str) -> Column:
    """A number from 0 to 1 that follows from the key alone."""
    return F.xxhash64(key) / F.lit(float(1 << 64)) + 0.5


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def _arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def slices(lengths: list[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a list into runs of at most ``most`` in sum (one item may be longer)."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if lengths:
        yield start, len(lengths)


def held_out(doc_id: str | Column) -> Column:
    """Every fifth document by the CRC-32 of its id as text; a null id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of no more than ``rows`` rows in what is run inside the block, for rows that are large."""
    before = spark.conf.get(ARROW_ROWS, None)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_ROWS) if before is None else spark.conf.set(ARROW_ROWS, before)


_SHIPPED: set[str] = set()
ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it wherever they run.

    Texts are long, so Arrow batches get no more than ``BATCH_ROWS`` rows from here on: JVM and Python hold one each.
    """
    context = spark.sparkContext
    if int(spark.conf.get(ARROW_ROWS, "10000")) > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    if context.applicationId in _SHIPPED:
        return
    package = Path(starledger.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "starledger_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, f"{package.name}/{source.relative_to(package)}")
    context.addPyFile(str(archive))  # the driver serves it to the executors
    _SHIPPED.add(context.applicationId)
