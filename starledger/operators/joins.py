"""Inner join of a very large table with a smaller one on a key that may be very unevenly used.

A caller measures the smaller side first. Up to ``BROADCAST_LIMIT`` it is broadcast and the large side is not shuffled
at all; beyond that ``split_join`` shuffles both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from starledger.session import shared_folder

# A side measured up to this many bytes is broadcast.
BROADCAST_LIMIT = 64 << 20
# A list of hot keys measured up to this many bytes is broadcast. It is in the driver several times over while it is sent
# (collected, hashed, serialised), and every key on it has more rows than a split, so few lists are longer.
HOT_LIMIT = 8 << 20
# Rows of one key that one join task takes.
ROWS_PER_SPLIT = 2_000_000
# Types whose values may be of any size and can't be looked into.
UNBOUNDED_TYPES = {"VariantType", "PythonOnlyUDT", "GeometryType", "GeographyType"}

# Bits of the filter that marks the keys of a join's smaller side: 16 MB in all.
FILTER_BITS = 1 << 27

_SPLITS, _SPLIT, _HOT_KEY, _ROWS, _SALT, _HOT_SALT = "__splits", "__split", "__hot_key", "__rows", "__salt", "__hot_salt"
_PART = "__part"


def _value_bytes(column: Column, data_type: DataType) -> Column:
    if isinstance(data_type, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(data_type, ArrayType):
        return F.coalesce(
            F.aggregate(column, F.lit(0), lambda total, item: total + _value_bytes(item, data_type.elementType)), F.lit(0)
        ) + 32
    if isinstance(data_type, MapType):
        keys, values = ArrayType(data_type.keyType), ArrayType(data_type.valueType)
        return _value_bytes(F.map_keys(column), keys) + _value_bytes(F.map_values(column), values)
    if isinstance(data_type, StructType):
        return sum((_value_bytes(column.getField(f.name), f.dataType) for f in data_type.fields), F.lit(16))
    if type(data_type).__name__ in UNBOUNDED_TYPES:
        raise TypeError(f"the size of a {data_type.simpleString()} value has no bound here")
    return F.lit(16)


def measured_bytes(df: DataFrame) -> int:
    """An upper estimate of what the rows of ``df`` take in memory, counted by one distributed aggregate."""
    row_bytes = F.lit(16)
    for field in df.schema.fields:
        row_bytes = row_bytes + _value_bytes(F.col(field.name), field.dataType)
    return df.agg(F.coalesce(F.sum(row_bytes.cast("bigint")), F.lit(0))).first()[0]


def may_match(large: DataFrame, small: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``large`` whose key may occur in ``small``: all that do, and of the others about one in
    ``bits / keys``. For use before a shuffle.

    It is a Bloom filter with one hash. The bits of all keys are set by a distributed aggregate, in bitmaps of 32,768
    bits; only bitmaps with a bit set are broadcast, never more than ``bits / 8`` bytes, whatever ``small`` holds.
    """
    place, bucket, bitmap = "__place", "__bucket", "__bitmap"

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn(place, F.pmod(F.xxhash64(F.col(key)), F.lit(bits)) + 1)

    marks = placed(small.filter(F.col(key).isNotNull()).select(key)).groupBy(
        F.bitmap_bucket_number(place).alias(bucket)
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bitmap))
    asked = placed(large.filter(F.col(key).isNotNull())).withColumn(bucket, F.bitmap_bucket_number(place))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = asked.join(F.broadcast(marks), bucket).filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
    return found.drop(place, bucket, bitmap)


def split_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    rows_per_split: int = ROWS_PER_SPLIT,
    broadcast_limit: int = HOT_LIMIT,
    counts: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Shuffled inner join in which no task gets much more than ``rows_per_split`` rows of one key.

    A first pass over the key column counts rows per key; it runs when this is called. ``counts``, the key and a number
    of rows, saves that pass where it is known; a key it lacks isn't split. A key above the bound is hot: it
    gets one split per ``rows_per_split`` rows, its rows are dealt to the splits, and its matches in ``small`` are
    repeated once per split. All other keys are joined as usual. Every row meets each of its matches exactly once.

    The list of hot keys is written to the shared folder and measured. Up to ``broadcast_limit`` bytes it is broadcast.
    Beyond, the split counts reach ``large`` by a join on the key and a salt, so a key of more than ``ROWS_PER_SPLIT`` rows
    is spread there as well, and nothing is broadcast.

    The split of a row follows from its content and the number of its input partition. Rows that differ part by content,
    equal rows by partition, and one partition is small. Neither depends on the order of rows, so a task that is repeated
    after a loss deals the same rows to the same splits.

    Where no key is hot, ``tasks`` tasks share the join; without it AQE sizes them by the bytes that are shuffled.

    Once there are hot keys, sides that were not measured are merged whatever their estimated size: from a well compressed
    file Spark would expect little, and send ``small``, repeated per split, through the driver.
    """
    spark = large.sparkSession
    large = large.filter(F.col(key).isNotNull())
    small = small.filter(F.col(key).isNotNull())

    if counts is None:
        counts = large.groupBy(key).agg(F.count("*").alias(_ROWS))
    else:
        counts = counts.toDF(key, _ROWS)
    found = counts.filter(F.col(_ROWS) > rows_per_split).select(
        F.col(key).alias(_HOT_KEY), F.ceil(F.col(_ROWS) / rows_per_split).cast("int").alias(_SPLITS)
    )
    folder = shared_folder(spark, "hot-keys")
    found.write.parquet(folder)
    hot = spark.read.schema(found.schema).parquet(folder)
    most = hot.agg(F.max(_SPLITS)).first()[0]
    if most is None:
        return (large.repartition(tasks, key) if tasks else large).join(small, key, "inner")

    content = [F.col(c) for c in large.columns]
    large = large.withColumn(_PART, F.spark_partition_id())  # before a shuffle puts equal rows into one
    on_key = F.col(key) == F.col(_HOT_KEY)
    few = measured_bytes(hot) <= broadcast_limit
    if few:
        marked = large.join(F.broadcast(hot), on_key, "left")
    else:
        # As many as the hottest key needs, not one per split: the list is repeated once per salt.
        needed = -(-most * rows_per_split // ROWS_PER_SPLIT)
        salts = min(needed, max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        spread = hot.withColumn(_HOT_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        # A different hash than the one that picks the split: the two are independent.
        salted = large.withColumn(_SALT, F.pmod(F.hash(*content) + F.col(_PART), F.lit(salts)))
        on_salt = on_key & (F.col(_SALT) == F.col(_HOT_SALT))
        marked = salted.join(spread.hint("merge"), on_salt, "left").drop(_SALT, _HOT_SALT)
    turn = (F.pmod(F.xxhash64(*content) + F.col(_PART), F.col(_SPLITS).cast("bigint"))).cast("int")
    dealt = marked.withColumn(_SPLIT, F.coalesce(turn, F.lit(0))).drop(_HOT_KEY, _SPLITS, _PART)
    last = F.coalesce(F.col(_SPLITS), F.lit(1)) - 1
    repeated = (
        small.join(F.broadcast(hot) if few else hot.hint("merge"), on_key, "left")
        .withColumn(_SPLIT, F.explode(F.sequence(F.lit(0), last)))
        .drop(_HOT_KEY, _SPLITS)
    )
    joined = dealt.join(repeated.hint("merge"), [key, _SPLIT], "inner")
    return joined.drop(_SPLIT)
