"""The textbook distributed difference-cover suffix array, on DataFrames.

Suffixes that start at positions 1 and 2 modulo 3 are sorted by their first three symbols and named by rank; where names
repeat, the sequence of names is sorted by the same method. The others are ordered by their first symbol and the rank of
the suffix after it, and merged. ``repeated_text`` says why it doesn't sort whole corpora this way; this module is the
measure it is held against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import written


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    """Rows in global order with ``id`` (grows with the order) and ``part``, written so that both stay as they are."""
    return written(
        df.orderBy(*order).withColumns({"id": F.monotonically_increasing_id(), "part": F.spark_partition_id()}), "sorted"
    )


def _running(sorted_rows: DataFrame, what: dict[str, Column]) -> DataFrame:
    """For each row how many rows of each kind come before it, by sums within parts and starts of parts."""
    marks = sorted_rows.withColumns({k: c.cast("bigint") for k, c in what.items()})
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = marks.groupBy("part").agg(*[F.sum(k).alias(k) for k in what])  # a row per part
    starts = starts.select("part", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"s_{k}") for k in what])
    inside = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    counted = marks.withColumns({k: F.coalesce(F.sum(k).over(inside), F.lit(0)) for k in what})
    return counted.join(F.broadcast(starts), "part").withColumns({k: F.col(k) + F.col(f"s_{k}") for k in what})


def _ahead(df: DataFrame, value: str, most: int) -> DataFrame:
    """``pos, v0 .. v<most>``: the values at a position and after it, 0 beyond the end."""
    places = F.array(*[F.struct((F.col("pos") - k).alias("pos"), F.lit(k).alias("k"), F.col(value).alias("v")) for k in range(most + 1)])
    spread = df.select(F.inline(places)).filter("pos >= 0")
    return spread.groupBy("pos").agg(
        *[F.coalesce(F.max(F.when(F.col("k") == k, F.col("v"))), F.lit(0)).alias(f"v{k}") for k in range(most + 1)]
    )


def suffix_ranks(symbols: DataFrame, n: int) -> DataFrame:
    """``pos, rank`` (from 1) of all suffixes of the symbols (``pos`` from 0 to ``n - 1``, ``sym`` above 0)."""
    if n < 4:
        rows = sorted((r["pos"], r["sym"]) for r in symbols.collect())
        texts = sorted(([s for _, s in rows[p:]], p) for p, _ in rows)
        return symbols.sparkSession.createDataFrame([(p, i + 1) for i, (_, p) in enumerate(texts)], "pos bigint, rank bigint")
    # A position beyond the end keeps the names of both classes apart where the last triple would be full.
    padded = symbols.select("pos", "sym")
    if n % 3 == 1:
        padded = padded.unionByName(symbols.sparkSession.range(1).select(F.lit(n).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("sym")))
    threes = written(_ahead(padded, "sym", 2), "triples")
    sample = threes.filter(F.col("pos") % 3 != 0)
    names = _numbered(sample.select("v0", "v1", "v2").distinct(), "v0", "v1", "v2").select("v0", "v1", "v2", (F.col("id") + 1).alias("sym"))
    named = written(sample.join(names, ["v0", "v1", "v2"]).select("pos", "sym"), "names")
    ones, total = named.filter(F.col("pos") % 3 == 1).count(), named.count()
    if names.count() == total:
        ranked = named.select("pos", F.col("sym").alias("rank"))
    else:
        place = F.when(F.col("pos") % 3 == 1, F.floor(F.col("pos") / 3)).otherwise(ones + F.floor(F.col("pos") / 3))
        deeper = suffix_ranks(named.select(place.alias("pos"), "sym"), total)
        back = F.when(F.col("pos") < ones, 3 * F.col("pos") + 1).otherwise(3 * (F.col("pos") - ones) + 2)
        ranked = deeper.select(back.alias("pos"), "rank")
    ranked = written(ranked.filter(F.col("pos") < n), "sample-ranks")
    # What each kind of comparison looks at.
    ranks = _ahead(ranked, "rank", 2).withColumnsRenamed({f"v{k}": f"r{k}" for k in range(3)})
    both = threes.filter(F.col("pos") < n).join(ranks, "pos", "left").na.fill(0)
    keyed = written(both.withColumn("kind", F.col("pos") % 3), "merge-keys")
    one = _numbered(keyed.filter("kind <> 2"), "v0", "r1", "kind")
    two = _numbered(keyed.filter("kind <> 1"), "v0", "v1", "r2", "kind")
    order = _running(_numbered(ranked, "rank"), {"sampled": F.lit(1)}).select("pos", "sampled")
    with_ones = _running(one, {"zeros": F.col("kind") == 0, "ones": F.col("kind") == 1})
    with_twos = _running(two, {"zeros": F.col("kind") == 0, "twos": F.col("kind") == 2})
    rest = with_ones.filter("kind = 0").select("pos", "zeros", "ones").join(with_twos.filter("kind = 0").select("pos", "twos"), "pos")
    rest = rest.select("pos", (F.col("zeros") + F.col("ones") + F.col("twos") + 1).alias("rank"))
    moved = with_ones.filter("kind = 1").select("pos", "zeros").unionByName(with_twos.filter("kind = 2").select("pos", "zeros"))
    moved = moved.join(order, "pos").select("pos", (F.col("zeros") + F.col("sampled") + 1).alias("rank"))
    return written(rest.unionByName(moved), "ranks")


def text_symbols(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """``pos, sym``: the bytes of all texts, one after the other, with an end of its own after each. Null counts as empty."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = _numbered(docs.select(value.alias("b"), F.md5(value).alias("key")), "key")
    placed = _running(rows.withColumn("size", F.octet_length("b") + 1), {"number": F.lit(1), "start": F.col("size")})
    codes = F.transform(F.sequence(F.lit(1), F.octet_length("b")), lambda i: F.conv(F.hex(F.substring("b", i, F.lit(1))), 16, 10).cast("bigint"))
    # Ends sort below all bytes and differ from each other.
    count = rows.count()
    codes = F.when(F.octet_length("b") > 0, F.transform(codes, lambda c: c + count + 1)).otherwise(F.array().cast("array<bigint>"))
    every = placed.select("start", F.posexplode(F.concat(codes, F.array(F.col("number") + 1))).alias("at", "sym"))
    symbols = written(every.select((F.col("start") + F.col("at")).alias("pos"), "sym"), "symbols")
    return symbols, symbols.count()
