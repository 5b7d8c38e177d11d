"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words of the benchmark items are cut into windows. The hashes of all windows are broadcast; every window of the same
number of words in a document looks its hash up, and a hit is verified word by word before it counts. Only DataFrame
functions are used.

A benchmark above the broadcast limit is joined by a shuffle instead, in which only positions and hashes of document
windows travel; hits meet the documents again to be verified.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import by_position, let, written
from starledger.operators.joins import BROADCAST_LIMIT, measured_bytes

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What lies between words of lower-cased text, and of text as it is.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A word with what stands before it, or what follows the last word.
PART_ANY_CASE = BREAK_ANY_CASE[:-1] + r"*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|" + BREAK_ANY_CASE + "$"
# Rows that a frequent window's hash is dealt to where the set is too large to broadcast.
SALTS = 16

SPANS = "array<struct<start:int,end:int>>"


def normalised_words(text: Column) -> Column:
    """Words of the text with A-Z in lower case; none for null."""
    found = F.array_remove(F.split(F.translate(text, UPPER, LOWER), BREAK), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, BREAK_ANY_CASE), "")), F.lit(0)).cast("bigint")


def _hash(words: Column, start: Column, length: Column) -> Column:
    return F.xxhash64(F.slice(words, start + 1, length))


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``hash, length, window, items``: each distinct window and the sorted ids, as text, of the items that hold it.

    An item of fewer words than ``window``, but not none, is one window. An item without id gives windows that hit but
    are listed under no item.
    """
    items = benchmark.select(
        F.col(f"`{item_id}`").cast("string").alias("item"), normalised_words(F.col(f"`{text}`")).alias("words")
    ).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    cut = items.select(
        "item", "words", length.alias("length"), F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("start")
    )
    parts = cut.select(
        "item",
        "length",
        _hash(F.col("words"), F.col("start"), F.col("length")).alias("hash"),
        F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ").alias("window"),
    )
    return parts.groupBy("hash", "length", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def contaminated_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``doc_id, text_hash, spans, items``: a row per contaminated document.

    ``spans`` are the maximal runs of hit words, as [start, end) word numbers. The outcome follows from the text alone,
    so rows that repeat an id and a text share one row here; a null id is a key like any other.
    """
    windows = written(item_windows(benchmark, item_id, item_text, window), "benchmark-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most ``window`` numbers
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        normalised_words(F.col(f"`{text}`")).alias("words"),
    )

    def of_length(words: Column, length: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - length)
        hashed = F.transform(
            starts, lambda i: F.struct(F.lit(length).alias("length"), i.alias("start"), _hash(words, i, F.lit(length)).alias("hash"))
        )
        return F.when(F.size(words) >= length, hashed).otherwise(F.array().cast(hashed_type))

    hashed_type = "array<struct<length:int,start:int,hash:bigint>>"
    at = F.array().cast(hashed_type)
    if lengths:
        at = let(F.col("words"), lambda words: F.concat(*[of_length(words, n) for n in lengths]))
    # The array is a column of its own first: the generator is then compiled, and rows of it don't copy the words. The
    # outer form keeps the planner from testing the array beforehand, which would compute it twice.
    placed = rows.withColumn("windows", at).select("doc_id", "text_hash", "words", F.inline_outer("windows"))
    known = windows.withColumnsRenamed({"hash": "known_hash", "length": "known_length"})
    same = F.col("hash") == F.col("known_hash")  # windows of other lengths fail the verification
    own = F.array_join(F.slice("words", F.col("start") + 1, F.col("length")), " ")
    # Each the start of the other: equal, but not an equality that the planner would compute for all rows as a join key.
    verified = own.startswith(F.col("window")) & F.col("window").startswith(own)
    hit = ["doc_id", "text_hash", "start", "length", "items"]
    if measured_bytes(windows) <= broadcast_limit:
        hits = placed.join(F.broadcast(known), same & verified, "inner").select(hit)
    else:
        salted = placed.select("doc_id", "text_hash", "start", "length", "hash", (F.col("start") % SALTS).alias("salt"))
        spread = known.withColumn("known_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.join(spread.hint("merge"), same & (F.col("salt") == F.col("known_salt")), "inner")
        per_doc = met.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "length", "window", "items")).alias("met"))
        again = per_doc.join(
            rows.dropDuplicates(["doc_id", "text_hash"]).withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"}),
            F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")),
        )
        hits = again.select("doc_id", "text_hash", "words", F.inline("met")).filter(verified).select(hit)
    found = hits.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("ranges"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return found.select("doc_id", "text_hash", _merged(F.col("ranges")).alias("spans"), "items")


def _merged(ranges: Column) -> Column:
    """Sorted ranges joined where they overlap or touch."""

    def add(done: Column, x: Column) -> Column:
        joined = F.struct(done.getField("start").alias("start"), F.greatest(done.getField("end"), x.getField("end")).alias("end"), done.getField("closed").alias("closed"))
        opened = F.struct(x.getField("start").alias("start"), x.getField("end").alias("end"), F.concat(done.getField("closed"), F.array(_span(done))).alias("closed"))
        return F.when(x.getField("start") <= done.getField("end"), joined).otherwise(opened)

    first = ranges[0]
    zero = F.struct(first.getField("start").alias("start"), first.getField("end").alias("end"), F.array().cast(SPANS).alias("closed"))
    return F.aggregate(ranges, zero, add, lambda done: F.concat(done.getField("closed"), F.array(_span(done))))


def _span(x: Column) -> Column:
    return F.struct(x.getField("start").alias("start"), x.getField("end").alias("end"))


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A null text has no words and is clean. Options are those of ``contaminated_spans``.
    """
    spans = contaminated_spans(docs, benchmark, doc_id, text, **options)
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s.getField("end") - s.getField("start"))
    found = spans.select(
        F.col("doc_id").alias("hit_id"),
        F.col("text_hash").alias("hit_hash"),
        covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.array_join("items", ",").alias("listed"),
    )
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        _word_count(F.col(f"`{text}`")).alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return rows.join(found, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.sha2(F.coalesce("listed", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``), or with the hit words cut out of their texts
    (``"spans"``), each with what stands between it and the word before. All columns stay; other rows are unchanged. Null
    and empty texts are clean; repeated rows share their fate."""
    cleaned = functools.partial(_decontaminate, benchmark=benchmark, remove=remove, **options)
    return by_position(docs, cleaned, doc_id=doc_id, text=text)


def _decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str, doc_id: str, text: str, **options) -> DataFrame:
    spans = contaminated_spans(docs, benchmark, doc_id, text, **options).select(
        F.col("doc_id").alias("__hit_id"), F.col("text_hash").alias("__hit_hash"), F.col("spans").alias("__spans")
    )
    key, value = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    same = key.eqNullSafe(F.col("__hit_id")) & (F.xxhash64(value) == F.col("__hit_hash"))
    if remove == "documents":
        return docs.join(spans, same, "left_anti")
    if remove != "spans":
        raise ValueError("remove must be 'documents' or 'spans'")
    parts = F.regexp_extract_all(value, F.lit(PART_ANY_CASE), 0)
    kept = let(
        F.col("__spans"),
        lambda spans: F.array_join(
            F.filter(parts, lambda _, i: ~F.exists(spans, lambda s: (i >= s.getField("start")) & (i < s.getField("end")))), ""
        ),
    )
    cleaned = F.when(F.col("__spans").isNull(), value).otherwise(kept)
    return docs.join(spans, same, "left").select(
        *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    )
