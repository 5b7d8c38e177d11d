"""Ranked lexical search with norm buckets.

A document is a vector with one coordinate per term that any query asks for; a coordinate is the term's impact, its
weight times its damped frequency, in integers. A query is the vector with 1 at its terms, so their product is the score.
Vectors are ordered by length and taken in buckets, longest first. While a query's best k so far reach down to some
score, three tests spare work:

- Cauchy-Schwarz, per bucket: no product exceeds the query's length times that of the bucket's longest vector.
- Coordinate bounds, inside a bucket: a few coordinates of the query are added up as they are; the rest of the product is
  at most the rest of the two lengths multiplied, and at most the bucket's greatest values of the other coordinates.
- What survives is scored from all its coordinates, exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import per_batch, ship, written
from starledger.operators.joins import measured_bytes, split_join

TOP = 50
# Bytes of query texts that are searched for at once; more are searched in blocks, each against all documents.
QUERY_BYTES = 8 << 20
# Rows of a bucket at most, and cells of the matrix that a task holds for it.
BUCKET_ROWS, BUCKET_CELLS = 512, 4_000_000
# Coordinates of a query that are added up before anything else.
FOCUS = 8
# The longest vectors, about so many, give every query a first lower bound.
FIRST_BUCKET = 4_096
ROWS_PER_TASK = 200_000
# Lengths are rounded; bounds are widened by this share, so that rounding prunes nothing.
SLACK = 1 + 1e-9

# Bytes that part terms; upper case becomes lower case.
_PARTS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if b in _PARTS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Letters and digits of ASCII and everything beyond, in runs; only A-Z are lower-cased."""
    return text.encode().translate(_TABLE).split() if text else []


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for every row of ``items`` the ``top`` rows of ``docs`` with the highest scores.

    Only scores above 0 count. Equal scores go by ascending ``doc_id``, a null id last; repeated rows have a rank each.
    Null and empty texts have no terms: such items have no rows, such documents are found by nobody and count nowhere.
    Items with equal texts are searched for once. Other columns play no part, whatever their names.

    Items are searched for in blocks of about ``query_bytes``; a block's terms go to every task, and its terms' numbers
    of documents and its lower bounds pass the driver. Documents are never collected.
    """
    spark = docs.sparkSession
    ship(spark)
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    asked = written(asked.filter(F.col("text").isNotNull()).withColumn("key", F.sha2(F.col("text").cast("binary"), 256)), "search-items")
    texts = asked.groupBy("key").agg(F.first("text").alias("text"))
    blocks = max(1, -(-measured_bytes(texts) // query_bytes))
    number = F.pmod(F.xxhash64("key"), F.lit(blocks))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    results = []
    for block in range(blocks):
        queries = [(r["key"], terms_of(r["text"])) for r in texts.filter(number == block).collect()]
        results.append(_search_block(rows, sorted(q for q in queries if q[1]), top))
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    return split_join(asked.select("item_id", "key"), found, "key").select("item_id", "rank", "doc_id", "score")


def _search_block(rows: DataFrame, queries: list[tuple[str, list[bytes]]], top: int) -> DataFrame:
    spark = rows.sparkSession
    numbers: dict[bytes, int] = {}
    asked = [np.array(sorted({numbers.setdefault(t, len(numbers)) for t in terms}), dtype=np.int64) for _, terms in queries]
    vocabulary = spark.sparkContext.broadcast(numbers)
    postings = written(_postings(rows, vocabulary), "search-postings")
    docs, words = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(numbers), dtype=np.int64)
    for term, count in _document_counts(postings, len(numbers)).collect():
        holding[term] = count
    weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in holding], dtype=np.int64)

    vectors = written(_vectors(postings, weights, docs, words), "search-vectors")
    task = spark.sparkContext.broadcast((asked, len(numbers), top))
    share = min(1.0, FIRST_BUCKET / max(1, docs))
    cut = vectors.agg(F.percentile_approx("norm", 1 - share)).first()[0] or 0.0
    first = _best(_scored(vectors.filter(F.col("norm") >= cut), task, None), top)
    bounds = np.zeros(len(asked), dtype=np.int64)
    lowest = first.groupBy("item").agg(F.min("score").alias("score"), F.count("*").alias("found"))
    for item, score in lowest.filter(F.col("found") == top).select("item", "score").collect():
        bounds[item] = score
    known = spark.sparkContext.broadcast(bounds)

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs // ROWS_PER_TASK))
    # Vectors of equal length are told apart by their salt, so no task gets more than its share of them.
    by_length = vectors.repartitionByRange(tasks, F.desc("norm"), "salt").sortWithinPartitions(F.desc("norm"), "salt")
    best = _best(_scored(by_length, task, known), top)
    names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(queries)], "item int, key string")
    return best.join(F.broadcast(names), "item").select("key", "rank", "doc_id", "score")  # bounded by query_bytes


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _postings(rows: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, salt, n, terms, counts``: a document's number of terms, and those that are asked for."""
    seen: dict[int, int] = {}

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        numbers, task = vocabulary.value, TaskContext.get().partitionId()
        start = seen.get(task, 0)
        seen[task] = start + batch.num_rows
        n, terms, counts = [], [], []
        for value in batch.column("text"):
            words = terms_of(value.as_py())
            held = [(numbers[t], c) for t, c in Counter(words).items() if t in numbers]
            n.append(len(words))
            pairs = np.array(sorted(held), dtype=np.int64).reshape(-1, 2)
            terms.append(pairs[:, 0].astype("<i4").tobytes())
            counts.append(pairs[:, 1].astype("<i8").tobytes())
        # Scrambled, so that documents which follow one another don't meet again.
        salt = [((task << 32) + i) * 0x9E3779B97F4A7C15 % (1 << 63) for i in range(start, start + batch.num_rows)]
        yield {"doc_id": batch.column("doc_id"), "salt": salt, "n": n, "terms": terms, "counts": counts}

    fields = "doc_id $doc_id, salt bigint, n bigint, terms binary, counts binary"
    return per_batch(rows, {"doc_id": "doc_id", "text": "text"}, fields, run)


def _document_counts(postings: DataFrame, width: int) -> DataFrame:
    """``term, count``: in how many documents each term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4"), minlength=width)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["term", "count"])

    partial = postings.select("terms").mapInArrow(run, "term int, count bigint")
    return partial.groupBy("term").agg(F.sum("count").alias("count"))


def _vectors(postings: DataFrame, weights: np.ndarray, docs: int, words: int) -> DataFrame:
    """``doc_id, salt, norm, terms, impacts`` of documents that hold any term asked for."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        norms, impacts = [], []
        for n, terms, counts in zip(*(batch.column(c).to_pylist() for c in ("n", "terms", "counts")), strict=True):
            m = 100 - 50 + (50 * n * docs) // words  # Python's integers have no bound
            tf = np.frombuffer(counts, "<i8")
            impact = weights[np.frombuffer(terms, "<i4")] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            norms.append(math.sqrt(float(np.square(impact.astype(np.float64)).sum())))
            impacts.append(impact.astype("<i8").tobytes())
        yield {"norm": norms, "impacts": impacts} | {c: batch.column(c) for c in ("doc_id", "salt", "terms")}

    columns = {c: c for c in ("doc_id", "salt", "n", "terms", "counts")}
    fields = "doc_id $doc_id, salt bigint, norm double, terms binary, impacts binary"
    return per_batch(postings.filter(F.octet_length("terms") > 0), columns, fields, run)


def _scored(vectors: DataFrame, task, known) -> DataFrame:
    """``item, doc_id, score``: for every query the best of each task."""
    columns = ["doc_id", "norm", "terms", "impacts"]
    schema = f"item int, doc_id {vectors.schema['doc_id'].dataType.simpleString()}, score bigint"
    id_type = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, width, top = task.value
        bounds = known.value if known is not None else np.zeros(len(queries), dtype=np.int64)
        rows = max(16, min(BUCKET_ROWS, BUCKET_CELLS // max(1, width)))
        found = _Best(queries, bounds.copy(), top)
        for batch in batches:
            id_type["doc_id"] = batch.schema.field("doc_id").type
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found.add(_Bucket(part, width))
        for i, best in enumerate(found.best):
            if best:
                scores, docs = [-s for s, _, _ in best], [d for _, _, d in best]
                arrays = [pa.array([i] * len(best), pa.int32()), pa.array(docs, id_type["doc_id"]), pa.array(scores, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return vectors.select(columns).mapInArrow(run, schema)


class _Bucket:
    """Vectors of similar length; ``cells[term, vector]`` are their impacts."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.ids = batch.column("doc_id")
        self.norms = batch.column("norm").to_numpy()
        self.longest = float(self.norms.max())
        terms = [np.frombuffer(t, "<i4") for t in batch.column("terms").to_pylist()]
        self.cells = np.zeros((width, len(terms)), dtype=np.int64)
        columns = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        self.cells[np.concatenate(terms), columns] = np.frombuffer(b"".join(batch.column("impacts").to_pylist()), "<i8")
        self.highest = self.cells.max(axis=1)


class _Best:
    """Per query its best documents so far, as (-score, no id, id), and the score that another one has to reach."""

    def __init__(self, queries: list[np.ndarray], bounds: np.ndarray, top: int):
        self.queries, self.bounds, self.top = queries, bounds, top
        self.lengths = np.sqrt([float(len(q)) for q in queries])
        self.best: list[list[tuple]] = [[] for _ in queries]

    def add(self, bucket: _Bucket) -> None:
        within_reach = self.lengths * bucket.longest * SLACK >= self.bounds
        for i in np.flatnonzero(within_reach):
            self._add(int(i), bucket)

    def _add(self, i: int, bucket: _Bucket) -> None:
        terms, bound = self.queries[i], max(1, int(self.bounds[i]))
        highest = bucket.highest[terms]
        if highest.sum() < bound:
            return
        order = np.argsort(-highest, kind="stable")
        focus, others = terms[order[:FOCUS]], order[FOCUS:]
        values = bucket.cells[focus]
        sure = values.sum(axis=0)
        rest = np.sqrt(np.maximum(0.0, np.square(bucket.norms) * SLACK - np.square(values.astype(np.float64)).sum(axis=0)))
        most = sure + np.minimum(rest * math.sqrt(len(others)) * SLACK, float(highest[others].sum()))
        alive = np.flatnonzero(most >= bound)
        if not len(alive):
            return
        scores = bucket.cells[np.ix_(terms, alive)].sum(axis=0)
        reached = np.flatnonzero(scores >= bound)
        if not len(reached):
            return
        if len(reached) > self.top:  # ties with the last one stay
            least = np.partition(scores[reached], len(reached) - self.top)[len(reached) - self.top]
            reached = reached[scores[reached] >= least]
        ids = bucket.ids.take(pa.array(alive[reached])).to_pylist()
        new = [(-int(s), d is None, d) for s, d in zip(scores[reached], ids, strict=True)]
        merged = sorted(self.best[i] + new, key=_order)[: self.top]
        self.best[i] = merged
        if len(merged) == self.top:
            self.bounds[i] = max(self.bounds[i], -merged[-1][0])


def _order(entry: tuple) -> tuple:
    """A null id comes last and is compared with no other."""
    score, missing, doc = entry
    return (score, missing) if missing else (score, missing, doc)
