"""Removal of long repeated byte strings by sorting sampled suffixes.

Every string of L bytes that starts at two places has to be found, in all documents together, by its bytes alone. As in
difference-cover suffix sorting, only a sample of the suffixes is sorted, chosen so that any two equal strings hold a
sampled suffix at the same distance from their starts; all other suffixes are placed by the few bytes before the next
sampled suffix and its name. Three things differ from the textbook form, and each keeps the outcome exact:

* The cover is chosen by content, not by position modulo 3: a position is sampled if the hash of its eight bytes is least
  in some window of w positions. Equal strings then hold samples at equal distances, as they do under a difference cover,
  at about 2 / (w + 1) of all positions instead of two thirds.
* Nothing beyond L bytes matters, so a name stands for the bytes that all strings around a sample share, and naming ends
  after two levels instead of recursing until names are unique. Suffixes with a name of their own are dropped at once.
* Suffixes are ordered by digests of their bytes: equal neighbours are wanted, and any order brings them together.

The strings that a sample serves form a block. The steps: (1) name every sample by the bytes common to all strings of its
block, keep names that occur twice; (2) name the blocks left by all their bytes inside the text and by where in the block
these begin: where this longer name occurs twice, it does so at two places, and all strings of the block do too; (3) of the others, and of one block of each longer name beside them, split the block and go on
with its parts by (2), down to single strings. What is split lies at the ends of repeated passages, so it stays small.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import by_position, discard, per_batch, slices, written
from starledger.operators.joins import BROADCAST_LIMIT, ROWS_PER_SPLIT, measured_bytes, split_join

LENGTH = 200
GRAM = 8
SLICE_BYTES = 250_000
# Parts that a block is split into.
PARTS = 8
_P = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _window(length: int) -> int:
    """The window w, a power of two: a sample lies at least w - 1 bytes from the start of each string, and every window
    that could select it lies inside."""
    if length < 3 * GRAM:
        raise ValueError(f"strings of at least {3 * GRAM} bytes can be found")
    return 1 << int(np.log2((length - GRAM + 1) // 3))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, ``width`` being a power of two."""
    step = 1
    while step < width:
        x = best(x[:-step], x[step:])
        step *= 2
    return x


class _Bytes:
    """The bytes of several texts, with digests of any of their substrings of at least ``GRAM`` bytes."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join([*texts, bytes(GRAM)]), np.uint8)
        x = self.data.astype(np.uint64)
        for step in (1, 2, 4):
            x = x[:-step] | (x[step:] << np.uint64(8 * step))
        self.grams = _mix(x + np.uint64(1))
        self._sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def samples(self, window: int) -> np.ndarray:
        if len(self.grams) < window:
            return np.empty(0, np.int64)
        least = _sliding(self.grams, window, np.minimum)
        edge = np.zeros(window - 1, np.uint64)
        chosen = _sliding(np.concatenate([edge, least, edge]), window, np.maximum) == self.grams
        return np.flatnonzero(chosen)

    def digests(self, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """A 64-bit polynomial digest of the bytes from begin to end, by the eight-byte strings in them."""
        if which not in self._sums:
            power = np.full(len(self.grams) + 1, _P[which], np.uint64)
            power[0] = 1
            inverse = np.full(len(self.grams) + 1, pow(int(_P[which]), -1, 1 << 64), np.uint64)
            inverse[0] = 1
            sums = np.zeros(len(self.grams) + 1, np.uint64)
            np.cumsum(self.grams * np.cumprod(power)[:-1], out=sums[1:])
            self._sums[which] = sums, np.cumprod(inverse)
        sums, inverse = self._sums[which]
        return _mix((sums[end - GRAM + 1] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def _by_slices(batch: pa.RecordBatch, columns: tuple[str, ...] = ()) -> Iterator[tuple]:
    texts = [t.as_py().encode("utf-8", "surrogatepass") for t in batch.column("text")]
    for a, b in slices([len(t) for t in texts], SLICE_BYTES):
        yield _Bytes(texts[a:b]), batch.column("key").slice(a, b - a), *(batch.column(c).slice(a, b - a) for c in columns)


def _small(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def _joined(large: DataFrame, small: DataFrame, key: str, limit: int) -> DataFrame:
    """Broadcast what is measured to be small; else shuffle, hot keys split."""
    if measured_bytes(small) <= limit:
        return large.join(F.broadcast(small), key)
    return split_join(large, small, key, ROWS_PER_SPLIT)


def repeated_ranges(
    docs: DataFrame, text: str = "text", length: int = LENGTH, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """``key, begins, ends``: for each text with bytes to be removed, the maximal runs of them, as byte offsets.

    ``key`` is the 128-bit digest of the text (``text_key``). A text that several rows hold is removed whole if it is long
    enough. Null texts and texts shorter than ``length`` hold no such string.
    """
    window = _window(length)
    near, far = window - 1, 2 * (window - 1)  # a sample's distance from the start of a string it serves
    rows = docs.select(text_key(text).alias("key"), F.col(f"`{text}`").alias("text")).filter(F.octet_length("text") >= length)
    ids = rows.select("key", F.octet_length("text").alias("size"))
    copies = written(ids.groupBy("key", "size").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("key", "size"), "copied-texts")
    alone = rows.join(_small(copies.select("key"), broadcast_limit), "key", "left_anti")
    one_each = rows.join(_small(copies.select("key"), broadcast_limit), "key", "left_semi").dropDuplicates(["key"])
    copied_texts = written(one_each.select("key", "text"), "copied-once")

    # 1. Names of all samples by the bytes that every string around them shares.
    def sample(batch: pa.RecordBatch) -> Iterator[dict]:
        for data, keys in _by_slices(batch):
            at = data.samples(window)
            of = np.searchsorted(data.starts, at, "right") - 1
            inside = at - data.starts[of]
            fits = (inside >= near) & (inside + length - far <= data.sizes[of])
            at, of, inside = at[fits], of[fits], inside[fits]
            name = data.digests(at - near, at + length - far, 0)
            yield {"key": keys.take(pa.array(of)), "at": pa.array(inside), "name": pa.array(name.view(np.int64))}

    def both(function, columns: dict[str, str], fields: str, *joined: DataFrame) -> DataFrame:
        """Apply to texts that are alone and to one of each that has copies."""
        parts = []
        for source in (alone, copied_texts):
            for other in joined:
                source = source.join(_small(other, broadcast_limit), "key")
            parts.append(per_batch(source, columns, fields, function))
        return parts[0].unionByName(parts[1])

    plain = {"key": "key", "text": "text"}
    samples = written(both(sample, plain, "key binary, at int, name bigint"), "samples")
    again = samples.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("name")
    left = _joined(samples, written(again, "repeated-names"), "name", broadcast_limit)
    by_text = written(_lists(left, "at"), "samples-left")

    first = written(both(_namer(length, far, near, 0, 1), plain | {"at": "at"}, _BLOCKS, by_text), "blocks")
    discard(samples, by_text)
    done, opened = _settle(first, broadcast_limit)
    doubled = [done.select("key", "begin", F.lit(window).alias("width"))]

    # 3. Blocks in parts.
    width = window
    while width > 1:
        part = max(1, width // PARTS)
        listed = written(_lists(opened, "begin"), "opened-blocks")
        discard(opened)
        blocks = written(
            both(_namer(length, 0, 1 - part, width // part, part), plain | {"at": "at"}, _BLOCKS, listed), "blocks"
        )
        discard(listed)
        done, opened = _settle(blocks, broadcast_limit)
        doubled.append(done.select("key", "begin", F.lit(part).alias("width")))
        width = part
    discard(opened)

    every = reduce(DataFrame.unionByName, doubled)
    marks = every.groupBy("key").agg(F.collect_list("begin").alias("at"), F.collect_list("width").alias("width"))
    sizes = written(ids.select("key", "size").dropDuplicates(["key"]), "text-sizes")
    marks = marks.join(sizes, "key").join(_small(copies.select("key"), broadcast_limit), "key", "left_anti")

    def merge(batch: pa.RecordBatch) -> Iterator[dict]:
        ends_by_row, begins_by_row = [], []
        for size, at, widths in zip(*(batch.column(c).to_pylist() for c in ("size", "at", "width")), strict=True):
            at, widths = np.array(at, np.int64), np.array(widths, np.int64)
            # The first and the last byte of the strings of each block.
            begin, end = np.maximum(at, 0), np.minimum(at + widths - 1 + length, size)
            order = np.argsort(begin, kind="stable")
            begin, end = begin[order], np.maximum.accumulate(end[order])
            first = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
            begins_by_row.append(begin[first])
            ends_by_row.append(end[np.append(first[1:], len(end)) - 1])
        yield {"key": batch.column("key"), "begins": begins_by_row, "ends": ends_by_row}

    columns = {c: c for c in ("key", "size", "at", "width")}
    merged = per_batch(marks, columns, "key binary, begins array<int>, ends array<int>", merge)
    copied = copies.select("key", F.array(F.lit(0)).alias("begins"), F.array("size").alias("ends"))
    return written(merged.unionByName(copied), "repeated-ranges")


def _lists(rows: DataFrame, column: str) -> DataFrame:
    """``key, at``: the numbers of each text, four bytes each."""

    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"key": batch.column("key"), "at": [np.array(x, "<i4").tobytes() for x in batch.column("at").to_pylist()]}

    lists = rows.groupBy("key").agg(F.collect_list(column).alias("at"))
    return per_batch(lists, {"key": "key", "at": "at"}, "key binary, at binary", pack)


_BLOCKS = "key binary, begin int, name bigint, longer binary"


def _namer(length: int, before: int, least: int, parts: int, width: int):
    """Names of blocks of strings.

    Listed per text are samples (``parts`` 0), whose blocks begin ``before`` bytes earlier and reach to ``least`` bytes
    before them; or beginnings of blocks, to be cut into ``parts`` blocks of ``width`` strings. A block of which no string
    lies inside the text is left out; of one that reaches over its ends, the longer name takes what is inside and how many
    bytes are missing before it. So blocks of one text that reach over both its ends, and hold the same bytes of the same
    place, don't share a longer name, and in those that share one each string has the same distance from the beginning.
    """

    def name(batch: pa.RecordBatch) -> Iterator[dict]:
        for data, keys, listed in _by_slices(batch, ("at",)):
            lists = listed.to_pylist()
            of = np.repeat(np.arange(len(lists)), [len(x) // 4 for x in lists])
            begin = np.frombuffer(b"".join(lists), "<i4").astype(np.int64) - before
            wide = before - least + 1 if not parts else width
            if parts:
                begin = (begin[:, None] + width * np.arange(parts)).ravel()
                of = np.repeat(of, parts)
            fits = (begin + wide - 1 >= 0) & (begin + length <= data.sizes[of])
            begin, of = begin[fits], of[fits]
            if parts:  # a part may belong to several blocks
                row = np.unique(np.column_stack([of, begin]), axis=0)
                of, begin = row[:, 0], row[:, 1]
            at = begin + data.starts[of]
            common = data.digests(at + wide - 1, at + length, 0)
            first = np.maximum(at, data.starts[of])
            last = np.minimum(at + wide - 1 + length, data.starts[of] + data.sizes[of])
            missing = (first - at).astype(np.uint64)
            longer = [data.digests(first, last, k) ^ _mix(missing * _P[k]) for k in (0, 1)]
            yield {
                "key": keys.take(pa.array(of)),
                "begin": pa.array(begin),
                "name": pa.array(common.view(np.int64)),
                "longer": _binary(np.column_stack(longer)),
            }

    return name


def _settle(blocks: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """``key, begin`` of the blocks whose longer name occurs twice, and of those to be split.

    To be split are blocks with a longer name of their own whose name others share, and, for them to meet, one block of
    each longer name under such a name.
    """
    classes = blocks.groupBy("name", "longer").agg(F.count("*").alias("n"), F.min(F.struct("key", "begin")).alias("first"))
    classes = written(classes, "name-classes")
    spread = classes.groupBy("name").agg(F.min("longer").alias("least"), F.max("longer").alias("most"))
    mixed = written(spread.filter(F.col("least") != F.col("most")).select("name"), "mixed-names")
    opened = written(_joined(classes, mixed, "name", limit).select("first.*"), "split-blocks")
    full = written(classes.filter(F.col("n") > 1).select("longer").distinct(), "full-names")
    done = written(_joined(blocks.select("key", "begin", "longer"), full, "longer", limit).select("key", "begin"), "doubled-blocks")
    discard(blocks, classes, mixed, full)
    return done, opened


def _binary(numbers: np.ndarray) -> pa.Array:
    """Each row of 64-bit numbers as one binary value."""
    width, data = 8 * numbers.shape[1], pa.py_buffer(np.ascontiguousarray(numbers).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(numbers), [None, data]).cast(pa.binary())


def text_key(text: str):
    return F.unhex(F.md5(F.col(f"`{text}`").cast("binary")))


def _with_ranges(docs: DataFrame, text: str, length: int, limit: int) -> DataFrame:
    ranges = repeated_ranges(docs, text, length, limit)
    keyed = docs.withColumn("__key", text_key(text))
    named = ranges.select(F.col("key").alias("__key"), F.col("begins").alias("__begins"), F.col("ends").alias("__ends"))
    if measured_bytes(named) <= limit:
        return keyed.join(F.broadcast(named), "__key", "left")
    nothing = keyed.join(named.select("__key"), "__key", "left_anti")
    empty = F.lit(None).cast("array<int>")
    return split_join(keyed, named, "__key").unionByName(nothing.withColumns({"__begins": empty, "__ends": empty}))


def _cut(text: bytes, begins: list[int] | None, ends: list[int] | None) -> bytes:
    kept, at = [], 0
    for begin, end in zip(begins or [], ends or [], strict=True):
        kept.append(text[at:begin])
        at = end
    return b"".join([*kept, text[at:]])


def report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    Removed is every byte of a string of ``length`` bytes that starts at another place too, in the same text or another;
    overlapping places count. Null counts as empty. Rows with equal texts, repeated rows included, are copies of each
    other.
    """
    rows = _with_ranges(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "text", length, broadcast_limit)

    def digest(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for value, begins, ends in zip(*(batch.column(c) for c in ("text", "begins", "ends")), strict=True):
            whole, begins = (value.as_py() or "").encode("utf-8", "surrogatepass"), begins.as_py()
            kept = _cut(whole, begins, ends.as_py())
            out["n_bytes"].append(len(whole))
            out["n_removed"].append(len(whole) - len(kept))
            out["n_spans"].append(len(begins or []))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        yield {"doc_id": batch.column("doc_id")} | out

    columns = {"doc_id": "doc_id", "text": "text", "begins": "__begins", "ends": "__ends"}
    fields = "doc_id $doc_id, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return per_batch(rows, columns, fields, digest)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``docs`` with repeated bytes cut out of the texts; all columns stay, and so do rows whose text becomes empty.

    A cut may fall inside a character; the bytes of it that are left go too, so that the text stays valid. Null texts stay
    null, and repeated rows are copies of each other.
    """
    return by_position(docs, functools.partial(_remove_repeats, length=length, broadcast_limit=broadcast_limit), text=text)


def _remove_repeats(docs: DataFrame, text: str, length: int, broadcast_limit: int) -> DataFrame:
    rows = _with_ranges(docs, text, length, broadcast_limit)
    others = {f"c{i}": c for i, c in enumerate(docs.columns) if c != text}

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        out = []
        for value, begins, ends in zip(*(batch.column(c) for c in ("text", "begins", "ends")), strict=True):
            begins, value = begins.as_py(), value.as_py()
            if begins and value is not None:
                value = _cut(value.encode("utf-8", "surrogatepass"), begins, ends.as_py()).decode("utf-8", "ignore")
            out.append(value)
        yield {"text": out} | {c: batch.column(c) for c in others}

    fields = "text string" + "".join(f", {c} ${c}" for c in others)
    columns = {"text": text, "begins": "__begins", "ends": "__ends"} | others
    back = per_batch(rows, columns, fields, cut)
    names = {v: k for k, v in others.items()} | {text: "text"}
    return back.select(*[F.col(names[c]).alias(c) for c in docs.columns])
