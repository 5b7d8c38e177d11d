"""Byte-level BPE over texts of any length: encoding in overlapping chunks, and decoding.

A long text is cut into chunks that overlap, and the chunks are pre-tokenised in parallel, each from its own start. A
pre-tokenizer that only looks ahead goes on from a boundary in the same way wherever it began. So the first boundary
that two neighbours both find in their overlap is where one may end and the other take over: everything before it is
right in the first chunk, everything after it in the second. The pieces between those places are encoded by themselves,
and their ids follow one another. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import per_batch, ship, slices, written
from starledger.operators.joins import split_join

DEFAULT_FILE = "byte_bpe_50k.tiktoken"
# Characters from the start of one chunk to the next, and how far a chunk reaches into the next.
CHUNK, OVERLAP = 65_536, 2_048
# Boundaries so close to the end of a chunk may be owed to the cut: the longest fixed text of the pattern has 3 characters.
MARGIN = 4
# Pre-tokens that a task remembers, and the longest of them in characters: a bound in bytes.
REMEMBERED, LONGEST_REMEMBERED = 300_000, 32
# A letter, a number, white space, and none of these, of the same class in every library.
LETTER, NUMBER, SPACE, OTHER = "é", "٣", " ", "§"


def ranks_path(name: str = DEFAULT_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the neighbours of least rank are joined, leftmost first, until no pair has a rank."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    # A part is known by its start; end[start] is 0 once the part on its left has taken it in.
    end, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(ranks[p], i, i + 2) for i in range(n - 1) if (p := piece[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= stop or end[middle] != stop:
            continue  # one of the two has been joined to another since
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
            if (rank := ranks.get(piece[start : end[stop]])) is not None:
                heapq.heappush(heap, (rank, start, end[stop]))
        if (left := before[start]) >= 0 and (rank := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (rank, left, stop))
    ids, start = [], 0
    while start < n:
        ids.append(ranks[piece[start : end[start]]])
        start = end[start]
    return ids


class _Known(dict):
    """Packed ids by pre-token; those of short ones are remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


def _unlike() -> dict[int, str]:
    """Characters that the regular expressions here and those of the tokenizer's library class differently, each with a
    character that both class as the library does the first. The two follow different versions of Unicode."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    theirs, ours = {}, {}
    for name, stand_in in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        library = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs |= dict.fromkeys(bytes(library.encode_ordinary(every)).decode(), stand_in)
        ours |= dict.fromkeys(regex.findall(name, every), stand_in)
    return {ord(c): theirs.get(c, OTHER) for c in theirs.keys() | ours.keys() if theirs.get(c) != ours.get(c)}


class Encoder:
    """Boundaries and ids of texts in one task."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern, self.known = regex.compile(pattern), _Known(self.ranks)
        self.unlike = _unlike()
        self.unlike_chars = frozenset(map(chr, self.unlike))
        self.beyond = re.compile(f"[{min(self.unlike_chars)}-\U0010ffff]" if self.unlike else "(?!)")

    def _odd(self, text: str) -> bool:
        # Most texts end at the first test: all characters that differ lie beyond the common alphabets.
        return not text.isascii() and self.beyond.search(text) is not None and not self.unlike_chars.isdisjoint(text)

    def boundaries(self, text: str) -> list[int]:
        """Where pre-tokens end."""
        return [m.end() for m in self.pattern.finditer(text.translate(self.unlike) if self._odd(text) else text)]

    def pre_tokens(self, text: str, start: int = 0, stop: int | None = None) -> list[str]:
        """Those from one boundary to another; what lies behind the latter is looked at, as it may decide the last."""
        odd = self._odd(text)
        if not odd and start == 0 and stop is None:
            return self.pattern.findall(text)
        found = self.pattern.finditer(text.translate(self.unlike) if odd else text, start)
        return [text[m.start() : m.end()] for m in found if stop is None or m.end() <= stop]

    def encode(self, text: str, start: int = 0, stop: int | None = None) -> bytes:
        return b"".join(map(self.known.__getitem__, self.pre_tokens(text, start, stop)))


_ENCODERS: dict[tuple[str, str], Encoder] = {}
_TOKENS: dict[str, dict[int, bytes]] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker, which serves many tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def _tokens(path: str) -> dict[int, bytes]:
    if path not in _TOKENS:
        _TOKENS[path] = {rank: token for token, rank in read_ranks(path).items()}
    return _TOKENS[path]


def encode(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row of ``docs``; ``ids`` are little-endian unsigned 32-bit numbers.

    ``path`` names the ranks, ``pattern`` what a pre-token is; it may look ahead but not back, and know characters by
    ``\\p{L}``, ``\\p{N}`` and ``\\s``. Special tokens have no meaning here. A null text counts as empty and has no ids.
    Null ids and repeated rows are encoded like any other; other columns play no part.

    A text of one chunk is encoded where it lies, without a shuffle. Of longer ones each distinct text is cut once, its
    chunks dealt over all tasks; what neighbours tell each other are the boundaries in their overlap. A text in which two
    neighbours share no boundary (a run without any, longer than the overlap) is put together again and encoded by one
    task.
    """
    if not MARGIN < overlap <= chunk:
        raise ValueError(f"the overlap must be above {MARGIN} and at most a chunk")
    ship(docs.sparkSession)
    path, pattern = path or ranks_path(), pattern or default_pattern()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    is_long = F.length("text") > chunk + overlap
    short = _encoded(rows.filter(~is_long), ["doc_id"], path, pattern)
    long = rows.filter(is_long).select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("key"), "text")
    texts = long.groupBy("key").agg(F.first("text").alias("text"))  # equal keys, equal texts
    by_key = written(_encoded_in_chunks(texts, path, pattern, chunk, overlap), "byte-bpe-ids")
    long_ids = split_join(long.select("doc_id", "key"), by_key, "key").select("doc_id", "ids")
    return short.unionByName(long_ids).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids"
    )


def _encoded(df: DataFrame, others: list[str], path: str, pattern: str) -> DataFrame:
    """``text`` of every row as ``ids``, beside some other columns."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        encoder, texts = _encoder(path, pattern), batch.column("text")
        for start, stop in slices(pc.binary_length(texts).to_pylist()):
            part = batch.slice(start, stop - start)
            ids = [encoder.encode(x.as_py()) for x in part.column("text")]
            yield {name: part.column(name) for name in others} | {"ids": ids}

    fields = "".join(f"{name} ${name}, " for name in others)
    return per_batch(df, {c: c for c in [*others, "text"]}, f"{fields}ids binary", run)


def _encoded_in_chunks(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``key, ids`` of long texts."""

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for key, value in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
            value = value.as_py()
            count = -(-max(1, len(value) - overlap) // chunk)
            for first in range(0, count, 64):
                numbers = range(first, min(count, first + 64))
                yield {
                    "key": [key] * len(numbers),
                    "n": list(numbers),
                    "chunk": [value[n * chunk : n * chunk + chunk + overlap] for n in numbers],
                }

    fields = "key string, n int, chunk string"
    chunks = written(per_batch(texts, {"key": "key", "text": "text"}, fields, cut).repartition("key", "n"), "byte-bpe-chunks")

    def ends(batch: pa.RecordBatch) -> Iterator[dict]:
        """Boundaries that a chunk finds in its overlaps, counted from the start of the overlap."""
        encoder, head, tail = _encoder(path, pattern), [], []
        for value in batch.column("chunk"):
            value = value.as_py()
            found = [0, *encoder.boundaries(value)]
            head.append([b for b in found if b < overlap])
            tail.append([b - chunk for b in found if chunk <= b <= len(value) - MARGIN])
        yield {"key": batch.column("key"), "n": batch.column("n"), "head": head, "tail": tail}

    columns = {c: c for c in ("key", "n", "chunk")}
    found = written(per_batch(chunks, columns, "key string, n int, head array<int>, tail array<int>", ends), "byte-bpe-ends")
    before = found.select("key", (F.col("n") + 1).alias("n"), "tail")
    meets = F.array_min(F.array_intersect("tail", "head")).alias("meets")
    joints = written(before.join(found.select("key", "n", "head"), ["key", "n"]).select("key", "n", meets), "byte-bpe-joints")
    apart = joints.filter(F.col("meets").isNull()).select("key").distinct()

    starts = joints.select("key", "n", F.col("meets").alias("start"))
    stops = joints.select("key", (F.col("n") - 1).alias("n"), (F.col("meets") + chunk).alias("stop"))
    spans = chunks.join(starts, ["key", "n"], "left").join(stops, ["key", "n"], "left").join(apart, "key", "left_anti")

    def encode_span(batch: pa.RecordBatch) -> Iterator[dict]:
        encoder = _encoder(path, pattern)
        spans = zip(batch.column("chunk"), batch.column("start").to_pylist(), batch.column("stop").to_pylist(), strict=True)
        parts = [encoder.encode(text.as_py(), start or 0, stop) for text, start, stop in spans]
        yield {"key": batch.column("key"), "n": batch.column("n"), "part": parts}

    columns |= {"start": "start", "stop": "stop"}
    encoded = per_batch(spans, columns, "key string, n int, part binary", encode_span)

    # The last chunk ends the text; all others give way to the next one where it starts.
    last = chunks.join(apart, "key", "left_semi").groupBy("key").agg(F.max("n").alias("last"))
    own = F.when(F.col("n") == F.col("last"), F.col("chunk")).otherwise(F.substring("chunk", 1, chunk))
    rest = _put_together(chunks.join(last, "key").select("key", "n", own.cast("binary").alias("part")))
    whole = _encoded(rest.select("key", F.col("whole").cast("string").alias("text")), ["key"], path, pattern)
    ids = _put_together(encoded).withColumnRenamed("whole", "ids")
    return ids.unionByName(whole)


def _put_together(parts: DataFrame) -> DataFrame:
    """``key, whole`` from ``key, n, part``: the parts of a key one after the other. A key is one text of one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for k, part in zip(batch.column("key").to_pylist(), batch.column("part"), strict=True):
                if k != key and held:
                    yield _whole(key, held)
                    held = []
                key = k
                held.append(part.as_py())
        if held:
            yield _whole(key, held)

    in_order = parts.repartition("key").sortWithinPartitions("key", "n").select("key", "part")
    return in_order.mapInArrow(run, "key string, whole binary")


def _whole(key: str, parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([b"".join(parts)], pa.binary())], ["key", "whole"])


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the bytes of all ids, one after the other.

    They are bytes and need not be text, as ids may be cut anywhere. Null ids give null, no ids no bytes; an id without a
    token makes the job fail.
    """
    path = path or ranks_path()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        tokens, ids = _tokens(path), batch.column("ids")
        sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in ids]
        for start, stop in slices(sizes):
            part = batch.slice(start, stop - start)
            decoded = [
                b"".join([tokens[i] for i in np.frombuffer(x.as_py(), "<u4").tolist()]) if x.is_valid else None
                for x in part.column("ids")
            ]
            yield {name: part.column(name) for name in ("doc_id", "n_tokens", "ids")} | {"decoded": decoded}

    columns = {name: name for name in ("doc_id", "n_tokens", "ids")}
    return per_batch(encoded, columns, "doc_id $doc_id, n_tokens bigint, ids binary, decoded binary", run)
