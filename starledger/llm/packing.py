"""Packing by power-of-two decomposition.

A document of n tokens is cut, from its start, into pieces whose lengths are powers of two: as many of the longest as
fit, then the binary digits of the rest, longest first. Each piece is a training sequence by itself, kept with others of
equal length, so no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import per_batch
from starledger.session import shared_folder

DEFAULT_FILE = "byte_bpe_50k.json"
LONGEST = 1024
END_OF_DOCUMENT = 0
# Sequences a task can number.
PER_TASK = 1 << 40

# Characters whose class (letter, number, space, other) has been the same in every Unicode version that a library may
# hold: up to Cyrillic, kana, the first Chinese block, Hangul. Texts with others, and texts with very long runs, go
# through the reference library itself.
SETTLED = re.compile("[\u0000-ԯ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]*")
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as ``tokenizers`` gives them for a byte-level BPE file.

    Where the file's ids are in the order of its merges, as they are in files of that kind, ``tiktoken`` merges by the
    same ranks several times faster; it is used for texts on which both must agree, the slower library for all others.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocab = _byte_of_letter(), model["vocab"]
        special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items()}
        merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        self.fast = None
        if merged == sorted(merged) and (not merged or merged[0] >= 256):
            ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
            self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.fast is not None and SETTLED.fullmatch(text) and not LONG_RUN.search(text):
            return self.fast.encode(text, allowed_special="all")
        return self.slow.encode(text, add_special_tokens=False).ids


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter: itself, or the next letter from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per Python worker, which serves many tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def binary_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that add up to ``n``, longest first, none above ``longest``."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, longest: int = LONGEST
) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: every piece of every document, lazily.

    ``ids`` are little-endian unsigned 32-bit numbers. A document is its text's ids and ``END_OF_DOCUMENT``; a null text
    counts as empty, so it is that one id. Repeated rows are packed once each. ``sequence_id`` is the task's number and
    a count within the task: unique however often a task is repeated. ``offset`` is 0, as a sequence is one piece.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    path = path or tokenizer_path()
    counts: dict[int, int] = {}

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        encoder, task = _encoder(path), TaskContext.get().partitionId()
        number = counts.get(task, 0)
        names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        out: dict[str, list] = {name: [] for name in names}
        held = 0
        for doc, value in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            ids = np.array([*encoder.encode(value.as_py()), END_OF_DOCUMENT], "<u4").tobytes()
            n, start = len(ids) // 4, 0
            for length in binary_lengths(n, longest):
                row = (doc.as_py(), start, length, ids[4 * start : 4 * (start + length)], n, task * PER_TASK + number, 0)
                for name, x in zip(names, row, strict=True):
                    out[name].append(x)
                start, number, held = start + length, number + 1, held + length
            if held > 2_000_000:
                yield out
                out, held = {name: [] for name in names}, 0
        counts[task] = number
        yield out

    return per_batch(
        docs,
        {"doc_id": doc_id, "text": text},
        "doc_id $doc_id, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
        cut,
    )


def pack(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the pieces of ``docs``, one folder per length, and read them back.

    A trainer takes batches from one folder ``bucket=L`` at a time: all its sequences have L tokens. Options are those of
    ``pieces``. Without ``folder`` the table lies in the shared folder until the session ends.
    """
    spark: SparkSession = docs.sparkSession
    folder = folder or shared_folder(spark, "packed")
    found = pieces(docs, **options)
    bucketed = found.withColumn("bucket", F.col("length"))
    bucketed.write.partitionBy("bucket").parquet(folder)
    return spark.read.schema(bucketed.schema).parquet(folder).select(found.columns)
