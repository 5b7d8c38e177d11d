"""Token counts without encoding most of the text.

Offline, every string of the vocabulary that ends a word is encoded by the tokenizer itself; those that come out as one
token are *whole*. Inside a text, pre-tokens that are whole count one each, and only the other pre-tokens are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from starledger.llm.common import per_batch

DEFAULT_FILE = "word_bpe_49k.json"
LIMIT = 2048
# Merged pre-tokens that a task remembers; beyond that it starts anew.
REMEMBERED = 600_000
# Longer ones, in characters, are not remembered, so what a worker holds has a bound in bytes.
LONGEST_REMEMBERED = 32

# Pre-tokens of lower-cased ASCII text: what the tokenizer's own pattern matches there. White space is dropped.
ASCII_PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
ASCII_SPACE = re.compile(r"[\t-\r ]+")
END_OF_WORD = "</w>"


def tokenizer_path(name: str = DEFAULT_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter: itself, or the next letter from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def whole_tokens(path: str) -> frozenset[str]:
    """Texts of the vocabulary that the tokenizer gives as exactly one token when they stand alone.

    Proven by encoding each, not read off the vocabulary: a string of the vocabulary may be split by the pre-tokenizer,
    changed by the normalizer, or out of reach of the merges. The set is bounded by the vocabulary.
    """
    tokenizer, letters, texts = _load(path), _byte_of_letter(), []
    for token, _ in sorted(tokenizer.get_vocab(with_added_tokens=False).items()):
        if token.endswith(END_OF_WORD) and all(c in letters for c in token[: -len(END_OF_WORD)]):
            try:
                texts.append(bytes(letters[c] for c in token[: -len(END_OF_WORD)]).decode())
            except UnicodeDecodeError:
                continue  # part of a character
    encoded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, encoded, strict=True) if len(e.ids) == 1)


class Counter:
    """Counts the tokens of texts in one task."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.tokenizer, self.whole = _load(path), whole
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.known: dict[str, int] = dict.fromkeys(whole, 1)

    def _learn(self, pre_tokens: set[str]) -> dict[str, int]:
        """Merge what isn't whole and not remembered; the counts of what is too long to be remembered."""
        new, long = list(pre_tokens), {}
        for pre_token, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            (self.known if len(pre_token) <= LONGEST_REMEMBERED else long)[pre_token] = len(e.ids)
        return long

    def _pre_tokens(self, text: str) -> list[str]:
        """Pieces whose token counts add up to that of ``text``; none of them is cut by anything but white space.

        ASCII pieces are cut as the pre-tokenizer cuts them. A word with other characters stays whole and is
        left to the tokenizer, so its normalizer and its character classes decide.
        """
        if text.isascii():
            return ASCII_PRE_TOKENS.findall(text.lower())
        words = ASCII_SPACE.split(text)
        plain = ASCII_PRE_TOKENS.findall(" ".join([w for w in words if w.isascii()]).lower())
        return plain + [w for w in words if not w.isascii()]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special and self.special.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        pieces = self._pre_tokens(text)
        new = {p for p in pieces if p not in self.known}
        if new and len(self.known) > len(self.whole) + REMEMBERED:
            self.known = dict.fromkeys(self.whole, 1)
            new = {p for p in pieces if p not in self.known}
        if new and (long := self._learn(new)):
            return sum(long[p] if p in long else self.known[p] for p in pieces)
        return sum(map(self.known.__getitem__, pieces))


_COUNTERS: dict[str, Counter] = {}


def _counter(path: str, whole: Broadcast) -> Counter:
    """One per Python worker, which serves many tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path, whole.value)
    return _COUNTERS[path]


def count_tokens(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``, in one pass without a shuffle.

    A null text counts as empty: 0 bytes, 0 tokens. Strings of special tokens inside a text are handled as the
    tokenizer's default has it. Repeated rows and null ids are counted like any other; other columns are ignored.
    """
    path = path or tokenizer_path()
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        counter = _counter(path, whole)
        n_bytes, n_tokens = [], []
        for value in batch.column("text"):
            t = value.as_py()
            n_bytes.append(len(t.encode()) if t else 0)
            n_tokens.append(counter.count(t))
        yield {
            "doc_id": batch.column("doc_id"),
            "n_bytes": n_bytes,
            "n_tokens": n_tokens,
            "over_limit": [n > limit for n in n_tokens],
        }

    return per_batch(
        docs,
        {"doc_id": doc_id, "text": text},
        "doc_id $doc_id, n_bytes bigint, n_tokens bigint, over_limit boolean",
        count,
    )
