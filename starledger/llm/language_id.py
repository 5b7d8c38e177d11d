"""Language identification by prediction by partial matching.

For each language a context tree holds how often each byte followed each context of up to four bytes. A byte seen after
the longest known context is coded by its count there; otherwise an escape is paid and the context is shortened, down to
a uniform code. Counts are frozen after training, so the code length of a byte depends only on the five bytes that end
with it, and a text's length under each language is a sum of table entries. The language with the shortest code wins.

With n occurrences of a context and d different followers, a follower seen c times costs -log2(c / (n + d)) bits and the
escape -log2(d / (n + d)) bits (escape method C, without exclusions).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import by_position, filter_rows, hash_share, held_out, per_batch, slices, text_start, written

# Bytes per entry of the tree: a context of up to four bytes and what follows.
DEPTH = 5
# The bounded sample that the trees are grown from: documents per language, and bytes from the start of each document.
TRAIN_DOCUMENTS = 400
TRAIN_BYTES = 65_536
# Entries of four and five bytes that occur only once are left out of the frozen trees.
PRUNED_FROM, LEAST = 4, 2
UNKNOWN = "und"
# Bits per byte that need no model at all, and how much worse than that a text may be coded before it is in no language.
UNIFORM_BITS, REJECT_BITS = 8.0, 64.0

# Characters among which letters are; numbers such as "½" and "Ⅷ" are among them too.
WORD = re.compile(r"[^\W\d_]")
# How many more than the wanted ids of a language are ranked, the rest being left out by their hashes.
SPARE = 4
SLICE_BYTES = 250_000
# Every text is coded as if it followed these bytes, so each byte has a full context.
LEAD = b"\n" * (DEPTH - 1)


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in WORD.finditer(text))


def _coded(text: str) -> bytes:
    return LEAD + text.lower().encode("utf-8", "surrogatepass")


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """The n bytes that end at each byte from the n-th on, as one number each."""
    size = len(data) - n + 1
    grams = data[:size].astype(np.int64)
    for k in range(1, n):
        grams = (grams << 8) | data[k : k + size]
    return grams


def gram_counts(sample: DataFrame) -> DataFrame:
    """``lang, n, gram, count`` of all byte strings of 1 to ``DEPTH`` bytes in the texts of ``sample`` (lang, text)."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(_coded(text))
        for lang, texts in by_lang.items():
            for n in range(1, DEPTH + 1):
                # Every byte of a text, but not the lead, is counted once for each n.
                found = [_grams(np.frombuffer(t, np.uint8)[len(LEAD) + 1 - n :], n) for t in texts if len(t) > len(LEAD)]
                if found:
                    grams, counts = np.unique(np.concatenate(found), return_counts=True)
                    yield {"lang": [lang] * len(grams), "n": [n] * len(grams), "gram": pa.array(grams), "count": pa.array(counts)}

    rows = per_batch(sample, {"lang": "lang", "text": "text"}, "lang string, n int, gram bigint, count bigint", count)
    return rows.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


@dataclass
class Trees:
    """Frozen code lengths. For each n: sorted strings of n bytes known to some language, the bits of their last byte
    under each language, and, for strings that serve as contexts, the bits of an escape."""

    languages: list[str]
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def __post_init__(self):
        top = self.grams[-1]
        self.shift = np.uint64(64 - max(12, int(len(top) * 4 - 1).bit_length()))
        slots = _slot(top, self.shift)
        self.slots = np.zeros(1 << int(64 - self.shift), np.int32)
        self.slots[slots[::-1]] = np.arange(len(top), dtype=np.int32)[::-1]

    def lookup(self, data: np.ndarray) -> np.ndarray:
        """Bits of each byte from the ``DEPTH``-th on, a column per language."""
        grams = _grams(data, DEPTH)
        if not len(self.grams[-1]):
            return self._shorter(grams, DEPTH)
        at = self.slots[_slot(grams, self.shift)]
        bits = self.bits[-1][at]
        missed = np.flatnonzero(self.grams[-1][at] != grams)
        if len(missed):
            bits[missed] = self._of(grams[missed], DEPTH)
        return bits

    def _of(self, grams: np.ndarray, n: int) -> np.ndarray:
        if n == 0:
            return np.full((len(grams), len(self.languages)), UNIFORM_BITS, np.float32)
        at, known = _find(self.grams[n - 1], grams)
        out = np.empty((len(grams), len(self.languages)), np.float32)
        out[known] = self.bits[n - 1][at[known]]
        rest = ~known
        if rest.any():
            out[rest] = self._shorter(grams[rest], n)
        return out

    def _shorter(self, grams: np.ndarray, n: int) -> np.ndarray:
        """An escape from the context of n - 1 bytes, where a language knows it, then the code in the next shorter one."""
        bits = self._of(grams & ((1 << (8 * (n - 1))) - 1), n - 1)
        at, known = _find(self.contexts[n - 1], grams >> 8)
        bits[known] += self.escapes[n - 1][at[known]]
        return bits


def _slot(grams: np.ndarray, shift: np.uint64) -> np.ndarray:
    return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def grow(languages: list[str], counts: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from counts; ``counts[lang, n]`` are sorted strings of n bytes and how often each occurs."""
    trees = Trees(languages, [np.empty(0, np.int64)], [np.empty((0, len(languages)), np.float32)], [], [])
    trees.grams, trees.bits = [], []
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    for n in range(1, DEPTH + 1):
        own = [counts.get((lang, n), none) for lang in languages]
        grams = np.unique(np.concatenate([none[0], *(g for g, _ in own)]))
        contexts = np.unique(grams >> 8)
        seen = np.zeros((len(grams), len(languages)))
        for k, (g, c) in enumerate(own):
            seen[np.searchsorted(grams, g), k] = c
        # Totals and followers of each context; contexts are runs, as strings are sorted.
        starts = np.searchsorted(grams >> 8, contexts)
        total = np.add.reduceat(seen, starts) if len(grams) else seen
        followers = np.add.reduceat(seen > 0, starts, dtype=float) if len(grams) else seen
        with np.errstate(divide="ignore", invalid="ignore"):
            escapes = np.where(total > 0, -np.log2(followers / (total + followers)), 0)
            own_bits = -np.log2(seen / (total + followers)[np.searchsorted(contexts, grams >> 8)])
        trees.contexts.append(contexts)
        trees.escapes.append(escapes.astype(np.float32))
        escaped = trees._shorter(grams, n)
        trees.grams.append(grams)
        trees.bits.append(np.where(seen > 0, own_bits, escaped).astype(np.float32))
    trees.__post_init__()
    return trees


def train(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    documents: int = TRAIN_DOCUMENTS,
    most_bytes: int = TRAIN_BYTES,
) -> Trees:
    """Grow the trees from a bounded sample of the labelled rows that aren't held out.

    Per language, of its non-empty texts, the ``documents`` whose ids have the smallest hashes (all rows of an id count as
    one). Of a longer text, its first ``most_bytes`` bytes are learned. Rows without text, language or id are no examples.
    """
    examples = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")
    ).filter(
        ~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") >= 1)
    )
    examples = examples.withColumn("text", text_start("text", most_bytes))
    ids = written(examples.select("lang", "doc_id").distinct(), "language-ids")
    sizes = ids.groupBy("lang").agg(F.count("*").alias("size"))
    # Of a language's ids those with the smallest hashes are ranked, SPARE times as many as wanted on average: fewer than
    # wanted would be one in 10^300. The list of sizes grows with the languages only.
    near = ids.join(F.broadcast(sizes), "lang").filter(hash_share("doc_id") * F.col("size") <= SPARE * documents)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = near.select("lang", "doc_id", F.row_number().over(first).alias("rank"))
    # At most ``documents`` ids per language, so their number is bounded.
    picked = written(ranked.filter(F.col("rank") <= documents).select("lang", "doc_id"), "language-sample")
    sample = examples.join(F.broadcast(picked), ["lang", "doc_id"], "left_semi")
    sample = sample.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    pruned = gram_counts(sample.select("lang", "text")).filter((F.col("n") < PRUNED_FROM) | (F.col("count") >= LEAST))
    found = pruned.toArrow()
    table = {name: found.column(name) for name in found.column_names}
    langs = table["lang"].to_numpy(zero_copy_only=False)
    n, gram, count = (table[c].to_numpy() for c in ("n", "gram", "count"))
    languages = sorted(set(langs.tolist()))
    code = np.searchsorted(np.array(languages), langs) if languages else np.empty(0, np.int64)
    order = np.lexsort((gram, n, code))
    code, n, gram, count = code[order], n[order], gram[order], count[order]
    counts = {}
    for k, language in enumerate(languages):
        for m in range(1, DEPTH + 1):
            i = slice(*np.searchsorted(code * (DEPTH + 1) + n, [k * (DEPTH + 1) + m, k * (DEPTH + 1) + m + 1]))
            counts[language, m] = gram[i], count[i]
    return grow(languages, counts)


def code_lengths(texts: list[str], trees: Trees) -> np.ndarray:
    """Bits of each text under each language."""
    out = np.zeros((len(texts), len(trees.languages)))
    coded = [_coded(t) for t in texts]
    for a, b in slices([len(c) for c in coded], SLICE_BYTES):
        ends = np.cumsum([len(c) - len(LEAD) for c in coded[a:b]])
        # Strings that reach from one text into the lead of the next are left out.
        data = np.frombuffer(b"".join(coded[a:b]), np.uint8)
        bits = trees.lookup(data)
        keep = np.ones(len(bits), bool)
        starts = np.cumsum([0, *(len(c) for c in coded[a : b - 1])])
        for s in starts[1:]:
            keep[s - len(LEAD) : s] = False
        totals = np.cumsum(bits[keep], axis=0, dtype=np.float64)
        totals = np.vstack([np.zeros((1, totals.shape[1])), totals])
        bounds = np.concatenate([[0], ends])
        out[a:b] = totals[bounds[1:]] - totals[bounds[:-1]]
    return out


def _judged(texts: list[str | None], trees: Trees) -> tuple[list[str], list[float], list[float | None]]:
    """Language, probability and bits of each text."""
    real = [i for i, t in enumerate(texts) if t and has_letter(t)] if trees.languages else []
    langs, scores, bits = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
    if real:
        lengths = code_lengths([texts[i] for i in real], trees)
        best = lengths.argmin(axis=1)
        least = lengths[np.arange(len(real)), best]
        chance = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1)
        for j, i in enumerate(real):
            langs[i], scores[i], bits[i] = trees.languages[best[j]], float(chance[j]), float(least[j])
    return langs, scores, bits


def _size(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def identify(docs: DataFrame, trees: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_byte`` for every row of ``docs``, in one pass.

    ``lang_pred`` is ``und`` and ``score`` 0 for a null text, one without a letter, or if no language was learned.
    Otherwise the score is the probability of the language given the text, all languages being equally likely before.
    Ties go to the language that sorts first. Very long texts are coded whole. Other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column("text").to_pylist()
        langs, scores, bits = _judged(texts, model.value)
        rates = [None if b is None else b / _size(t) for b, t in zip(bits, texts, strict=True)]
        yield {"doc_id": batch.column("doc_id"), "lang_pred": langs, "score": scores, "bits_per_byte": rates}

    fields = "doc_id $doc_id, lang_pred string, score double, bits_per_byte double"
    return per_batch(docs, {"doc_id": doc_id, "text": text}, fields, score)


def in_a_language(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in one of the languages, all columns unchanged.

    Rejected are texts identified as ``und``, and those that the best language codes with over ``REJECT_BITS`` bits more
    than a uniform code needs: no language explains them. A short text can't exceed that by chance. If no language was
    learned, every text with a letter stays.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def keep(batch: pa.RecordBatch) -> pa.Array:
        texts = batch.column("text").to_pylist()
        if not model.value.languages:
            return pa.array([bool(t and has_letter(t)) for t in texts], pa.bool_())
        langs, _, bits = _judged(texts, model.value)
        return pa.array(
            [x != UNKNOWN and b <= UNIFORM_BITS * _size(t) + REJECT_BITS for x, b, t in zip(langs, bits, texts, strict=True)],
            pa.bool_(),
        )

    return by_position(docs, lambda placed, text: filter_rows(placed, {"text": text}, keep), text=text)
