"""Phrase collocations, counted pair by pair over direct-address tiles.

Words are numbered by frequency, the most frequent first, so that the pairs of frequent words lie close together in the
plane of pairs. The plane is cut into square tiles. Where a tile holds many pairs, each cell has an address and one dense
``bincount`` counts them all; where it holds few, their codes are sorted and runs are counted.

Longer phrases come by the same step: frequent pairs are numbered by frequency in turn and take the words' place. Two
phrases of k words that overlap in all but one word of each make one of k + 1, and a frequent phrase consists of frequent
ones, so nothing is missed.

The corpus is held as *slices*: the numbers of the words of some texts, one after the other, and the list of the distinct
symbols among them with their counts. Only those lists are joined and summed up over the corpus; a symbol travels at most
once per slice, whatever its frequency, and a vocabulary is held as a whole only where it was measured to be small.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import batch_rows, discard, per_batch, ship, written
from starledger.operators.joins import BROADCAST_LIMIT, measured_bytes

LONGEST = 5
LEAST = 100
TOP = 2000
# A longer candidate with this share of the occurrences, in percent, makes a shorter one go.
COVERED_PCT = 100
# Words of a slice, about.
SLICE_WORDS = 500_000
# Side of a tile, and the share of its cells from which on it is counted densely.
TILE = 512
DENSE = 1 / 8
NO_LANGUAGE = "und"

# Bytes that part pieces and words. 0xFF is in no text, so it can stand for the former.
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = b"\xff"
_TABLE = bytes(0xFF if b in _BREAKS else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; a break between pieces is an entry of its own."""
    return text.encode().translate(_TABLE).replace(_BREAK, b" \xff ").split() if text else []


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    covered_pct: int = COVERED_PCT,
    top: int = TOP,
    slice_words: int = SLICE_WORDS,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``longest`` words of every language.

    A candidate occurs ``a >= least`` times within pieces. Of its cuts in two, the one with the lowest score counts, ties
    to the earliest: l and r are the occurrences of the two parts, n all words of the language, and the score is
    ``floor(1000 a n / (l r))``. A candidate inside a longer one that has ``covered_pct`` percent of its occurrences or
    more goes. Ranks go by score, then a, both descending, then phrase in byte order.

    A null language is ``und``; null and empty texts have no words; repeated rows count as often as they occur. Only the
    two columns named play a part. Arithmetic is exact while 1000 a n stays below 10^38.
    """
    ship(docs.sparkSession)
    language = F.coalesce(F.col(f"`{lang}`"), F.lit(NO_LANGUAGE))
    rows = docs.select(language.alias("lang"), F.col(f"`{text}`").alias("text"))
    level = written(_word_slices(rows, slice_words, longest), "phrases-1", large_rows=True)
    sizes = _summed(level, "lang").withColumnRenamed("f", "n")
    sizes = written(sizes, "phrases-n")

    phrases = []
    for length in range(1, longest + 1):
        frequent = _numbered(_summed(level, "lang", "symbol").filter(F.col("f") >= least), f"phrases-{length}-frequent")
        phrases.append(_described(frequent, phrases[-1] if phrases else None, length))
        if length < longest:
            following, sent = _next_level(level, frequent, broadcast_limit)
            with batch_rows(docs.sparkSession, 1):
                following = written(following, f"phrases-{length + 1}", large_rows=True)
            if sent is not None:
                sent.destroy()
            discard(level)
            level = following
    return _ranked(_scored(phrases, sizes, covered_pct), top)


# --- slices ---


_SLICES = "slice bigint, lang string, starts int, tokens binary, symbols array<{}>, counts array<bigint>"


class _Words:
    """The words of some texts by their places in a list of distinct words, from 1 on; 0 is a break."""

    def __init__(self):
        self.places, self.tokens, self.size = {_BREAK: 0}, [], 0

    def add(self, words: list[bytes]) -> None:
        places = self.places
        for word in words:
            if word not in places:
                places[word] = len(places)
        self.tokens.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def slice(self, number: int, lang: str, starts: int) -> pa.RecordBatch:
        tokens = np.concatenate(self.tokens)
        counts = np.bincount(tokens[:starts], minlength=len(self.places))[1:]
        symbols = [w.decode() for w in self.places if w != _BREAK]
        names = ["slice", "lang", "starts", "tokens", "symbols", "counts"]
        row = [number, lang, starts, tokens.tobytes(), symbols, counts]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _SLICE_TYPES, strict=True)], names)


_SLICE_TYPES = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()))


def _word_slices(rows: DataFrame, slice_words: int, longest: int) -> DataFrame:
    """``slice, lang, starts, tokens, symbols, counts`` of all texts.

    ``tokens`` are places in ``symbols``. Only the first ``starts`` of them belong to the slice: a text longer than a
    slice goes on in another one, and the words after the cut are given at the end, so that phrases across it are seen.
    A task holds a slice per language, and no more than ``4 * slice_words`` words in all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        held: dict[str, _Words] = {}
        for batch in batches:
            for lang, value in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                words = words_of(value.as_py())
                if len(words) > slice_words:
                    for start in range(0, len(words), slice_words):
                        part = _Words()
                        part.add(words[start : start + slice_words + longest])
                        yield part.slice(next(numbers), lang, min(slice_words, len(words) - start))
                elif words:
                    here = held.setdefault(lang, _Words())
                    here.add([*words, _BREAK])
                    if here.size >= slice_words:
                        yield held.pop(lang).slice(next(numbers), lang, here.size)
                    elif sum(w.size for w in held.values()) >= 4 * slice_words:
                        for name in list(held):
                            full = held.pop(name)
                            yield full.slice(next(numbers), name, full.size)
        for name, rest in held.items():
            yield rest.slice(next(numbers), name, rest.size)

    return rows.mapInArrow(run, _SLICES.format("string"))


def pair_counts(left: np.ndarray, right: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs among (left[i], right[i]), as codes ``left << 32 | right`` in ascending order, and how often
    each occurs. Numbers are those of frequency, from 0."""
    if not len(left):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    side = int(max(left.max(), right.max())) // tile + 1
    tiles = (left // tile) * side + right // tile
    names, inverse, held = np.unique(tiles, return_inverse=True, return_counts=True)
    dense = held >= max(1, int(DENSE * tile * tile))
    codes, counts = [], []
    for k in np.flatnonzero(dense):
        inside = inverse == k
        low_left, low_right = (int(names[k]) // side) * tile, (int(names[k]) % side) * tile
        cells = np.bincount((left[inside] - low_left) * tile + (right[inside] - low_right), minlength=tile * tile)
        used = np.flatnonzero(cells)
        codes.append(((used // tile + low_left) << 32) | (used % tile + low_right))
        counts.append(cells[used])
    sparse = ~dense[inverse]
    found, times = np.unique((left[sparse] << 32) | right[sparse], return_counts=True)
    codes, counts = np.concatenate([*codes, found]), np.concatenate([*counts, times])
    order = np.argsort(codes, kind="stable")
    return codes[order], counts[order].astype(np.int64)


_COLUMNS = ("slice", "lang", "starts", "tokens")


def _next_level(level: DataFrame, frequent: DataFrame, broadcast_limit: int) -> tuple[DataFrame, Broadcast | None]:
    """The slices with pairs of neighbouring frequent symbols as symbols, and what was sent to the tasks for that.

    The numbers of frequent symbols go to every task if they were measured to be few. Else each slice's list of symbols is
    joined with them, and what was found is gathered by slice; a gathered group is bounded by the size of a slice.
    """
    fields = _SLICES.format("bigint")
    if measured_bytes(frequent) <= broadcast_limit:
        numbers = level.sparkSession.sparkContext.broadcast(_by_lang(frequent))

        def look_up(batch: pa.RecordBatch) -> Iterator[dict]:
            for row in range(batch.num_rows):
                known = numbers.value.get(batch.column("lang")[row].as_py())
                if known is not None:
                    symbols = batch.column("symbols")[row].values
                    places, found = _found(symbols, *known)
                    yield from _paired(batch.slice(row, 1), len(symbols), places, found)

        return per_batch(level, {c: c for c in (*_COLUMNS, "symbols")}, fields, look_up), numbers

    symbols = level.select("slice", "lang", F.posexplode("symbols").alias("place", "symbol"))
    known = symbols.join(frequent.select("lang", "symbol", "number"), ["lang", "symbol"])
    gathered = known.groupBy("slice").agg(F.collect_list("place").alias("places"), F.collect_list("number").alias("numbers"))

    def gather(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in range(batch.num_rows):
            places, found = (batch.column(c)[row].values.to_numpy() for c in ("places", "numbers"))
            yield from _paired(batch.slice(row, 1), batch.column("width")[row].as_py(), places, found)

    joined = level.select(*_COLUMNS, F.size("symbols").alias("width")).join(gathered, "slice")
    return per_batch(joined, {c: c for c in (*_COLUMNS, "width", "places", "numbers")}, fields, gather), None


def _by_lang(frequent: DataFrame) -> dict[str, tuple[pa.Array, np.ndarray]]:
    """Per language the frequent symbols in order, and their numbers."""
    table = frequent.select("lang", "symbol", "number").toArrow().sort_by([("lang", "ascending"), ("symbol", "ascending")])
    table = table.combine_chunks()
    out = {}
    for lang in pc.unique(table.column("lang")).to_pylist():
        part = table.filter(pc.equal(table.column("lang"), lang)).combine_chunks()
        out[lang] = (part.column("symbol").combine_chunks(), part.column("number").to_numpy())
    return out


def _found(symbols: pa.Array, known: pa.Array, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of those symbols that are known, and their numbers."""
    index = pc.index_in(symbols, value_set=known.cast(symbols.type))
    places = np.flatnonzero(index.is_valid().to_numpy(zero_copy_only=False))
    return places, numbers[index.drop_null().to_numpy()]


def _paired(one: pa.RecordBatch, width: int, places: np.ndarray, numbers: np.ndarray) -> Iterator[dict]:
    """The next level of one slice of which ``width`` symbols are listed and those at some places have numbers."""
    old, starts = np.frombuffer(one.column("tokens")[0].as_py(), np.int32), one.column("starts")[0].as_py()
    lookup = np.full(width + 1, -1, np.int64)
    lookup[places + 1] = numbers
    left, right = lookup[old[:-1]], lookup[old[1:]]
    paired = np.flatnonzero((left >= 0) & (right >= 0))
    own, after = paired[paired < starts], paired[paired >= starts]
    codes, counts = pair_counts(left[own], right[own])
    # Pairs after the slice's own part are listed, as later levels need their numbers, but count elsewhere.
    extra = np.setdiff1d((left[after] << 32) | right[after], codes)
    order = np.argsort(codes := np.concatenate([codes, extra]))
    codes, counts = codes[order], np.concatenate([counts, np.zeros(len(extra), np.int64)])[order]
    tokens = np.zeros(len(left), np.int32)
    tokens[paired] = np.searchsorted(codes, (left[paired] << 32) | right[paired]) + 1
    if len(codes):
        yield {
            "slice": one.column("slice"),
            "lang": one.column("lang"),
            "starts": [starts],
            "tokens": [tokens.tobytes()],
            "symbols": [codes],
            "counts": [counts],
        }


def _summed(level: DataFrame, *keys: str) -> DataFrame:
    """``f`` per key: occurrences in all slices."""
    pairs = F.explode(F.arrays_zip("symbols", "counts")).alias("pair")
    if "symbol" not in keys:
        total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda x, y: x + y)
        return level.select("lang", total.alias("f")).groupBy(*keys).agg(F.sum("f").alias("f"))
    each = level.select("lang", pairs).select("lang", F.col("pair.symbols").alias("symbol"), F.col("pair.counts").alias("f"))
    return each.groupBy(*keys).agg(F.sum("f").alias("f"))


def _numbered(counted: DataFrame, purpose: str) -> DataFrame:
    """Add ``number``: 0 for the most frequent symbol of a language, and so on.

    A sort deals the symbols over the tasks in order; what a task holds of a language is numbered from the place where
    the tasks before it end. Only those places are looked at together, a few per task.
    """
    in_order = counted.repartitionByRange("lang", F.desc("f"), "symbol").sortWithinPartitions("lang", F.desc("f"), "symbol")
    row = F.monotonically_increasing_id()
    dealt = written(in_order.withColumns({"row": row, "part": F.spark_partition_id()}), purpose)
    parts = dealt.groupBy("lang", "part").agg(F.min("row").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("lang", "part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    numbered = dealt.join(starts, ["lang", "part"])
    number = (F.col("start") + F.col("row") - F.col("first")).cast("bigint")
    return written(numbered.select("lang", "symbol", "f", number.alias("number")), f"{purpose}-numbered")


# --- phrases ---


def _described(frequent: DataFrame, shorter: DataFrame | None, length: int) -> DataFrame:
    """``lang, number, f, words, heads, tails, left, right``: frequent phrases of ``length`` words.

    ``heads[j]`` and ``tails[j]`` are the occurrences of the first and the last j + 1 words; left and right are the
    numbers of the phrases without the last and without the first word.
    """
    if shorter is None:
        one = F.array("f")
        none = F.lit(None).cast("bigint")
        return frequent.select(
            "lang", "number", "f", F.array("symbol").alias("words"), one.alias("heads"), one.alias("tails"),
            none.alias("left"), none.alias("right"),
        )
    parts = frequent.withColumns({"left": F.shiftright("symbol", 32), "right": F.col("symbol").bitwiseAND((1 << 32) - 1)})
    first = shorter.select("lang", F.col("number").alias("left"), F.col("words").alias("first"), "heads")
    last = shorter.select("lang", F.col("number").alias("right"), F.col("words").alias("last"), "tails")
    whole = parts.join(first, ["lang", "left"]).join(last, ["lang", "right"])
    return written(
        whole.select(
            "lang",
            "number",
            "f",
            F.array_append("first", F.element_at("last", -1)).alias("words"),
            F.array_append("heads", F.col("f")).alias("heads"),
            F.array_append("tails", F.col("f")).alias("tails"),
            "left",
            "right",
        ),
        f"phrases-{length}-described",
    )


def _wide(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def _scored(phrases: list[DataFrame], sizes: DataFrame, covered_pct: int) -> DataFrame:
    """Candidates with their lowest cut, without those that a longer one covers."""
    kept = []
    for length, level in enumerate(phrases, 1):
        if length == 1:
            continue
        if length < len(phrases):
            longer = phrases[length]
            inside = reduce(DataFrame.unionAll, [longer.select("lang", F.col(side).alias("number"), "f") for side in ("left", "right")])
            cover = inside.groupBy("lang", "number").agg(F.max("f").alias("cover"))
            # Of all longer phrases around one, those longer by a word occur most often.
            covered = F.coalesce(100 * F.col("cover") >= covered_pct * F.col("f"), F.lit(False))
            level = level.join(cover, ["lang", "number"], "left").filter(~covered)
        cuts = [
            F.struct(F.lit(k).alias("k"), F.element_at("heads", k).alias("l"), F.element_at("tails", length - k).alias("r"))
            for k in range(1, length)
        ]
        kept.append(level.select("lang", "words", F.col("f").alias("a"), F.array(*cuts).alias("cuts")))
    every = reduce(DataFrame.unionAll, kept).join(sizes, "lang")

    def scored(cut: Column) -> Column:
        upper = F.lit(1000).cast("decimal(4,0)") * _wide(F.col("a")) * _wide(F.col("n"))
        # Floors of equal scores are equal: div drops the rest.
        score = F.call_function("div", upper.cast("decimal(38,0)"), (_wide(cut["l"]) * _wide(cut["r"])).cast("decimal(38,0)"))
        return F.struct(score.alias("score"), cut["k"].alias("k"), cut["l"].alias("l"), cut["r"].alias("r"))

    best = F.array_min(F.transform("cuts", scored)).alias("best")
    chosen = every.select("lang", F.array_join("words", " ").alias("phrase"), "a", "n", best)
    return chosen.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
