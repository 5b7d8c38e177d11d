"""Quality rules under weak supervision.

Each rule looks at a document and votes good, bad, or abstains. No rule decides alone: expectation-maximisation over the
votes of all documents estimates how often each rule is right on good and on bad ones, without any label, and a document
is kept by its posterior probability of being good. Documents enter the estimate as counts of vote patterns, of which
there are at most three to the number of rules, however many documents there are. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import let, written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MOST_REPEATED_PCT = 50
# On the given labels this loses fewer good documents than 0.5 and keeps no more bad ones; the README has the shares.
KEEP_FROM = 0.02
# Iterations at most, and the change in the share of good documents at which they end.
ITERATIONS, SETTLED = 30, 1e-6
GOOD, BAD, ABSTAIN = 1, -1, 0
VOTES = (GOOD, BAD, ABSTAIN)
# Where estimation starts: most documents are good, and a bad vote is rare on good ones. A rule may never come to be seen
# as one that often blames good documents, which is what tells the two classes apart without labels.
START_GOOD, START_BAD_ON_GOOD, START_BAD_ON_BAD = 0.8, 0.01, 0.3
MOST_BAD_ON_GOOD = 0.05
SMOOTHING = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE_COUNTS = ["n_lines", "n_ended_lines", "n_upper", "n_marks", "n_distinct_words", "n_bare_words", "n_symbol_words"]


def _count_of(text: Column, pattern: str) -> Column:
    """How many characters of the class occur."""
    return (F.size(F.split(text, pattern)) - 1).cast("bigint")


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice. Windows are sorted, so equal ones are neighbours."""

    def window(i: Column) -> Column:
        # The hash comes first because most comparisons then end there; the words decide.
        three = F.slice(words, i + 1, 3)
        return F.struct(F.xxhash64(three).alias("hash"), three.alias("words"), i.alias("start"))

    def starts(found: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            before, after = F.get(found, k - 1), F.get(found, k + 1)
            same = [
                F.coalesce((y.getField("hash") == x.getField("hash")) & (y.getField("words") == x.getField("words")), F.lit(False))
                for y in (before, after)
            ]
            return same[0] | same[1]

        return F.sort_array(F.transform(F.filter(found, repeated), lambda x: x.getField("start")))

    def covered(found: Column) -> Column:
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

        def add(done: Column, start: Column) -> Column:
            fresh = start + 3 - F.greatest(start, done.getField("end"))
            return F.struct((start + 3).alias("end"), (done.getField("n") + fresh).alias("n"))

        return F.aggregate(found, zero, add, lambda done: done.getField("n"))

    places = F.sequence(F.lit(0), F.size(words) - 3)
    counted = let(F.sort_array(F.transform(places, window)), lambda found: let(starts(found), covered))
    # Where all hashes differ, as in most texts, so do all windows, and nothing needs to be sorted.
    hashes = let(
        F.transform(words, lambda word: F.xxhash64(word)),
        lambda each: F.transform(places, lambda i: F.xxhash64(F.get(each, i), F.get(each, i + 1), F.get(each, i + 2))),
    )
    none = F.lit(0).cast("bigint")
    some = let(hashes, lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), none).otherwise(counted))
    return F.when(F.size(words) >= 3, some).otherwise(none)


def text_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and what the rules look at, as counts; a null text has no words and counts of 0."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), value.alias("text"))
    split = rows.select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    ended = F.filter("lines", lambda line: line.rlike(r"[.!?\"'”’»…。！？][\x20\x09-\x0D]*$"))
    bare = F.filter("words", lambda word: ~word.rlike(r"[\p{L}\p{N}]"))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": _count_of(F.col("text"), SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(F.col("words")),
        "n_lines": F.size("lines"),
        "n_ended_lines": F.size(ended),
        "n_upper": _count_of(F.col("text"), r"\p{Lu}"),
        "n_marks": _count_of(F.col("text"), r"[!?]"),
        "n_distinct_words": F.size(F.array_distinct("words")),
        "n_bare_words": F.size(bare),
        "n_symbol_words": F.size(F.filter("words", lambda word: word.rlike(SYMBOLS))),
    }
    return split.select("doc_id", *[c.cast("bigint").alias(name) for name, c in counts.items()])


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def votes() -> dict[str, Column]:
    """The rules over ``text_counts``. Where a document has nothing to look at, a rule abstains.

    Each kind of junk (symbols, capitals, repetition, lists, fragments) is seen by two rules at least, so that they can
    bear each other out.
    """
    words, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")

    def rate(count: str, of: Column, good_to: float, bad_from: float) -> Column:
        """Good up to a share, bad from a higher one on, nothing in between or of nothing."""
        n = F.col(count).cast("double")
        return _vote((of > 0) & (n <= good_to * of), (of > 0) & (n >= bad_from * of))

    return {
        "length": _vote(words >= 2 * MIN_WORDS, words < MIN_WORDS),
        "symbols": rate("n_symbols", chars, 0.01, 0.05),
        "upper_case": rate("n_upper", chars, 0.10, 0.35),
        "marks": rate("n_marks", words, 0.03, 0.20),
        "repeated_lines": _vote((lines >= 3) & (F.col("n_dup_lines") == 0), (lines > 1) & (F.col("n_dup_lines") >= 0.3 * lines)),
        "repeated_words": rate("n_repeat_words", words, 0.15, 0.45),
        "ended_lines": _vote((lines > 0) & (F.col("n_ended_lines") >= 0.8 * lines), (lines > 1) & (F.col("n_ended_lines") <= 0.4 * lines)),
        "word_length": _vote((words > 0) & chars.between(3 * words, 9 * words), (words > 0) & ~chars.between(2 * words, 14 * words)),
        "variety": _vote((words >= 20) & (F.col("n_distinct_words") >= 0.35 * words), (words >= 20) & (F.col("n_distinct_words") < 0.15 * words)),
        "bare_words": rate("n_bare_words", words, 0.01, 0.15),
        "symbol_words": rate("n_symbol_words", words, 0.01, 0.10),
    }


@dataclass
class LabelModel:
    """The share of good documents, and how often each rule votes how on good and on bad ones.

    ``on_good[rule][vote]`` and ``on_bad[rule][vote]`` add up to 1 over the three votes.
    """

    good: float
    on_good: dict[str, dict[int, float]]
    on_bad: dict[str, dict[int, float]]

    def posterior(self) -> Column:
        """The probability of being good given the votes in the rules' columns; votes count as independent."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule, on_good in self.on_good.items():
            weight = {v: math.log(p / self.on_bad[rule][v]) for v, p in on_good.items()}
            vote = F.col(rule)
            odds = odds + F.when(vote == GOOD, weight[GOOD]).when(vote == BAD, weight[BAD]).otherwise(weight[ABSTAIN])
        return 1 / (1 + F.exp(-odds))

    def accuracy(self, rule: str) -> dict[int, float]:
        """How often the rule is right when it votes good, and when it votes bad."""
        g, b = self.good, 1 - self.good
        on_good, on_bad = self.on_good[rule], self.on_bad[rule]
        return {
            GOOD: g * on_good[GOOD] / (g * on_good[GOOD] + b * on_bad[GOOD]),
            BAD: b * on_bad[BAD] / (g * on_good[BAD] + b * on_bad[BAD]),
        }


def estimate(voted: DataFrame, rules: list[str], iterations: int = ITERATIONS) -> LabelModel:
    """Fit the label model to the votes of all rows.

    Documents of one vote pattern are counted first; the patterns, at most 3 to the power of the rules, are what the
    iterations run over. An empty table leaves the model where estimation starts.
    """
    patterns = written(voted.groupBy(*rules).agg(F.count("*").alias("n")), "vote-patterns").coalesce(1).cache()
    p, n = F.col("p"), F.col("n")

    def sums(share: dict[str, Column]) -> dict:
        parts = {"all": F.sum(n)}
        for kind, of in share.items():
            parts[kind] = F.sum(n * of)
            for i, rule in enumerate(rules):
                for vote in VOTES:
                    parts[f"{kind}_{i}_{vote}"] = F.sum(F.when(F.col(rule) == vote, n * of).otherwise(0.0))
        return patterns.withColumn("p", model.posterior()).agg(*[v.alias(k) for k, v in parts.items()]).first().asDict()

    def smoothed(got: dict, kind: str, i: int) -> dict[int, float]:
        return {v: (got[f"{kind}_{i}_{v}"] + SMOOTHING) / (got[kind] + SMOOTHING * len(VOTES)) for v in VOTES}

    def with_bad(shares: dict[int, float], bad: float) -> dict[int, float]:
        """The same shares with that of bad votes set, the other two in proportion."""
        rest = shares[GOOD] + shares[ABSTAIN]
        return {v: bad if v == BAD else (1 - bad) * shares[v] / rest for v in VOTES}

    even = {rule: dict.fromkeys(VOTES, 1 / len(VOTES)) for rule in rules}
    model = LabelModel(START_GOOD, even, even)
    got = sums({"every": F.lit(1.0)})
    if not got["all"]:
        patterns.unpersist()
        return model
    overall = {rule: smoothed(got, "every", i) for i, rule in enumerate(rules)}
    model = LabelModel(
        START_GOOD,
        {r: with_bad(s, START_BAD_ON_GOOD) for r, s in overall.items()},
        {r: with_bad(s, START_BAD_ON_BAD) for r, s in overall.items()},
    )
    for _ in range(iterations):
        got = sums({"good": p, "bad": 1 - p})
        on_good = {r: smoothed(got, "good", i) for i, r in enumerate(rules)}
        before = model.good
        model = LabelModel(
            min(max(got["good"] / got["all"], 0.01), 0.99),
            {r: with_bad(s, min(s[BAD], MOST_BAD_ON_GOOD)) for r, s in on_good.items()},
            {r: smoothed(got, "bad", i) for i, r in enumerate(rules)},
        )
        if abs(model.good - before) < SETTLED:
            break
    patterns.unpersist()
    return model


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    most_repeated_pct: int = MOST_REPEATED_PCT,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """``doc_id``, the counts, the votes, ``base_failed``, ``posterior`` and ``kept`` for every row of ``docs``.

    A document of fewer than ``min_words`` words, or with more than ``most_repeated_pct`` percent of its words in
    repeated windows, fails the base and isn't kept, so an empty or null text never is. Every other is kept if its
    posterior reaches ``keep_from``. Repeated rows are judged alike, each by itself.
    """
    rules = votes()
    counted = written(text_counts(docs, doc_id, text).select("*", *[v.alias(k) for k, v in rules.items()]), "quality-votes")
    model = estimate(counted, list(rules))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated_pct * F.col("n_words"))
    judged = counted.withColumns({"base_failed": failed, "posterior": model.posterior()})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
