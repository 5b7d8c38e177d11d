"""Documents that operators must handle without falling over."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, key string, size int, score string, n int, words string, c0 string"
EXTRA = ("own", 7, "extra", 3, "columns", "clash")


def a_text(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, near copies, short texts, odd characters."""
    rng = random.Random(5)
    base = a_text(rng, 200, 5000)
    near = base.replace(base.split()[100], "changed", 1)
    long = a_text(rng, 30_000, 4000)
    texts = [
        (1, base, "en"), (2, base, "en"), (3, near, "de"), (4, None, "en"), (5, "", None), (6, " \t\n ", "en"),
        (7, "one", "en"), (8, "one two", "de"), (8, "one two", "de"), (9, "ONE TWO three.\nONE TWO three.\n\n###", None),
        (None, base, "fr"), (None, None, None), (10, "Ünïcödé ß 日本語 \U0001f600 <|endoftext|> x", "de"),
        (11, long, "en"), (12, "head " + long + " tail", "en"), (13, "a" * 5000, "fr"), (-3, "é" * 301 + " z", "fr"),
        (14, " ".join(["same line here"] * 40), "en"), (15, a_text(rng, 80, 900), "en"), (16, a_text(rng, 70, 900), "de"),
        (2**62, a_text(rng, 60, 900), "en"), (17, "tab\tline\x0bfeed\x0cform\rreturn", "en"),
    ]
    return [(i, t, lang, None if i == 3 else "src", *EXTRA) for i, t, lang in texts]
