"""Byte-level BPE, ranked search and collocations against brute force, on odd rows and on random ones."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import tiktoken
from odd_cases import odd_rows

from starledger.llm import byte_bpe, collocations, norm_search

# --- byte-level BPE ---


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(byte_bpe.ranks_path())
    return tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def packed(library, text):
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


def strange_texts(n=60):
    rng = random.Random(3)
    parts = ["a", "don't", "we'll", "'", "''s", " ", "  ", "\n\n", "\t", "12", "³", "é", "日本", "\U0001f600", "!?", "　", "\x00", "ʼ", "՘"]
    for _ in range(n):
        yield "".join(rng.choice(parts) * rng.choice([1, 1, 1, 2, 5]) for _ in range(rng.randrange(400)))
    yield "x" * 3000 + " y"
    yield " " * 2000 + "y" + "\n" * 500
    yield "'" * 700 + "ll" * 300


@pytest.mark.parametrize("chunk, overlap", [(32, 8), (100, 40), (65_536, 2_048)])
def test_ids_are_those_of_the_library(shipped, library, chunk, overlap):
    texts = [*strange_texts(), None, "", *list(strange_texts(5)) * 20]
    docs = shipped.createDataFrame([(None if i == 3 else i // 2, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found = byte_bpe.decode(byte_bpe.encode(docs, chunk=chunk, overlap=overlap)).collect()
    expected = Counter((None if i == 3 else i // 2, packed(library, t), (t or "").encode()) for i, t in enumerate(texts))
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in found) == expected
    assert all(4 * r["n_tokens"] == len(r["ids"]) for r in found)


def test_odd_rows_are_encoded(odd, none, library):
    found = byte_bpe.encode(odd, chunk=1000, overlap=100).collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in found) == Counter((r[0], packed(library, r[1])) for r in odd_rows())
    assert byte_bpe.decode(byte_bpe.encode(none)).collect() == []


def test_merges_and_classes_follow_the_library(library):
    encoder = byte_bpe.Encoder(byte_bpe.ranks_path(), byte_bpe.default_pattern())
    rng = random.Random(1)
    for _ in range(300):
        piece = "".join(rng.choice("abcdeéß語") for _ in range(rng.randrange(1, 200)))
        assert byte_bpe.merge(piece.encode(), encoder.ranks) == library.encode_ordinary(piece)
    differing = "".join(rng.sample(sorted(encoder.unlike_chars), min(500, len(encoder.unlike_chars))))
    text = "".join(f"a{c}1 {c}" for c in differing)
    assert encoder.encode(text) == packed(library, text)


def test_ids_without_tokens_fail_and_null_ids_stay_null(shipped):
    made = shipped.createDataFrame([(1, 0, bytearray()), (2, None, None)], "doc_id int, n_tokens bigint, ids binary")
    assert {r["doc_id"]: r["decoded"] for r in byte_bpe.decode(made).collect()} == {1: bytearray(), 2: None}
    wrong = shipped.createDataFrame([(1, 1, bytearray(b"\xff\xff\xff\xff"))], "doc_id int, n_tokens bigint, ids binary")
    with pytest.raises(Exception, match="KeyError"):
        byte_bpe.decode(wrong).collect()


# --- ranked search ---


def brute_search(docs, items, top):
    terms = {i: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, (_, t) in enumerate(docs)}
    n_docs, n_terms = sum(bool(t) for t in terms.values()), sum(map(len, terms.values()))
    df = Counter(t for found in terms.values() for t in set(found))
    out = Counter()
    for item, text in items:
        asked = set(re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        scored = []
        for i, (doc, _) in enumerate(docs):
            tf, n = Counter(terms[i]), len(terms[i])
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * (50 + (50 * n * n_docs) // n_terms)))
                for t in asked
                if tf[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc if doc is not None else 0))
        for rank, (score, missing, doc) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, None if missing else doc, -score] += 1
    return out


@pytest.fixture(scope="module")
def searched():
    rng = random.Random(11)
    vocabulary = [f"t{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 30, 200])))) for i in range(600)]
    docs += [(1000 + i, docs[5][1]) for i in range(120)] + [docs[7]] * 60 + [(None, docs[9][1]), (2000, None), (2001, ""), (2002, "--")]
    items = [(f"i{i}", " ".join(rng.choices(vocabulary, k=20)).upper()) for i in range(30)]
    items += [("copy", items[0][1]), ("copy", items[0][1]), (None, items[1][1]), ("none", None), ("empty", "?!"), ("new", "neverseen")]
    return docs, items


@pytest.mark.parametrize("top, query_bytes, rows", [(50, 8 << 20, 512), (5, 300, 16), (1, 8 << 20, 16)])
def test_search_finds_the_best(shipped, monkeypatch, searched, top, query_bytes, rows):
    monkeypatch.setattr(norm_search, "BUCKET_ROWS", rows)
    monkeypatch.setattr(norm_search, "FIRST_BUCKET", 64)
    docs, items = searched
    d = shipped.createDataFrame([(t, i, "x") for i, t in docs], "text string, doc_id bigint, rank string").repartition(5)
    i = shipped.createDataFrame([(t, i, 1) for i, t in items], "text string, item_id string, score int")
    found = norm_search.search(d, i, top=top, query_bytes=query_bytes).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found) == brute_search(docs, items, top)


def test_bounds_prune_and_lose_nothing(searched):
    """Vectors that the bounds drop are below the bound when scored in full."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    cells = rng.integers(0, 1000, (40, 300)) * (rng.random((40, 300)) < 0.2)
    cells[0, :] += 1
    terms = [np.flatnonzero(c).astype("<i4") for c in cells.T]
    batch = pa.RecordBatch.from_pydict(
        {
            "doc_id": list(range(300)),
            "norm": np.sqrt((cells.astype(float) ** 2).sum(axis=0)),
            "terms": [t.tobytes() for t in terms],
            "impacts": [c[t].astype("<i8").tobytes() for c, t in zip(cells.T, terms, strict=True)],
        }
    )
    queries = [np.sort(rng.choice(40, 12, replace=False)) for _ in range(20)]
    scores = [cells[q].sum(axis=0) for q in queries]
    bounds = np.array([np.sort(s)[-10] for s in scores])
    found = norm_search._Best(queries, bounds.copy(), 10)
    found.add(norm_search._Bucket(batch, 40))
    for best, s, bound in zip(found.best, scores, bounds, strict=True):
        assert best == sorted((-int(x), False, i) for i, x in enumerate(s) if x >= bound)[:10]


def test_search_of_odd_rows(odd, none, shipped):
    items = shipped.createDataFrame([(1, "one two W1 w2 日本語"), (2, None)], "item_id int, text string")
    found = norm_search.search(odd, items).collect()
    expected = brute_search([(r[0], r[1]) for r in odd_rows()], [(1, "one two W1 w2 日本語")], 50)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found) == expected
    assert norm_search.search(none, items).collect() == []
    assert norm_search.search(odd, items.limit(0)).collect() == []
    assert norm_search.search(odd, odd, item_id="doc_id", item_text="lang", top=2).schema.fieldNames() == ["item_id", "rank", "doc_id", "score"]


# --- collocations ---


def brute_collocations(rows, longest, least, covered_pct, top):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    covered = set()
    for (lang, phrase), a in candidates.items():
        for k in range(2, len(phrase)):
            for i in range(len(phrase) - k + 1):
                if 100 * a >= covered_pct * counts[lang, phrase[i : i + k]]:
                    covered.add((lang, phrase[i : i + k]))
    out = {}
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) not in covered:
            cuts = []
            for k in range(1, len(phrase)):
                left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
                cuts.append((math.floor(Fraction(1000 * a * sizes[lang], left * right)), k, left, right))
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, sizes[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    }


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize(
    "slice_words, longest, least, covered_pct, top, limit",
    [(7, 5, 3, 100, 2000, 0), (7, 5, 3, 100, 2000, 1 << 20), (1_000_000, 5, 2, 60, 40, 1 << 20), (50, 3, 4, 100, 10, 0)],
)
def test_collocations_are_those_of_plain_counting(shipped, monkeypatch, slice_words, longest, least, covered_pct, top, limit):
    monkeypatch.setattr(collocations, "TILE", 4)
    rng = random.Random(slice_words)
    vocabulary = ["Rome", "É", "a", "of", "x y", "new", "york", "the", "\x00", "日本"]
    rows = []
    for _ in range(120):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ",", ". ", "\n", "\t"]) for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "en", "de", None, "und"]), " ".join(words)))
    rows += [("en", None), (None, None), ("fr", ""), ("fr", " ., "), ("en", "new york " * 300)] + [("de", "of the new york a")] * 40
    docs = shipped.createDataFrame([(t, lang, i, "s") for i, (lang, t) in enumerate(rows)], "text string, lang string, n int, symbol string")
    found = collocations.collocations(
        docs.repartition(3), "text", "lang", longest, least, covered_pct, top, slice_words, broadcast_limit=limit
    )
    assert found.columns == COLUMNS
    assert set(map(tuple, found.collect())) == brute_collocations(rows, longest, least, covered_pct, top)


def test_collocations_of_odd_rows(odd, none):
    found = set(map(tuple, collocations.collocations(odd, least=20, slice_words=1000).collect()))
    assert found == brute_collocations([(r[2], r[1]) for r in odd_rows()], 5, 20, 100, 2000) and found
    assert collocations.collocations(none).collect() == []


def test_dense_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(4)
    left, right = (np.minimum(rng.zipf(1.3, 20_000) - 1, 700).astype(np.int64) for _ in range(2))
    codes, counts = collocations.pair_counts(left, right, tile=64)
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == Counter(((left << 32) | right).tolist())
    assert codes.tolist() == sorted(codes.tolist())
    assert [len(x) for x in collocations.pair_counts(left[:0], right[:0])] == [0, 0]


