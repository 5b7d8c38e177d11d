"""Operators over the whole corpus against brute force: shards, decontamination, repeats, near duplicates."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_cases import EXTRA, SCHEMA, a_text

from starledger.llm import decontamination, near_duplicates, repeated_text, sharding


def pairs_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


# --- sharding ---


def test_differencing_balances_and_loses_nothing():
    rng = random.Random(3)
    for shards in (2, 3, 16):
        parts = [(rng.randrange(1, 1000),) for _ in range(500)]
        found = sharding.difference(parts, shards)
        assert sorted(i for members in found for i, _ in members) == list(range(500))
        sums = [sum(parts[i][j] for i, j in members) for members in found]
        assert max(sums) - min(sums) <= 3
    # 8 7 6 5 4: the textbook case, where differencing leaves 2 and the greedy rule 4.
    found = sharding.difference([(8,), (7,), (6,), (5,), (4,)], 2)
    assert sorted(sum((8, 7, 6, 5, 4)[i] for i, _ in m) for m in found) == [14, 16]
    assert sharding.difference([], 4) == [[], [], [], []]


@pytest.mark.parametrize("source", ["odd", "small"])
def test_shards_hold_groups_together_and_slots_have_no_gaps(source, request):
    docs = request.getfixturevalue(source)
    rows, shards = pairs_of(docs), 4
    found = sharding.shard(docs, shards=shards).collect()
    sized = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(sized)
    groups, sums, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in found:
        groups[r["text_crc32"], r["size"]].add(r["shard"])
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    sizes = Counter()
    for i, t in rows:
        sizes[t] += len((t or "").encode()) + 1
    empty = [k for k in groups if k[1] == 1]  # null and empty texts are two groups with one checksum
    assert all(len(g) == 1 for k, g in groups.items() if k not in empty)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(sizes.values())
    if largest <= sum(sizes.values()) / shards:
        assert max(sums.values()) - min(sums.values()) <= 0.02 * max(sums.values())
    else:  # a group above the mean has a shard of its own
        assert max(sums.values()) == largest
    assert sorted(map(tuple, sharding.shard(docs.repartition(7), shards=shards).select("doc_id", "shard").collect()), key=str) == sorted(
        ((r["doc_id"], r["shard"]) for r in found), key=str
    )
    assert sharding.shard(docs.limit(0)).count() == 0


# --- decontamination ---

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(docs, items, window):
    cut = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            cut[tuple(w[i : i + n])].add(item)
    out = Counter()
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(c) for c in cut}:
            for i in range(len(w) - n + 1):
                if (got := cut.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in got if x is not None}
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc, len(w), len(hit), len(found), listed, bool(hit)] += 1
    return out


ITEMS = [(1, "The quick-brown FOX jumps"), (10, "quick brown fox"), (2, "short"), (3, ""), (4, None), (None, "no id here at all"), (5, "É é é"), (1, "again the item one")]
CONTAMINATED = [
    (1, "x the QUICK brown fox jumps over the quick brown fox"), (2, "a short text, short!"), (3, None), (4, ""), (5, "é É é é"),
    (5, "É é é É é é"), (None, "no id here at all, no ID"), (6, "quick. brown"), (7, "short"), (7, "short"), (8, "clean words only"),
]


@pytest.mark.parametrize("limit", [1 << 26, 0])
@pytest.mark.parametrize("window", [3, 10])
def test_hits_equal_brute_force(shipped, limit, window):
    docs = shipped.createDataFrame([(i, t, "en", "s", *EXTRA) for i, t in CONTAMINATED], SCHEMA)
    items = shipped.createDataFrame([(i, t, 5) for i, t in ITEMS], "item_id bigint, text string, length int")
    got = Counter(map(tuple, decontamination.report(docs, items, window=window, broadcast_limit=limit).collect()))
    assert got == brute_hits(CONTAMINATED, ITEMS, window)
    clean = decontamination.decontaminate(docs, items, window=window, broadcast_limit=limit)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(k[0] for k, n in got.items() if not k[-1] for _ in range(n))
    cut = decontamination.decontaminate(docs, items, "spans", window=window, broadcast_limit=limit)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = dict(pairs_of(cut.filter("doc_id in (2, 6, 8)")))
    assert texts == {2: "a text!", 6: "quick. brown", 8: "clean words only"}


def test_hits_in_the_tables_and_in_nothing(shipped, odd, small, none):
    items = shipped.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    brute_items = [(r["item_id"], r["text"]) for r in items.collect()]
    for docs in (odd, small):
        got = Counter(map(tuple, decontamination.report(docs, items).collect()))
        assert got == brute_hits(pairs_of(docs), brute_items, 10)
    assert decontamination.report(none, items).count() == 0
    assert decontamination.report(odd, items.limit(0)).filter("contaminated").count() == 0


# --- repeated text ---


def brute_repeats(docs, length):
    seen, out = Counter(), Counter()
    texts = [(i, (t or "").encode()) for i, t in docs]
    for _, t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    for doc, t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i : i + length] = b"\x01" * length
        kept = bytes(b for b, c in zip(t, cover, strict=True) if not c)
        spans = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        out[doc, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def spliced(rng, n):
    """Texts of pieces from a small stock, so that repeats of every length and offset occur, overlaps and runs included."""
    stock = ["".join(rng.choice("abcß \n") for _ in range(rng.randrange(5, 120))) for _ in range(12)] + ["a" * 90, "ab" * 40]
    return [(i, "".join(rng.choice(stock)[rng.randrange(9) :] for _ in range(rng.randrange(1, 9)))) for i in range(n)]


@pytest.mark.parametrize(("length", "limit", "seed"), [(24, 1 << 26, 1), (40, 0, 2), (57, 1 << 26, 3), (100, 1 << 26, 4), (200, 1 << 26, 5)])
def test_repeats_equal_brute_force(shipped, length, limit, seed):
    rows = spliced(random.Random(seed), 120)
    docs = shipped.createDataFrame([(i, t, "en", "s", *EXTRA) for i, t in rows], SCHEMA).repartition(5)
    got = Counter(map(tuple, repeated_text.report(docs, length=length, broadcast_limit=limit).collect()))
    assert got == brute_repeats(rows, length)


def periodic(rng, length):
    """Texts little longer than ``length``, so that blocks reach over both ends, of a phrase said again and again: each
    phrase in a text of its own, and then phrases that several texts share, from different offsets and beside other bytes."""
    rows = []
    for n in range(160):
        phrase = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(1, 40))) + f"#{n} "
        for _ in range(1 if n < 100 else rng.randrange(2, 5)):
            size, skip = length + rng.randrange(63), rng.randrange(len(phrase))
            head, tail = ("".join(rng.choice("xyz") for _ in range(rng.choice([0, 0, 3, 9]))) for _ in range(2))
            body = (phrase * (2 * size))[skip : skip + size - len(head) - len(tail)]
            rows.append((len(rows), head + body + tail))
    return rows


@pytest.mark.parametrize(("length", "limit", "seed"), [(200, 1 << 26, 1), (200, 0, 2), (90, 1 << 26, 3)])
def test_repeats_of_short_periodic_texts_equal_brute_force(shipped, length, limit, seed):
    rows = [*periodic(random.Random(seed), length), (-1, " ".join(["same line here"] * 14))]
    docs = shipped.createDataFrame([(i, t, "en", "s", *EXTRA) for i, t in rows], SCHEMA).repartition(4)
    got = Counter(map(tuple, repeated_text.report(docs, length=length, broadcast_limit=limit).collect()))
    want = brute_repeats(rows, length)
    assert got == want and (length < 200 or any(k[0] == -1 and k[2] == 0 for k in want))


def test_repeats_in_odd_documents_and_in_nothing(odd, small, none):
    for docs in (odd, small):
        rows = [(i, t if t is None or len(t) < 100_000 else t) for i, t in pairs_of(docs)]
        got = Counter(map(tuple, repeated_text.report(docs).collect()))
        assert got == brute_repeats(rows, 200)
    assert repeated_text.report(none).count() == 0
    cut = repeated_text.remove_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    kept = dict(pairs_of(cut.filter("doc_id in (1, 4, 7)")))
    assert kept == {1: "", 4: None, 7: "one"}
    with pytest.raises(ValueError):
        repeated_text.report(odd, length=10)


# --- near duplicates ---


def brute_components(docs, words, pct):
    sets = []
    for _, t in docs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0d]+", w) if x]
        n = min(words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= pct * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        least[root(i)].append(doc)
    ids = [min([d for d in least[root(i)] if d is not None], default=None) for i in range(len(docs))]
    return Counter((doc, len(s), i) for (doc, _), s, i in zip(docs, sets, ids, strict=True))


def chains(rng):
    """Families of near copies whose members differ by a word more from each to the next, so that only chains link them."""
    rows = []
    for family in range(6):
        text = a_text(rng, rng.choice([8, 60, 150]), 3000).split()
        for step in range(12):
            rows.append((1000 - len(rows), " ".join(text)))
            text[(step * 5) % len(text)] = f"edit{family}x{step}"
    return rows + [(5000 + i, a_text(rng, 50, 3000)) for i in range(20)]


@pytest.mark.parametrize(("words", "pct", "rounds", "limit"), [(3, 85, 2, 1 << 26), (5, 80, 0, 0), (3, 60, 1, 1 << 26)])
def test_components_equal_brute_force(shipped, words, pct, rounds, limit):
    rows = chains(random.Random(words + pct))
    docs = shipped.createDataFrame([(i, t, "en", "s", *EXTRA) for i, t in rows], SCHEMA).repartition(4)
    found = near_duplicates.near_duplicates(docs, words=words, similarity_pct=pct, hub_rounds=rounds, broadcast_limit=limit)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == brute_components(rows, words, pct)


def test_components_of_odd_documents_and_of_nothing(odd, small, none):
    for docs in (odd, small):
        found = near_duplicates.near_duplicates(docs, words=3, similarity_pct=85).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(pairs_of(docs), 3, 85)
    assert near_duplicates.near_duplicates(none).count() == 0
    one = near_duplicates.keep_one(odd)
    assert one.columns == odd.columns
    ids = Counter(r["doc_id"] for r in one.collect())
    # one of the copies and near copies, one of the repeated row, one of the long pair, and all texts without words
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[8] == 1 and ids[11] + ids[12] == 1
    assert ids[4] == ids[5] == ids[6] == 1 and ids[None] == 1


def test_stars_give_components(shipped):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(50)]
    edges = [(a, b) for a, b in edges if a != b]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = near_duplicates.components(shipped.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent)


def test_bands_miss_next_to_nothing():
    for pct in (60, 80, 85, 95):
        rows = near_duplicates.band_rows(pct / 100)
        assert (1 - (pct / 100) ** rows) ** (160 // rows) <= 1e-7
    with pytest.raises(ValueError):
        near_duplicates.band_rows(0.05)
    numbers = near_duplicates._mix(np.arange(1, 1001, dtype=np.uint64))
    one, two = near_duplicates.minima([numbers[:900], numbers[100:]], 4000)
    assert abs(np.mean(one == two) - 0.8) < 0.03
