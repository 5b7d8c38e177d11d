"""The whole pipeline against the same chain in plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from test_corpus import brute_components, brute_hits
from test_queries import brute_bits
from tokenizers import Tokenizer

import corpus_pipeline
from starledger.llm import packing
from starledger.session import shared_folder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents():
    rng = random.Random(6)
    words = {
        lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(300)]
        for lang, letters in (("en", "abcdefghijklm"), ("de", "noprstuäöüß"))
    }

    def said(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))

    texts = [(said(lang, rng.randrange(20, 120)), lang) for lang in ("en", "de") for _ in range(25)]
    base, passage, item = said("en", 120), said("de", 60), said("en", 14)
    texts += [(base, "en"), (base, None), (base + " end", "en"), (said("de", 30) + " " + passage, "de"), (passage + " " + said("de", 40), "de")]
    texts += [(said("en", 20) + " " + item.upper() + " " + said("en", 20), "en"), ("".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(150)), None)]
    texts += [(" ".join(["madge lid cafe"] * 14), None), ("12 34 56", "en"), ("", None), (None, "de"), ("abc", None)]
    return [(7 * i + 3, t, lang, "src", len(t or "")) for i, (t, lang) in enumerate(texts)], item


def brute_language(rows):
    counts = defaultdict(Counter)
    for i, t, lang, *_ in rows:
        if lang and t and zlib.crc32(str(i).encode()) % 5:
            data = b"\n" * 4 + t.lower().encode()
            counts[lang].update(data[k - n : k + 1] for k in range(4, len(data)) for n in range(5))
    trees = {lang: defaultdict(dict) for lang in counts}
    for lang, found in counts.items():
        for gram, n in found.items():
            if len(gram) < 4 or n > 1:
                trees[lang][gram[:-1]][gram[-1]] = n
    fits = lambda t: min(brute_bits(t, tree) for tree in trees.values()) <= 8 * len(t.encode()) + 64
    return [(r[0], r[1]) for r in rows if r[1] and re.search(r"[^\W\d_]", r[1]) and fits(r[1])]


def brute_cut(docs, length=200):
    seen = Counter(t[i : i + length] for t in (t.encode() for _, t in docs) for i in range(len(t) - length + 1))
    out = []
    for doc, text in docs:
        t = text.encode()
        gone = {k for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1 for k in range(i, i + length)}
        out.append((doc, bytes(b for k, b in enumerate(t) if k not in gone).decode("utf-8", "ignore")))
    return out


def brute_pieces(n):
    while n:
        piece = min(1024, 1 << (n.bit_length() - 1))
        yield piece
        n -= piece


def test_run_equals_plain_python(shipped):
    rows, item = documents()
    folder, items = shared_folder(shipped, "pipeline-test"), [(1, item), (2, "not in any of them")]
    shipped.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    shipped.createDataFrame([(i, t, len(t)) for i, t in items], "item_id bigint, text string, length int").write.parquet(f"{folder}/benchmark.parquet")

    spoken = brute_language(rows)
    own = {doc for doc, _, component in brute_components(spoken, 5, 80) if doc == component}
    single = [r for r in spoken if r[0] in own]
    cut = brute_cut(single)
    hits = {h[0] for h in brute_hits(cut, items, 10) if h[-1]}
    clean = [r for r in cut if r[0] not in hits]
    # Every stage has something to do, and the periodic text comes through whole.
    assert len(rows) > len(spoken) > len(single) > len(clean) and cut != single
    assert " ".join(["madge lid cafe"] * 14) in {t for _, t in clean}

    tokenizer, want = Tokenizer.from_file(packing.tokenizer_path()), Counter()
    for doc, text in clean:
        ids, start = [*tokenizer.encode(text, add_special_tokens=False).ids, 0], 0
        for n in brute_pieces(len(ids)):
            want[doc, start, tuple(ids[start : start + n])] += 1
            start += n
    got = corpus_pipeline.run(shipped, folder).collect()
    assert Counter((r["doc_id"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
