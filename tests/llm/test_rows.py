"""Operators that look at one text at a time: packing, token counts, rules, WARC."""

import base64
import gzip
import hashlib
import io
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starledger.llm import packing, quality_rules, token_counts, warc
from starledger.session import shared_folder


@pytest.fixture(scope="module")
def byte_level():
    return Tokenizer.from_file(packing.tokenizer_path())


@pytest.fixture(scope="module")
def word_level():
    return Tokenizer.from_file(token_counts.tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_binary_lengths():
    assert packing.binary_lengths(1) == [1]
    assert packing.binary_lengths(2048 + 512 + 5) == [1024, 1024, 512, 4, 1]
    for n in range(1, 5000, 37):
        found = packing.binary_lengths(n)
        assert sum(found) == n and found == sorted(found, reverse=True) and len(set(found) - {1024}) == len([x for x in found if x < 1024])


@pytest.mark.parametrize("source", ["odd", "small"])
def test_packing_is_an_exact_cut_of_the_ids(source, request, byte_level):
    docs = request.getfixturevalue(source)
    rows = packing.pack(docs).collect()
    texts = [r["text"] for r in docs.select("text").collect()]
    want = Counter(tuple([*ids_of(byte_level, t), 0]) for t in texts)
    runs, current = [], None
    for r in sorted(rows, key=lambda r: r["sequence_id"]):
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024 and r["offset"] == 0
        if r["start"] == 0:
            current = []
            runs.append(current)
        assert len(current) == r["start"]
        current.extend(ids.tolist())
        if r["start"] + r["length"] == r["doc_tokens"]:
            assert len(current) == r["doc_tokens"]
    assert Counter(map(tuple, runs)) == want
    assert len({r["sequence_id"] for r in rows}) == len(rows)


def test_packing_of_nothing_and_bad_length(none):
    assert packing.pack(none).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(none, longest=1000)


def test_encoder_equals_the_library_on_odd_texts(byte_level):
    encoder = packing.Encoder(packing.tokenizer_path())
    assert encoder.fast is not None
    for text in ["  x  y\n\n z", "don't  DON'T", "ſ K ʼ", "à ́", "١٢٣ ½ ²", "ꟸ Ꟶ 𞤀", " " * 3000, "ab" * 3000, "\x00\x1c\x85\xa0", "<|endoftext|>a"]:
        assert encoder.encode(text) == ids_of(byte_level, text), text[:20]


@pytest.mark.parametrize("source", ["odd", "small"])
def test_token_counts_equal_the_library(source, request, word_level):
    docs = request.getfixturevalue(source)
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r[0], len((r[1] or "").encode()), n := len(ids_of(word_level, r[1])), n > 2048) for r in rows)
    assert Counter(map(tuple, token_counts.count_tokens(docs).collect())) == want


def test_whole_tokens_are_proven_and_memory_is_bounded(word_level, none, monkeypatch):
    whole = token_counts.whole_tokens(token_counts.tokenizer_path())
    assert "the" in whole and len(whole) > 10_000 and all(len(ids_of(word_level, t)) == 1 for t in list(whole)[:500])
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    counter = token_counts.Counter(token_counts.tokenizer_path(), whole)
    text = "qzxv wzkjq zzqpx qqqzx vvvzz the qzxv Ωmegà ΑΣ don't"
    for _ in range(3):
        assert counter.count(text) == len(ids_of(word_level, text))
    assert token_counts.count_tokens(none).count() == 0


def test_long_pieces_are_counted_but_not_remembered(word_level):
    counter = token_counts.Counter(token_counts.tokenizer_path(), token_counts.whole_tokens(token_counts.tokenizer_path()))
    before = len(counter.known)
    for text in ["日本語の文" * 400, "qzx" * 500 + " the " + "日本語" * 30 + " the", "#" * 3000]:
        for _ in range(2):
            assert counter.count(text) == len(ids_of(word_level, text))
    assert len(counter.known) == before


def brute_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("source", ["odd", "small"])
def test_rules_count_as_brute_force(source, request):
    docs = request.getfixturevalue(source)
    want = Counter((r[0], *brute_counts(r[1])) for r in docs.select("doc_id", "text").collect())
    judged = quality_rules.judge(docs).collect()
    assert Counter((r["doc_id"], *(r[c] for c in quality_rules.COUNTS)) for r in judged) == want
    for r in judged:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"]) and 0 <= r["posterior"] <= 1
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_rules_keep_good_documents_without_labels(shipped):
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.judge(shipped.read.parquet(f"{folder}/documents.parquet"))
    labels = shipped.read.parquet(f"{folder}/labels.parquet")
    rows = judged.filter(~F.col("base_failed")).join(labels, "doc_id").collect()
    good, bad = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_estimate_finds_how_often_rules_see_junk(shipped):
    rng = np.random.default_rng(1)
    good = rng.random(6000) < 0.8
    sees = {"sharp": 0.8, "fair": 0.4, "also": 0.6}
    votes = {k: np.where(good, rng.random(6000) < 0.01, rng.random(6000) < p) for k, p in sees.items()}
    rows = [tuple(int(x) for x in row) for row in np.column_stack([np.where(v, -1, 0) for v in votes.values()] + [np.zeros(6000)])]
    table = shipped.createDataFrame(rows, "sharp int, fair int, also int, mute int")
    model = quality_rules.estimate(table, ["sharp", "fair", "also", "mute"])
    assert abs(model.good - 0.8) < 0.05
    assert all(abs(model.on_bad[k][-1] - p) < 0.1 and model.on_good[k][-1] < 0.03 for k, p in sees.items())
    assert model.accuracy("sharp")[-1] > 0.9


PAGES = [
    (1, "http://a/ b\r\nX: y", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "u", None), (4, "u", ""), (5, "ü", "ß" * 70_000),
    (None, "n", "<p>same</p>"), (None, "n", "alone"), (6, "u", "WARC/1.1\r\n\r\nnested\r\n\r\n"), (6, "u", "WARC/1.1\r\n\r\nnested\r\n\r\n"),
    (-7, "u", "last"), (8, "u", "last"), (2**60, "u", "last"),
]


def expected_pages(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(html or "")
        revisit = to is not None and i != to and len(data) >= least
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[i, len(data), digest, "revisit" if revisit else "response", to if revisit else None] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_limit": 0}, {"revisit_from": 5}, {"revisit_from": 5, "broadcast_limit": 0}, {"file_bytes": 1, "shard_bytes": 1000}])
def test_archives_round_trip(shipped, options):
    pages = shipped.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id bigint, url string, html string, digest string, shard int")
    folder = shared_folder(shipped, "warc-test")
    warc.write_archives(pages, folder, **options)
    back = warc.read_archives(shipped, folder).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r[c] for c in columns) for r in back) == expected_pages(PAGES, options.get("revisit_from", 0))
    kept = Counter((r["page_id"], r["payload"].decode()) for r in back if r["record_type"] == "response")
    assert all((i, text) in {(p[0], p[2] or "") for p in PAGES} for i, text in kept)
    assert all("\n" not in r["url"] and " " not in r["url"] for r in back)


def test_archives_are_the_same_on_every_run(shipped):
    pages = shipped.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = []
    for parts in (1, 5):
        folder = shared_folder(shipped, "warc-test")
        warc.write_archives(pages.repartition(parts), folder, file_bytes=20_000, shard_bytes=60_000)
        manifest = sorted(map(tuple, shipped.read.parquet(f"{folder}/manifest").collect()))
        assert len(manifest) > 2
        data = "".join(r[4] for r in manifest)
        found.append((manifest, data))
    assert found[0] == found[1]


def test_archives_of_no_pages_and_damage(shipped):
    pages = shipped.createDataFrame([], "page_id bigint, url string, html string")
    folder = shared_folder(shipped, "warc-test")
    warc.write_archives(pages, folder)
    assert warc.read_archives(shipped, folder).count() == 0
    data = warc.record(1, "u", b"payload", None)
    assert list(warc.members(io.BytesIO(gzip.compress(data) + gzip.compress(b"2")), chunk=7)) == [data, b"2"]
    fields, http, payload = warc.parse(data)
    assert payload == b"payload" and fields["WARC-Type"] == "response" and http["Content-Length"] == "7"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload", b"pay1oad"))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(gzip.compress(data)[:-9])))
