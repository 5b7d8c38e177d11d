"""The registered queries: against SQL where there is some, and by accuracy where models decide."""

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starledger.llm import common, language_id, near_duplicates, packing, quality_classifier, queries
from starledger.llm.common import held_out

FOLDER = "/root/testdata/sf0.01"
QUERIES, ORACLES = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_same_as_sql(shipped, duck, name):
    ours = QUERIES[name](shipped, FOLDER).toArrow()
    theirs = duck.sql(ORACLES[name]).to_arrow_table().select(ours.column_names)
    assert [str(f.type).replace("large_", "") for f in ours.schema] == [str(f.type).replace("large_", "") for f in theirs.schema]
    assert Counter(zip(*ours.to_pydict().values(), strict=True)) == Counter(zip(*theirs.to_pydict().values(), strict=True))


def test_all_queries_are_registered():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


def test_held_out_is_every_fifth_by_checksum(shipped):
    import zlib

    rows = shipped.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


# --- language identification ---


def brute_bits(text, counts):
    """Bits of a text under plain dictionaries of counts by context."""
    data, total = b"\n" * 4 + text.lower().encode(), 0.0
    for i in range(4, len(data)):
        for n in range(4, -1, -1):
            seen = counts.get(data[i - n : i], {})
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[i] in seen:
                total -= math.log2(seen[data[i]] / whole)
                break
            total -= math.log2(len(seen) / whole)
        else:
            total += 8
    return total


def test_code_lengths_equal_plain_trees():
    rng = random.Random(4)
    samples = {k: ["".join(rng.choice(letters) for _ in range(90)) for _ in range(5)] for k, letters in (("x", "abc dé"), ("y", "abz d"))}
    plain, counts = {}, {}
    for lang, texts in samples.items():
        plain[lang] = defaultdict(Counter)
        tables = [Counter() for _ in range(6)]
        for t in texts:
            data = b"\n" * 4 + t.encode()
            for i in range(4, len(data)):
                for n in range(5):
                    plain[lang][data[i - n : i]][data[i]] += 1
                    tables[n + 1][int.from_bytes(data[i - n : i + 1])] += 1
        for n in range(1, 6):
            grams = np.array(sorted(tables[n]), np.int64)
            counts[lang, n] = grams, np.array([tables[n][g] for g in grams.tolist()], np.int64)
    trees = language_id.grow(["x", "y"], counts)
    texts = ["abc dé abc", "zzz", "Q", "é", "abzd" * 50, "日本", "d c b a"]
    want = np.array([[brute_bits(t, plain[k]) for k in ("x", "y")] for t in texts])
    assert np.allclose(language_id.code_lengths(texts, trees), want, rtol=1e-4)


def test_languages_of_held_out_documents(shipped):
    docs = shipped.read.parquet(f"{FOLDER}/documents.parquet")
    found = QUERIES["op8_ppm_language_id"](shipped, FOLDER).join(docs, "doc_id").filter("held_out").collect()
    assert len(found) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_documents(shipped, odd, none):
    trees = language_id.train(odd)
    rows = language_id.identify(odd, trees).collect()
    texts = Counter(r["doc_id"] for r in odd.select("doc_id").collect())
    assert Counter(r["doc_id"] for r in rows) == texts
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (4, 5, 6))
    assert all(r["lang_pred"] in {*trees.languages, "und"} for r in rows)
    kept = language_id.in_a_language(odd, trees)
    assert kept.columns == odd.columns
    assert {1, 7, 15} <= {r["doc_id"] for r in kept.collect()} and kept.filter("doc_id in (4, 5, 6)").count() == 0
    untaught = language_id.train(none)
    assert untaught.languages == [] and {r["lang_pred"] for r in language_id.identify(odd, untaught).collect()} == {"und"}
    assert language_id.identify(none, trees).count() == 0


def test_a_language_of_long_texts_only_is_learned(shipped):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("abcd ") for _ in range(300)), "short") for i in range(20)]
    rows += [(100 + i, "".join(rng.choice("日本語éß ") for _ in range(30_000)), "long") for i in range(8)]
    docs = shipped.createDataFrame(rows, "doc_id bigint, text string, lang string")
    trees = language_id.train(docs)
    assert trees.languages == ["long", "short"]
    assert {(r["lang_pred"] == "long", r["doc_id"] >= 100) for r in language_id.identify(docs, trees).collect()} == {(True, True), (False, False)}
    assert language_id.in_a_language(docs, trees).count() == len(rows)
    cut = docs.select("text", common.text_start("text", 1001).alias("start")).collect()
    assert all(r["text"].startswith(r["start"]) for r in cut)
    assert all(r["start"] == r["text"] if len(r["text"]) == 300 else 996 <= len(r["start"].encode()) <= 1001 for r in cut)


def test_without_a_language_texts_with_letters_stay(shipped, odd, none):
    kept = {r["doc_id"] for r in language_id.in_a_language(odd, language_id.train(none)).collect()}
    assert kept == {r["doc_id"] for r in odd.collect() if re.search(r"[^\W\d_]", r["text"] or "")} and not kept & {4, 5, 6}


# --- quality classifier ---


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    model = quality_classifier.fit(np.zeros((0, quality_classifier.FEATURES), np.float32), np.zeros(0, np.int64), np.zeros(0))
    w = {k: rng.normal(0, 0.3, v.shape) for k, v in model.weights.items()}
    x, starts, labels = rng.normal(size=(7, quality_classifier.FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    counts = np.array([0.7, 2.0, 1.0])

    def loss(weights):
        p = quality_classifier._forward(weights, x, starts)["score"]
        return -np.mean(counts * (labels * np.log(p) + (1 - labels) * np.log(1 - p)))

    found = quality_classifier._gradients(w, x, starts, labels, counts)
    for k, v in w.items():
        for at in [tuple(rng.integers(0, s) for s in v.shape) for _ in range(4)]:
            step = np.zeros_like(v)
            step[at] = 1e-5
            slope = (loss(w | {k: v + step}) - loss(w | {k: v - step})) / 2e-5
            assert abs(slope - found[k][at]) < 1e-5, k


def test_features_do_not_depend_on_neighbours():
    texts = [b"", b"  ", b"One two. three\nfour!", b"a " * 300, "é ß".encode() * 50, b"x"]
    together, starts = quality_classifier.passages(texts)
    for i, t in enumerate(texts):
        alone, _ = quality_classifier.passages([t])
        end = starts[i + 1] if i + 1 < len(texts) else len(together)
        assert np.allclose(together[starts[i] : end], alone), t
    assert np.diff(np.append(starts, len(together))).tolist() == [1, 1, 1, 5, 1, 1]


def test_quality_of_held_out_documents(shipped):
    labels = shipped.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op2_attention_quality"](shipped, FOLDER).join(labels, "doc_id").filter("held_out").collect()
    good, bad = [r["predicted"] for r in rows if r["quality"] == 1], [r["predicted"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_quality_of_odd_documents_and_without_labels(shipped, odd, none):
    labels = shipped.createDataFrame([(1, 1), (3, 0), (3, None), (None, 1), (13, 0), (15, 1), (14, 0)], "doc_id bigint, quality int")
    for model in (quality_classifier.train(odd, labels), quality_classifier.train(odd, labels.limit(0)), quality_classifier.train(none, labels)):
        rows = quality_classifier.classify(odd, model).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.select("doc_id").collect())
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
        assert quality_classifier.classify(none, model).count() == 0


# --- pipeline ---


def test_stages_keep_clean_documents_and_take_effect(shipped, small):
    folder, docs = "/root/testdata/sf0.001", small
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(shipped, docs, folder)
        assert after.columns == columns, name
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        kept = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert kept <= ids
        if name == "language_id":
            assert kept == ids  # every text of the tables is in a language
        if name == "near_duplicates":
            found = near_duplicates.near_duplicates(docs).collect()
            assert kept == {r["doc_id"] for r in found if r["doc_id"] == r["component_id"]} and kept != ids
        if name == "repeated_text":
            assert kept == ids and after.filter(F.length("text") != F.col("n_chars")).count() == 0
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](shipped, docs, folder)
    assert packed.select("doc_id").distinct().count() == docs.count()
    encoder = packing.Encoder(packing.tokenizer_path())
    tokens = sum(len(encoder.encode(r["text"])) + 1 for r in docs.collect())
    assert packed.agg(F.sum("length")).first()[0] == tokens


def test_pipeline_of_odd_documents_and_of_nothing(shipped, odd, none):
    for start in (odd, none):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(shipped, docs, FOLDER)
        if start is none:
            assert docs.count() == 0
        else:
            assert {4, 5, 6, 2, 3}.isdisjoint({r["doc_id"] for r in docs.collect()})
