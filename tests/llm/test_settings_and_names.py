"""Results that follow from the data alone, whatever the session's settings, the partitioning and the columns' names."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starledger.llm import decontamination, language_id, near_duplicates, quality_classifier, repeated_text, sharding, warc

# --- column names ---

NAMES = ["c0", "c1", "c2", "c3", "__key", "__begins", "__spans", "__own_id", "__hit_id", "begins", "key", "Text"]


@pytest.fixture(scope="module")
def clashing(shipped):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(90)) for _ in range(12)]
    texts += [texts[0], texts[1] + " end", None, "", "½ ²"]
    rows = [(*[f"{n}-{i}" for n in NAMES], t, i, "en") for i, t in enumerate(texts)]
    return shipped.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES) + ", text string, doc_id int, lang string"), rows


def others(row):
    return row[: len(NAMES)], row[-2:]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_rows_keep_their_columns(clashing, shipped, limit):
    docs, rows = clashing
    by_id = {r[-2]: others(r) for r in rows}
    item = shipped.createDataFrame([("i", rows[2][len(NAMES)])], "item_id string, text string")
    plain = docs.toDF(*[f"x{i}" for i in range(len(docs.columns))])
    trees = language_id.train(plain, f"x{len(NAMES) + 1}", f"x{len(NAMES)}", f"x{len(NAMES) + 2}")
    results = {
        "language": language_id.in_a_language(docs, trees),
        "near": near_duplicates.keep_one(docs, broadcast_limit=limit),
        "repeats": repeated_text.remove_repeats(docs, broadcast_limit=limit),
        "documents": decontamination.decontaminate(docs, item, broadcast_limit=limit),
        "spans": decontamination.decontaminate(docs, item, remove="spans", broadcast_limit=limit),
    }
    counts = {}
    for name, df in results.items():
        assert df.columns == docs.columns, name
        found = [tuple(r) for r in df.collect()]
        assert all(others(r) == by_id[r[-2]] for r in found), name
        counts[name] = len(found)
    assert counts == {"language": 14, "near": 15, "repeats": 17, "documents": 16, "spans": 17}


# --- sharding ---


def plain_shards(sizes, shards, parts_of, together):
    """``sizes`` by digest, the parts by ``parts_of``; the tree of parts as lists of shares."""
    held = []
    for part in sorted(set(parts_of.values())):
        digests = sorted(d for d, p in parts_of.items() if p == part)
        split = sharding.difference([(sizes[d],) for d in digests], shards)
        held.append([[digests[i] for i, _ in share] for share in split])
    numbers = sorted(set(parts_of.values()))
    while True:
        parents, ids = [], []
        for parent in sorted({n // together for n in numbers}):
            group = [[s for s in h if s] for n, h in zip(numbers, held, strict=True) if n // together == parent]
            joined = sharding.difference([tuple(sum(sizes[d] for d in s) for s in h) for h in group], shards)
            parents.append([[d for i, j in share for d in group[i][j]] for share in joined])
            ids.append(parent)
        held, numbers = parents, ids
        if len(held) == 1:
            return {d: k for k, share in enumerate(held[0]) for d in share}


@pytest.fixture
def settings(shipped):
    names = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {n: shipped.conf.get(n) for n in names}
    yield lambda aqe, partitions: (shipped.conf.set(names[0], aqe), shipped.conf.set(names[1], partitions))
    for name, value in before.items():
        shipped.conf.set(name, value)


def test_shards_follow_from_the_rows_alone(shipped, settings):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(900) + str(i % 700)) for i in range(1500)] + [(1, "same")] * 400 + [(None, None), (2, "")]
    options = {"shards": 4, "groups_per_part": 60, "parts_together": 3, "rows_per_slice": 100}
    results = []
    for aqe, partitions, at_first in (("true", "8", 3), ("false", "8", 5), ("true", "64", 1), ("false", "64", 9)):
        settings(aqe, partitions)
        docs = shipped.createDataFrame(rows, "doc_id int, text string").repartition(at_first)
        results.append(Counter(map(tuple, sharding.shard(docs, **options).collect())))
    assert results[0] == results[1] == results[2] == results[3]
    found = [r for r, n in results[0].items() for _ in range(n)]
    slots = {}
    for row in found:
        slots.setdefault(row[4], []).append(row[5])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(found) == len(rows)

    docs = shipped.createDataFrame(rows, "doc_id int, text string")
    digest = F.when(F.col("text").isNull(), "").otherwise(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    groups = docs.groupBy(digest).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("size"))
    parts = -(-groups.count() // 60)
    placed = groups.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(parts))).collect()
    expected = plain_shards({r["digest"]: r["size"] for r in placed}, 4, {r["digest"]: r["part"] for r in placed}, 3)
    ours = sharding._placed(groups, 4, 60, 3).collect()
    assert {r["digest"]: r["shard"] for r in ours} == expected
    loads = Counter()
    for r in placed:
        loads[expected[r["digest"]]] += r["size"]
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())


# --- WARC ---


def pages(spark, partitions):
    rows = [(2**53 + i, f"u{i}", f"page {i}" * 20) for i in range(300)] + [(None, "none", "without id")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(partitions)


def test_archives_beside_null_ids_are_the_same(shipped, tmp_path):
    manifests = []
    for n in (1, 4, 9):
        folder = str(tmp_path / str(n))
        warc.write_archives(pages(shipped, n), folder, shard_bytes=2_000)
        manifests.append(sorted(map(tuple, shipped.read.parquet(f"{folder}/manifest").collect())))
        assert {r["page_id"] for r in warc.read_archives(shipped, folder).collect()} == {None, *(2**53 + i for i in range(300))}
    assert manifests[0] == manifests[1] == manifests[2] and len(manifests[0]) > 5


def test_a_second_attempt_leaves_the_file_of_the_first(tmp_path):
    def attempt():
        files = warc._Files(str(tmp_path), 1 << 20, warc.DATE)
        files.add(1, "u", b"payload", None, 0)
        return files

    attempt().close()
    final = tmp_path / "shard-000000-00000.warc.gz"
    before = final.stat().st_ino
    second = attempt()
    second.stream.close()  # dies before the rename
    assert final.stat().st_ino == before
    third = attempt()
    third.close()
    assert final.stat().st_ino == before and third.done[0][0] == final.name


# --- language ---


def test_numbers_are_no_letters_and_repeats_no_examples(shipped):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["der", "die", "und", "nicht", "haus"]) for _ in range(30)), "de") for i in range(40)]
    rows += [(100 + i, " ".join(rng.choice(["the", "and", "not", "house"]) for _ in range(30)), "en") for i in range(40)]
    schema = "doc_id int, text string, lang string"
    docs = shipped.createDataFrame(rows, schema)
    trees = language_id.train(docs)
    odd = shipped.createDataFrame([(i, t, None) for i, t in enumerate(["½ ²", "Ⅷ", "①②③", "²", "12", "das Haus", "ª"])], schema)
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd, trees).collect()}
    assert [found[i] for i in range(5)] == ["und"] * 5 and found[5] == "de" and found[6] != "und"
    again = language_id.train(docs.unionAll(shipped.createDataFrame([rows[0]] * 400, schema)))
    scores = [sorted(map(tuple, language_id.identify(docs, t).collect())) for t in (trees, again)]
    assert scores[0] == scores[1]


# --- quality ---


def test_long_texts_teach_too(shipped):
    rng = random.Random(6)
    good = ["the quiet river runs past old houses and people talk about their day".split(), "a short story tells of work and rest".split()]
    junk = "CLICK $$$ ### buy NOW %%% |||"
    rows, labels = [], []
    for i in range(150):
        rows.append((i, " ".join(rng.choice(rng.choice(good)) for _ in range(120)) + ".", 1))
        labels.append((i, 1))
    for i in range(150, 190):
        rows.append((i, (junk + " ") * (72_000 // len(junk)), 0))
        labels.append((i, 0))
    docs = shipped.createDataFrame([r[:2] for r in rows], "doc_id int, text string")
    model = quality_classifier.train(docs, shipped.createDataFrame(labels, "doc_id int, quality int"))
    found = {r["doc_id"]: r["score"] for r in quality_classifier.classify(docs, model).collect()}
    assert max(found[i] for i in range(150, 190)) < 0.3 < min(found[i] for i in range(150))
