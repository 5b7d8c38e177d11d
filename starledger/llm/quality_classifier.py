"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of which only the whole is labelled. Every passage is encoded; a gated attention network
(tanh units multiplied by sigmoid gates) weighs the passages of a document; the weighted mean of their encodings is
scored. Encoder, attention and score are learned together from the labels of documents.

Features of a passage are shares of kinds of characters and words, how much of it repeats in its document, and hashed
words. They are computed for many texts at once on arrays of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import hash_share, held_out, per_batch, slices, text_start, written

PASSAGE_WORDS = 64
# The bounded sample that is learned from: labelled documents, and bytes per document.
TRAIN_DOCUMENTS = 6_000
TRAIN_BYTES = 65_536
# How many more than the wanted documents are sorted by their hashes.
SPARE = 4
ACCEPT_FROM = 0.3

HIDDEN, ATTENTION = 32, 16
EPOCHS, BATCH, RATE, DECAY = 25, 64, 3e-3, 1e-3
# Few documents are gone through more often, until as many steps have been made.
STEPS = 1_500
SEED = 7
HASHED_WORDS = 64
SLICE_BYTES = 250_000

# Kinds of bytes that are counted.
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>@^~_=+\\/{}[]",
    "mark": b"!?",
    "stop": b".,;:'\"()-",
    "beyond": bytes(range(128, 256)),
}
_KIND = np.zeros(256, np.uint8)
for _i, _bytes in enumerate(_KINDS.values(), 1):
    _KIND[np.frombuffer(_bytes, np.uint8)] = _i
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
SHAPES = [*_KINDS, "word_length", "capitalised", "bare", "ended", "distinct", "repeated", "lines", "words"]
FEATURES = len(SHAPES) + HASHED_WORDS


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and for each text where its passages begin. A text without words is one empty passage."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = _SPACE[data]
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    words_of = np.diff(np.searchsorted(begins, text_ends), prepend=0)
    count = np.maximum(1, -(-words_of // PASSAGE_WORDS))
    starts = np.cumsum(count) - count
    out = np.zeros((count.sum(), FEATURES), np.float32)
    if not len(begins):
        return out, starts

    text = np.repeat(np.arange(len(texts)), words_of)
    inside = np.arange(len(begins)) - np.repeat(np.cumsum(words_of) - words_of, words_of)
    passage = starts[text] + inside // PASSAGE_WORDS
    first = np.flatnonzero(np.diff(passage, prepend=-1))  # the first word of each passage that has words
    rows = passage[first]
    number = np.diff(np.append(first, len(passage)))

    def per_passage(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, first) / number

    ends = np.append(begins[1:], len(data))
    lengths = np.add.reduceat(~space, begins, dtype=np.int64)
    kind = _KIND[data]
    counts = [np.add.reduceat(kind == k, begins, dtype=np.int64) for k in range(1, len(_KINDS) + 1)]
    chars = np.maximum(1, np.add.reduceat(lengths, first))
    for k, c in enumerate(counts):
        out[rows, k] = np.add.reduceat(c, first) / chars
    by_name = dict(zip(_KINDS, counts, strict=True))
    letters = by_name["upper"] + by_name["lower"] + by_name["beyond"]
    last = data[begins + lengths - 1]
    offset = np.zeros(len(data), np.int64)  # of a byte in its word; leading white space belongs to none
    offset[begins[0] :] = np.arange(begins[0], len(data)) - np.repeat(begins, ends - begins)
    hashes = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _POWERS[offset & 255] * ~space, begins)
    hashes ^= hashes >> np.uint64(29)

    k = len(_KINDS)
    out[rows, k] = per_passage(np.log1p(lengths))
    out[rows, k + 1] = per_passage(kind[begins] == 1)
    out[rows, k + 2] = per_passage(letters == 0)
    out[rows, k + 3] = per_passage((last == 46) | (last == 33) | (last == 63))
    out[rows, k + 4] = np.bincount(_distinct(passage, hashes), minlength=len(out))[rows] / number
    out[rows, k + 5] = per_passage(_repeats(text, hashes))
    newline = np.add.reduceat(data == 10, begins)
    out[rows, k + 6] = per_passage(newline)
    out[rows, k + 7] = np.log1p(number)
    at = passage * HASHED_WORDS + (hashes % np.uint64(HASHED_WORDS)).astype(np.int64)
    hashed = np.bincount(at, minlength=len(out) * HASHED_WORDS).reshape(len(out), HASHED_WORDS)
    out[rows, k + 8 :] = np.sqrt(hashed[rows] / number[:, None])
    return out, starts


def _distinct(passage: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The passage of each distinct word in it."""
    key = hashes * np.uint64(0xD6E8FEB86659FD93) + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return passage[np.unique(key, return_index=True)[1]]


def _repeats(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each word whether the three words from it on occur more than once in its text."""
    out = np.zeros(len(text), bool)
    if len(text) < 3:
        return out
    three = (hashes[:-2] * np.uint64(0xD6E8FEB86659FD93) + hashes[1:-1]) * np.uint64(0xD6E8FEB86659FD93) + hashes[2:]
    key = three * np.uint64(0x9E3779B97F4A7C15) + text[:-2].astype(np.uint64)
    whole = text[:-2] == text[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    out[:-2] = repeated & whole
    return out


@dataclass
class Model:
    """The learned weights; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _forward(self.weights, self.standardised(features), starts)["score"]

    def standardised(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) * self.scale


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.diff(np.append(starts, len(x)))
    encoded = np.maximum(x @ w["encode"] + w["encode_0"], 0)
    tanh, gate = np.tanh(encoded @ w["tanh"]), _sigmoid(encoded @ w["gate"])
    energy = (tanh * gate) @ w["attend"]
    energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), sizes))
    attention = energy / np.repeat(np.add.reduceat(energy, starts), sizes)
    bag = np.add.reduceat(attention[:, None] * encoded, starts)
    return {
        "sizes": sizes, "encoded": encoded, "tanh": tanh, "gate": gate, "attention": attention, "bag": bag,
        "score": _sigmoid(bag @ w["score"] + w["score_0"]),
    }


def _gradients(
    w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, labels: np.ndarray, counts: np.ndarray
) -> dict[str, np.ndarray]:
    """Of the mean cross entropy, in which each document counts ``counts`` times."""
    f = _forward(w, x, starts)
    error = (f["score"] - labels) * counts / len(labels)
    from_bag = np.repeat(np.outer(error, w["score"]), f["sizes"], axis=0)
    to_attention = (f["encoded"] * from_bag).sum(axis=1)
    mean = np.repeat(np.add.reduceat(f["attention"] * to_attention, starts), f["sizes"])
    to_energy = f["attention"] * (to_attention - mean)
    through = to_energy[:, None] * w["attend"]
    to_tanh = through * f["gate"] * (1 - f["tanh"] ** 2)
    to_gate = through * f["tanh"] * f["gate"] * (1 - f["gate"])
    to_encoded = f["attention"][:, None] * from_bag + to_tanh @ w["tanh"].T + to_gate @ w["gate"].T
    to_encoded *= f["encoded"] > 0
    return {
        "encode": x.T @ to_encoded,
        "encode_0": to_encoded.sum(axis=0),
        "tanh": f["encoded"].T @ to_tanh,
        "gate": f["encoded"].T @ to_gate,
        "attend": to_energy @ (f["tanh"] * f["gate"]),
        "score": error @ f["bag"],
        "score_0": error.sum(),
    }


def fit(features: np.ndarray, starts: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Learn from bags with labels by Adam in a fixed order of documents. Without bags every score is 0.5."""
    random = np.random.default_rng(SEED)
    mean, deviation = (features.mean(axis=0), features.std(axis=0)) if len(features) else (np.zeros(FEATURES), np.zeros(FEATURES))
    scale = np.where(deviation > 1e-6, 1 / np.maximum(deviation, 1e-6), 0)
    w = {
        "encode": random.normal(0, (2 / FEATURES) ** 0.5, (FEATURES, HIDDEN)),
        "encode_0": np.zeros(HIDDEN),
        "tanh": random.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
        "gate": random.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
        "attend": random.normal(0, ATTENTION**-0.5, ATTENTION),
        "score": np.zeros(HIDDEN),
        "score_0": np.zeros(()),
    }
    model = Model(mean, scale, w)
    # Both labels weigh the same in all, however rare one is.
    share = labels.mean() if len(labels) else 0.5
    counts = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) if 0 < share < 1 else np.ones(len(labels))
    x, sizes = model.standardised(features), np.diff(np.append(starts, len(features)))
    one, two = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    batches = -(-len(labels) // BATCH)
    epochs = max(epochs, -(-STEPS // batches)) if batches else 0
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            rows = np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in docs])
            found = _gradients(w, x[rows], np.cumsum(sizes[docs]) - sizes[docs], labels[docs], counts[docs])
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for k, g in found.items():
                g = g + DECAY * w[k]
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.999 * two[k] + 0.001 * g * g
                w[k] = w[k] - rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    documents: int = TRAIN_DOCUMENTS,
    most_bytes: int = TRAIN_BYTES,
) -> Model:
    """Learn from a bounded sample of the labelled documents that aren't held out.

    Of the ids with a label, the ``documents`` with the smallest hashes, and of a longer text its first ``most_bytes``
    bytes. An id with several labels counts as good if at least half of them say so; null labels and ids are no examples.
    """
    marks = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").alias("label")).dropna()
    marks = marks.filter(~held_out("doc_id")).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    marks = written(marks, "labelled")
    # Ids with the smallest hashes, SPARE times as many as wanted on average, so that few come together to be sorted.
    near = marks.filter(hash_share("doc_id") * marks.count() <= SPARE * documents)
    picked = written(near.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents), "labelled-sample")
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(picked), "doc_id").withColumn("text", text_start("text", most_bytes))
    sample = sample.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def encode(batch: pa.RecordBatch) -> Iterator[dict]:
        found, starts = passages([_bytes(t.as_py()) for t in batch.column("text")])
        bags = np.split(found, starts[1:]) if len(batch) else []
        yield {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "bag": [b.astype("<f4").tobytes() for b in bags]}

    columns = {"doc_id": "doc_id", "label": "label", "text": "text"}
    rows = per_batch(sample, columns, "doc_id $doc_id, label int, bag binary", encode).toArrow().sort_by("doc_id")
    bags = [np.frombuffer(b, "<f4").reshape(-1, FEATURES) for b in rows.column("bag").to_pylist()]
    sizes = np.array([len(b) for b in bags], np.int64)
    features = np.concatenate(bags) if bags else np.empty((0, FEATURES), np.float32)
    return fit(features, np.cumsum(sizes) - sizes, np.array(rows.column("label").to_pylist(), float))


def classify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", accept_from: float = ACCEPT_FROM) -> DataFrame:
    """``doc_id, score, predicted, n_passages`` for every row of ``docs``, in one pass.

    Every passage of a text counts, however long it is. A null text counts as empty; empty texts are scored as one
    passage without words. Repeated rows get equal scores.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = [_bytes(t.as_py()) for t in batch.column("text")]
        for a, b in slices([len(t) for t in texts], SLICE_BYTES):
            features, starts = passages(texts[a:b])
            scores = sent.value.score(features, starts)
            yield {
                "doc_id": batch.column("doc_id").slice(a, b - a),
                "score": pa.array(scores.astype(float)),
                "predicted": pa.array((scores >= accept_from).astype(np.int32)),
                "n_passages": pa.array(np.diff(np.append(starts, len(features)))),
            }

    fields = "doc_id $doc_id, score double, predicted int, n_passages bigint"
    return per_batch(docs, {"doc_id": doc_id, "text": text}, fields, score)
