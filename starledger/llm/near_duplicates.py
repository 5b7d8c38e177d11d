"""Near duplicates by MinHash.

The words of a text give a set of shingles. Many universal hash functions are run over each set; the minima form a
signature, cut into bands, and texts that agree in a band share a bucket. Candidates from buckets are verified, first by
their signatures, then on their full sets. Verified links give connected components by alternating large-star and
small-star.

Only the components are wanted, so no bucket is expanded into pairs. Texts with equal sets are one node. Then, in rounds,
each bucket that still spans several components offers its members one hub, and each node tries the hub it shares most
buckets with: near copies join their component here, at one trial per node and round. First hubs are the members that
share buckets with most others, as the text that a family of copies was made from does; later ones go by a hash, and
rounds end once they link few of those who try. After that, the members of a
bucket outside its largest component meet every member of another component; parity sketches of the sets, which give a
lower bound of their difference, rule out most of these, block by block, before they become rows. Whatever two nodes share a bucket then
either are connected, or have been compared, or can't be linked: no link is lost, and pairs within a component are never
made.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import by_position, per_batch, slices, written
from starledger.operators.joins import BROADCAST_LIMIT, ROWS_PER_SPLIT, measured_bytes, split_join

HASHES = 160
SHINGLE_WORDS = 5
SIMILARITY_PCT = 80
# Largest chance that a pair at the threshold shares no bucket.
MISS = 1e-7
# Rounds in which each node tries one hub, at most, and the share of trials that must succeed for another round.
HUB_ROUNDS, WORTH_ANOTHER = 4, 0.05
# A pair whose signatures agree in fewer places than this many standard deviations below the threshold isn't compared.
DEVIATIONS = 6
# Bits of the sketches that rule pairs out, and members of a bucket that are compared at a time.
SKETCH_BITS, BLOCK = 2048, 1000
SEED = 20_240_607

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Words that a worker remembers, and the longest of them in bytes.
REMEMBERED, LONGEST_REMEMBERED = 100_000, 64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= LONGEST_REMEMBERED:
            self[word] = value
        return value


_WORDS = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text of fewer words is one shingle, none without words.

    A-Z count as lower case; words lie between ASCII white space.
    """
    found = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    n = min(words, len(found))
    out = np.full(len(found) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix((out * np.uint64(0x9E3779B97F4A7C15)) ^ hashes[k : k + len(out)])
    return np.unique(out)


def band_rows(similarity: float, hashes: int = HASHES, miss: float = MISS) -> int:
    """The most rows per band with which a pair at the threshold still shares a bucket but for the chance ``miss``."""
    fits = [r for r in range(1, hashes + 1) if (1 - similarity**r) ** (hashes // r) <= miss]
    if not fits:
        raise ValueError("too few hash functions for this similarity")
    return max(fits)


def _functions(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add hash functions on 64-bit numbers, the multipliers odd."""
    random = np.random.default_rng(SEED)
    a = random.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, random.integers(0, 1 << 63, hashes, dtype=np.uint64)


def minima(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """A row of minima per set; the sets must not be empty."""
    a, b = _functions(hashes)
    out = np.empty((len(sets), hashes), np.uint64)
    for first, last in slices([len(s) for s in sets], 32_768):
        values = np.concatenate(sets[first:last])
        starts = np.cumsum([0, *(len(s) for s in sets[first : last - 1])])
        hashed = np.empty_like(values)
        for k in range(hashes):
            np.multiply(values, a[k], out=hashed)
            np.add(hashed, b[k], out=hashed)
            out[first:last, k] = np.minimum.reduceat(hashed, starts)
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, words: int, rows: int, hashes: int = HASHES) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, bands, signature`` for every row of ``docs``.

    ``text_key`` and ``set_key`` are 128-bit digests of the text and of its set; ``bands`` holds a bucket number per
    band, ``signature`` 16 bits of each minimum. The last three are null for an empty set.
    """
    keyed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.unhex(F.md5(F.col(f"`{text}`").cast("binary"))).alias("text_key"),
        F.col(f"`{text}`").alias("text"),
    )

    def sign(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column("text")
        for a in range(0, len(texts), 512):
            part = batch.slice(a, 512)
            sets = [shingles(t.as_py(), words) for t in part.column("text")]
            full = [s for s in sets if len(s)]
            found = minima(full, hashes)
            bands = found[:, : hashes // rows * rows].reshape(len(full), hashes // rows, rows)
            numbers = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2])
            for k in range(rows):
                numbers = _mix((numbers * np.uint64(0x9E3779B97F4A7C15)) ^ bands[:, :, k])
            short = (found >> np.uint64(48)).astype("<u2")
            at, keys, in_bands, signs = 0, [], [], []
            for s in sets:
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                in_bands.append(numbers[at].view(np.int64) if len(s) else None)
                signs.append(short[at].tobytes() if len(s) else None)
                at += bool(len(s))
            yield {
                "doc_id": part.column("doc_id"),
                "text_key": part.column("text_key"),
                "n_shingles": [len(s) for s in sets],
                "set_key": keys,
                "bands": in_bands,
                "signature": signs,
            }

    return per_batch(
        keyed,
        {"doc_id": "doc_id", "text_key": "text_key", "text": "text"},
        "doc_id $doc_id, text_key binary, n_shingles bigint, set_key binary, bands array<bigint>, signature binary",
        sign,
    )


def _joined(large: DataFrame, small: DataFrame, key: str, large_rows: int) -> DataFrame:
    """An inner join on a key that may be hot; below the size of one split no key can be."""
    return large.join(small, key) if large_rows <= ROWS_PER_SPLIT else split_join(large, small, key)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for every node of an undirected graph the smallest node it can reach.

    Alternates large-star (each neighbour above a node is linked to the smallest around it) and small-star (each
    neighbour below it, and the node itself) until the graph is a star around each smallest node. Every step is written
    to the shared folder. A large-star makes no more rows than there are edges, so only a small-star drops repeated ones.
    """

    def stored(pairs: DataFrame) -> tuple[DataFrame, int, bool]:
        """Written, with the number of pairs, and whether they are stars: each left node once, and never on the right."""
        out = written(pairs.filter(F.col("u") != F.col("v")).distinct(), "star-edges")
        ends = out.select(F.col("u").alias("node"), F.lit(1).alias("left"), F.lit(0).alias("right"))
        ends = ends.unionByName(out.select(F.col("v").alias("node"), F.lit(0).alias("left"), F.lit(1).alias("right")))
        met = ends.groupBy("node").agg(F.sum("left").alias("left"), F.max("right").alias("right"))
        found = met.agg(F.sum("left"), F.count_if((F.col("left") > 1) | (F.col("left") > 0) & (F.col("right") > 0))).first()
        return out, found[0] or 0, not found[1]

    now, size, stars = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    while not stars:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        above = _joined(both, least, "u", 2 * size).filter(F.col("v") > F.col("u"))
        large = written(above.select(F.col("v").alias("u"), F.col("m").alias("v")), "large-stars")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        below = _joined(large, smallest, "u", size).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now, size, stars = stored(below.unionByName(smallest.select("u", F.col("m").alias("v"))))
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _verifier(words: int, pct: int):
    def verify(batch: pa.RecordBatch) -> Iterator[dict]:
        a, b = [], []
        for i in range(len(batch)):
            one, two = (shingles(batch.column(c)[i].as_py(), words) for c in ("ta", "tb"))
            common = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * common >= pct * (len(one) + len(two) - common):
                a.append(batch.column("a")[i].as_py())
                b.append(batch.column("b")[i].as_py())
        yield {"a": a, "b": b}

    return verify


def _sketcher(words: int):
    """For each text the size of its set, and a bit per class of shingles: whether it has an odd number of them."""

    def sketch(batch: pa.RecordBatch) -> Iterator[dict]:
        sizes, bits = [], []
        for text in batch.column("text"):
            found = shingles(text.as_py(), words)
            odd = np.bincount((found % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
            sizes.append(len(found))
            bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
        yield {"node": batch.column("node"), "n": sizes, "sketch": bits}

    return sketch


def _possible(pct: int):
    """Pairs of a group, one of the few and one of all, in different components, that their sketches don't rule out.

    Shingles that only one of two sets has are at least as many as bits in which the sketches differ, and at most a share
    of (100 - pct) / (100 + pct) of both sets' sizes if the two are to be linked. So no link is ruled out.
    """

    def number(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        keys = np.column_stack([rows.column(c).to_numpy() for c in ("bucket", "one", "other")])
        bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        few, in_main = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("few", "in_main"))
        node, component = number(rows.column("node")), number(rows.column("component"))
        n = rows.column("n").to_numpy()
        sketch = np.array(rows.column("sketch").combine_chunks().flatten()).view(np.uint64).reshape(len(n), -1)
        found: list[np.ndarray] = []
        for first, last in zip(bounds, bounds[1:], strict=False):
            own = first + np.flatnonzero(few[first:last])
            other = first + np.flatnonzero(~few[first:last])
            for at in range(0, len(own), 64):
                a = own[at : at + 64]
                apart = np.bitwise_count(sketch[a][:, None, :] ^ sketch[other][None, :, :]).sum(axis=2, dtype=np.int64)
                possible = (100 + pct) * apart <= (100 - pct) * (n[a][:, None] + n[other][None, :])
                possible &= (component[a][:, None, :] != component[other][None, :, :]).any(axis=2)
                # Two members outside the main component meet once.
                high, low = (node[a][:, None, k] < node[other][None, :, k] for k in (0, 1))
                before = high | ((node[a][:, None, 0] == node[other][None, :, 0]) & low)
                i, j = np.nonzero(possible & (in_main[other][None, :] | before))
                found.append(np.column_stack([a[i], other[j]]))
        met = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        names = rows.column("node").combine_chunks()
        yield pa.RecordBatch.from_arrays([names.take(pa.array(met[:, k])) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("bucket", "one", "other")])
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if held and len(keys) and tuple(keys[0]) != tuple(held[-1].column(c)[-1].as_py() for c in ("bucket", "one", "other")):
                yield from pairs(pa.Table.from_batches(held))
                held = []
            if len(ends):  # the groups that end in this batch
                yield from pairs(pa.Table.from_batches([*held, batch.slice(0, int(ends[-1]))]))
                held, batch = [], batch.slice(int(ends[-1]))
            if len(batch):
                held.append(batch)
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return run


class _Linker:
    """Candidates, trials and verified links over the nodes that share a bucket with another."""

    def __init__(self, docs: DataFrame, classes: DataFrame, text: str, doc_id: str, words: int, pct: int, hashes: int, limit: int):
        self.words, self.pct, self.hashes = words, pct, hashes
        entries = classes.agg(F.coalesce(F.sum(F.size("bands")), F.lit(0))).first()[0]
        buckets = classes.select("node", F.explode("bands").alias("bucket"))
        shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("bucket")
        self.members = written(_joined(buckets, shared, "bucket", entries), "bucket-members")
        self.size = self.members.count()
        needed = self.members.select("node").distinct()
        self.nodes = written(needed.join(classes.select("node", "first_id", "signature"), "node"), "candidate-nodes")
        self.texts = written(self._texts(docs, text, doc_id, limit), "candidate-texts")
        self.tried: DataFrame | None = None
        # The component of every candidate node, and the members of buckets that span several; new links change both.
        # Before there are any, each node is a component, and each of these buckets spans several.
        self.own: DataFrame | None = None
        self.mixed: DataFrame | None = self.members.withColumn("component", F.col("node"))

    def _texts(self, docs: DataFrame, text: str, doc_id: str, limit: int) -> DataFrame:
        """``node, text``: the text of one document of each node."""
        wanted = self.nodes.select(F.col("node").alias("wanted"), "first_id")
        rows = docs.select(
            F.unhex(F.md5(F.col(f"`{text}`").cast("binary"))).alias("node"), F.col(f"`{doc_id}`").alias("own"), F.col(f"`{text}`").alias("text")
        )
        wanted = F.broadcast(wanted) if measured_bytes(wanted) <= limit else wanted
        # The id is part of the key, so the copies of a text don't come together.
        same = (F.col("node") == F.col("wanted")) & F.col("own").eqNullSafe(F.col("first_id"))
        return rows.join(wanted, same).select("node", "text")

    def components(self) -> DataFrame:
        """``node, component`` of the candidate nodes."""
        return self.nodes.select("node", F.col("node").alias("component")) if self.own is None else self.own

    def _absorb(self, links: DataFrame, size: int) -> None:
        """Merge the components that new links join: only these are looked at, as nodes of a smaller graph."""
        own = self.components()
        between = links if self.own is None else self._with(links, own, "component", size)
        ends = ("a", "b") if self.own is None else ("component_a", "component_b")
        merged = components(between, *ends).select(F.col("node").alias("component"), F.col("component").alias("into"))
        everywhere = own.select("component").distinct().join(merged, "component", "left")
        moved = _joined(own, everywhere, "component", self.nodes.count())
        self.own = written(moved.select("node", F.coalesce("into", "component").alias("component")), "node-components")
        self.mixed = None

    def in_components(self) -> DataFrame:
        """``bucket, node, component`` of the members of buckets that span several components."""
        if self.mixed is not None:
            return self.mixed
        members = written(self.members.join(self.components(), "node"), "bucket-components")
        mixed = members.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        mixed = mixed.filter(F.col("least") != F.col("most")).select("bucket")
        self.mixed = written(_joined(members, mixed, "bucket", self.size).select("bucket", "node", "component"), "mixed-buckets")
        return self.mixed

    def hub_round(self, number: int) -> bool:
        """Each node tries the hub that it shares most buckets with; whether another round is worth it."""
        members = self.in_components()
        size = members.count()
        if not size:
            return False
        if number == 0:
            sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
            met = _joined(members, sizes, "bucket", size).groupBy("node").agg(F.sum("n").alias("met"))
            members, first = written(_joined(members, met, "node", size), "popular-members"), -F.col("met")
        else:
            first = F.xxhash64("node", F.lit(number))
        order = F.struct(first.alias("order"), F.col("node").alias("hub"), F.col("component").alias("hub_component"))
        hubs = members.groupBy("bucket").agg(F.min(order).alias("h")).select("bucket", "h.hub", "h.hub_component")
        offers = _joined(members, hubs, "bucket", size).filter(F.col("component") != F.col("hub_component"))
        counted = offers.groupBy("node", "hub").agg(F.count("*").alias("n"))
        best = counted.groupBy("node").agg(F.max(F.struct("n", "hub")).alias("best"))
        tried, linked = self._try(best.select(F.col("node").alias("a"), F.col("best.hub").alias("b")))
        return linked > WORTH_ANOTHER * tried

    def last_round(self) -> None:
        """All pairs of bucket members in different components that their sketches don't rule out."""
        members = self.in_components()
        size = members.count()
        if not size:
            return
        unlinked = members.select("node").distinct()
        columns = {"node": "node", "text": "text"}
        sketched = per_batch(
            self.texts.join(unlinked, "node"), columns, "node binary, n bigint, sketch array<bigint>", _sketcher(self.words)
        )
        members = _joined(members, written(sketched, "sketches"), "node", size)
        counts = members.groupBy("bucket", "component").agg(F.count("*").alias("size"))
        main = counts.groupBy("bucket").agg(
            F.max(F.struct("size", "component")).alias("main"), F.ceil(F.sum("size") / BLOCK).cast("int").alias("blocks")
        )
        main = main.select("bucket", F.col("main.component").alias("main"), "blocks")
        marked = written(_joined(members, main, "bucket", size), "marked-buckets")
        # A large bucket is cut into blocks by a hash of its members, and each block of those outside the main component
        # meets each block of all members in a group of its own.
        block, all_blocks = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
        outside = marked.filter(F.col("component") != F.col("main"))
        few = outside.withColumns({"one": block, "few": F.lit(True)}).withColumn("other", F.explode(all_blocks))
        every = marked.withColumns({"other": block, "few": F.lit(False)}).withColumn("one", F.explode(all_blocks))
        columns = ["bucket", "one", "other", "few", "node", "component", (F.col("component") == F.col("main")).alias("in_main"), "n", "sketch"]
        groups = few.select(columns).unionByName(every.select(columns))
        groups = groups.repartition("bucket", "one", "other").sortWithinPartitions("bucket", "one", "other")
        self._try(groups.mapInArrow(_possible(self.pct), "a binary, b binary"))

    def _try(self, pairs: DataFrame) -> tuple[int, int]:
        """Verify pairs that haven't been tried, signatures first, then the full sets. How many were, and are linked."""
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        untried = ordered if self.tried is None else ordered.join(self.tried, ["a", "b"], "left_anti")
        new = written(untried, "pairs")
        size = new.count()
        if not size:
            return 0, 0
        signs = self.nodes.select("node", "signature")
        near = self._with(new, signs, "signature", size)
        share = self.pct / 100
        least = self.hashes * (share - DEVIATIONS * (share * (1 - share) / self.hashes) ** 0.5)

        def agree(batch: pa.RecordBatch) -> Iterator[dict]:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(len(batch), -1) for c in ("sa", "sb")
            )
            keep = pa.array((one == two).sum(axis=1) >= least) if len(batch) else pa.array([], pa.bool_())
            yield {c: batch.column(c).filter(keep) for c in ("a", "b")}

        columns = {"a": "a", "b": "b", "sa": "signature_a", "sb": "signature_b"}
        close = written(per_batch(near, columns, "a binary, b binary", agree), "close-pairs")

        met = self._with(close, self.texts, "text", size)
        columns = {"a": "a", "b": "b", "ta": "text_a", "tb": "text_b"}
        linked = per_batch(met, columns, "a binary, b binary", _verifier(self.words, self.pct))
        linked = written(linked.distinct(), "new-links")
        self.tried = new if self.tried is None else self.tried.unionByName(new)
        found = linked.count()
        if found:
            self._absorb(linked, found)
        return size, found

    @staticmethod
    def _with(pairs: DataFrame, values: DataFrame, name: str, size: int) -> DataFrame:
        for side in ("a", "b"):
            named = values.select(F.col("node").alias(side), F.col(name).alias(f"{name}_{side}"))
            pairs = _joined(pairs, named, side, size)
        return pairs


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    similarity_pct: int = SIMILARITY_PCT,
    hashes: int = HASHES,
    hub_rounds: int = HUB_ROUNDS,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked if ``100 * common >= similarity_pct * union`` holds for their sets of shingles of ``words``
    words; ``component_id`` is the smallest id that links lead to, the own included. A null text and one without words
    have no shingles and no links. Rows that repeat a text share a component; a null id is no smallest id, unless a
    component holds no other. ``kept`` is true for the rows of the smallest id and, should texts share it, the smallest
    digest of them; rows without shingles are all kept. Texts of any length count whole.
    """
    rows = written(signatures(docs, doc_id, text, words, band_rows(similarity_pct / 100, hashes), hashes), "signatures")
    full = rows.filter(F.col("set_key").isNotNull())
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")).alias("least")
    own = full.groupBy("set_key").agg(least, F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    picked = own.select(
        "set_key", "least", F.col("least.text_key").alias("node"), F.col("least.doc_id").alias("first_id"), "bands", "signature"
    )
    classes = written(picked, "classes")
    linker = _Linker(docs, classes, text, doc_id, words, similarity_pct, hashes, broadcast_limit)
    for number in range(hub_rounds):
        if not linker.hub_round(number):
            break
    linker.last_round()
    nodes = classes.select("set_key", "node", "least")
    linked = nodes.join(linker.components(), "node")
    first = linked.groupBy("component").agg(F.min("least").alias("first"))
    moved = _joined(linked, first, "component", nodes.count()).select("set_key", "first")
    by_set = nodes.join(moved, "set_key", "left").select("set_key", F.coalesce("first", "least").alias("first"))
    found = split_join(full.select("doc_id", "text_key", "n_shingles", "set_key"), written(by_set, "set-components"), "set_key")
    found = found.select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))).alias("kept"),
    )
    alone = rows.filter(F.col("set_key").isNull())
    alone = alone.select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return found.unionByName(alone)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", broadcast_limit: int = BROADCAST_LIMIT, **options) -> DataFrame:
    """``docs`` with one row of each component of near duplicates, all columns unchanged.

    Of rows that repeat the id and the text of the kept one, any one stays. Rows without shingles all stay.
    """
    one = functools.partial(_keep_one, broadcast_limit=broadcast_limit, **options)
    return by_position(docs, one, doc_id=doc_id, text=text)


def _keep_one(docs: DataFrame, doc_id: str, text: str, broadcast_limit: int, **options) -> DataFrame:
    judged = written(near_duplicates(docs, doc_id, text, broadcast_limit=broadcast_limit, **options), "near-duplicates")
    keys = ["doc_id", "text_key"]
    named = dict(zip(keys, ("__own_id", "__own_key"), strict=True))
    dropped = judged.filter(~F.col("kept")).select(keys).distinct().withColumnsRenamed(named)
    repeated = judged.filter(F.col("kept") & (F.col("n_shingles") > 0)).groupBy(keys).agg(F.count("*").alias("n"))
    repeated = repeated.filter(F.col("n") > 1).select(keys).withColumnsRenamed(named)

    value = F.unhex(F.md5(F.col(f"`{text}`").cast("binary")))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__own_id")) & (value == F.col("__own_key"))

    def listed(df: DataFrame) -> DataFrame:
        df = written(df, "listed-rows")
        return F.broadcast(df) if measured_bytes(df) <= broadcast_limit else df

    dropped, repeated = listed(dropped), listed(repeated)
    once = docs.join(dropped, same, "left_anti").join(repeated, same, "left_anti")
    again = docs.join(repeated, same).dropDuplicates(["__own_id", "__own_key"]).drop("__own_id", "__own_key")
    return once.unionByName(again)
