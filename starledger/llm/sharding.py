"""Sharding by Karmarkar-Karp differencing.

Rows with equal texts form a group that stays together; shards get near-equal bytes. A *partial partition* holds k
shares, largest first. Differencing takes the two partial partitions whose spread (largest minus smallest share) is
greatest and joins them in opposite order, the largest share of one with the smallest of the other, until one is left.

It runs as a tree. Groups are dealt to parts by a hash of their text, and each part is differenced into one partial
partition of k shares. Those, k numbers per part, are differenced in the same way, a bounded number at a time, until one
is left. Parts and their number follow from the groups alone, so the outcome is the same whatever the session's settings.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import written
from starledger.operators.joins import BROADCAST_LIMIT, measured_bytes, split_join

SHARDS = 16
# Groups per part, and partial partitions that are differenced together: what a task holds as small tuples, about.
GROUPS_PER_PART = 20_000
PARTS_TOGETHER = 1_000
# Rows that are numbered together, over all shards.
ROWS_PER_SLICE = 200_000


def difference(parts: list[tuple[int, ...]], shards: int) -> list[list[tuple[int, int]]]:
    """Combine partial partitions into one.

    ``parts[i]`` is a tuple of up to ``shards`` shares. The result has a list per shard, of pairs (i, share of i).
    Ties are broken by order of entry, so equal input gives equal output.
    """
    if not parts:
        return [[] for _ in range(shards)]
    heap = []
    for i, shares in enumerate(parts):
        full = sorted([(s, (i, j)) for j, s in enumerate(shares)], key=lambda x: (-x[0], x[1]))
        full += [(0, None)] * (shards - len(full))
        sums, members = [s for s, _ in full], [m for _, m in full]
        heapq.heappush(heap, (sums[-1] - sums[0], i, sums, members))
    number = len(parts)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, others, their = heapq.heappop(heap)
        joined = [
            (a + b, (m, t) if m and t else m or t)
            for a, m, b, t in zip(sums, members, reversed(others), reversed(their), strict=True)
        ]
        joined.sort(key=lambda x: -x[0])
        sums, members = [s for s, _ in joined], [m for _, m in joined]
        heapq.heappush(heap, (sums[-1] - sums[0], number, sums, members))
        number += 1
    return [_leaves(m) for m in heap[0][3]]


def _leaves(tree) -> list[tuple[int, int]]:
    """The pairs of numbers at the ends of nested pairs."""
    found, todo = [], [tree] if tree else []
    while todo:
        left, right = todo.pop()
        if isinstance(left, int):
            found.append((left, right))
        else:
            todo += [left, right]
    return found


def shard(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    groups_per_part: int = GROUPS_PER_PART,
    parts_together: int = PARTS_TOGETHER,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1. Rows with equal texts share a shard; all null texts form one group and all
    empty ones another. ``slot`` numbers the rows of a shard without gaps. The law is ``bytes``: sizes near equal, as far
    as whole groups allow; a group above the mean fills a shard by itself. ``grown_shard`` has no meaning under it and
    is null. Repeated rows get a slot each. Equal rows give an equal result, however they are partitioned.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = written(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            (F.octet_length(value) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            # Null texts get a digest that no text has.
            F.when(F.col(f"`{text}`").isNull(), F.lit("")).otherwise(F.sha2(value.cast("binary"), 256)).alias("digest"),
        ),
        "sharding-rows",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    placed = _placed(written(groups, "sharding-groups"), shards, groups_per_part, parts_together)
    with_shard = split_join(rows, placed, "digest").select("doc_id", "size", "text_crc32", "shard")
    return _numbered(with_shard, rows_per_slice).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _placed(groups: DataFrame, shards: int, groups_per_part: int, parts_together: int) -> DataFrame:
    """``digest, shard`` for every group."""

    def first(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("digest", ignore_index=True)
        return _with_share(held, [(int(s),) for s in held["size"]], shards)

    def again(held: pd.DataFrame) -> pd.DataFrame:
        """Shares of several parts, as shares of the one that they become."""
        held = held.sort_values(["part", "share"], ignore_index=True)
        places = [g.index.tolist() for _, g in held.groupby("part", sort=True)]
        new = [0] * len(held)
        sizes = [int(s) for s in held["size"]]
        for k, members in enumerate(difference([tuple(sizes[i] for i in p) for p in places], shards)):
            for i, j in members:
                new[places[i][j]] = k
        return held.assign(new_share=pd.Series(new, dtype="int32"))

    parts = max(1, -(-groups.count() // groups_per_part))
    part = F.pmod(F.xxhash64("digest"), F.lit(parts))
    dealt = groups.withColumn("part", part).groupBy("part").applyInPandas(first, "digest string, size bigint, part bigint, share int")
    placed = written(dealt, "sharding-shares")
    sums = placed.groupBy("part", "share").agg(F.sum("size").alias("size"))
    while parts > 1:
        parts = -(-parts // parts_together)
        parent = F.floor(F.col("part") / parts_together).alias("parent")
        grouped = sums.select("part", "share", "size", parent).groupBy("parent")
        joined = written(
            grouped.applyInPandas(again, "part bigint, share int, size bigint, parent bigint, new_share int"), "sharding-joined"
        )
        # k rows per part; a part's shares hold about equal numbers of groups.
        step = joined.drop("size")
        step = F.broadcast(step) if measured_bytes(step) <= BROADCAST_LIMIT else step
        placed = placed.join(step, ["part", "share"]).select(
            "digest", F.col("parent").alias("part"), F.col("new_share").alias("share")
        )
        sums = joined.groupBy(F.col("parent").alias("part"), F.col("new_share").alias("share")).agg(F.sum("size").alias("size"))
    return placed.select("digest", F.col("share").alias("shard"))


def _with_share(held: pd.DataFrame, parts: list[tuple[int, ...]], shards: int) -> pd.DataFrame:
    share = [0] * len(held)
    for k, members in enumerate(difference(parts, shards)):
        for i, _ in members:
            share[i] = k
    return held.assign(share=pd.Series(share, dtype="int32"))


def _numbered(rows: DataFrame, rows_per_slice: int) -> DataFrame:
    """Add ``slot``. Rows of a shard are numbered within slices of bounded size, then each slice gets its start.

    Slices go by a hash of the row, and equal rows are one row with a count until they have their numbers, so neither a
    large shard nor a repeated row comes together in one task.
    """
    columns = ["doc_id", "text_crc32", "size"]
    counted = written(rows.groupBy("shard", *columns).agg(F.count("*").alias("copies")), "sharding-counted")
    slices = max(1, -(-counted.count() // rows_per_slice))
    dealt = counted.withColumn("slice", F.pmod(F.xxhash64(*columns), F.lit(slices)))
    sizes = dealt.groupBy("shard", "slice").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "slice").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    # A row per slice and shard, whatever the number of documents.
    numbered = placed.join(starts, ["shard", "slice"]).withColumn("first", F.col("start") + F.col("before"))
    last = F.col("first") + F.col("copies") - 1
    return numbered.withColumn("slot", F.explode(F.sequence("first", last)))
