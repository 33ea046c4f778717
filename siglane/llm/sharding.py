"""Shards of nearly equal bytes: groups of equal texts, put together by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siglane.llm.common import partitions, prepare, store

#: Groups below a share of all bytes are first gathered in so many bins by their digest.
BINS = 4096
#: A group of at least this part of a shard's bytes is an item of its own, of which there can be shards x HEAVY at most.
HEAVY = 32


def differencing(sizes: list[int], ways: int) -> list[int]:
    """The part (0 to ways - 1) of each item, by the largest differencing method.

    Each item starts as a partial partition: itself in one part, the other parts empty. The two partial partitions
    with the largest spread (heaviest less lightest part) are combined, the heaviest part of one with the lightest
    of the other, until one is left. Ties go to the partition that was made first.
    """
    if not sizes:
        return []
    order = itertools.count()
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, next(order), [(0, [])] * (ways - 1) + [(size, [i])]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        both = [(a + b, x + y if len(x) >= len(y) else y + x) for (a, x), (b, y) in zip(one, reversed(other), strict=True)]
        both.sort(key=lambda p: p[0])
        heapq.heappush(heap, (both[0][0] - both[-1][0], next(order), both))
    part = [0] * len(sizes)
    for k, (_, items) in enumerate(sorted(heap[0][2], key=lambda p: (-p[0], min(p[1], default=len(sizes))))):
        for i in items:
            part[i] = k
    return part


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 1. Rows of equal texts (null and empty are equal) stay in one shard. Groups
    that hold a fair part of a shard are items of their own (shards x HEAVY at most), all others are gathered in BINS
    bins by digest, so differencing on the driver has a bounded number of items at any input. A group of more bytes
    than a shard's even share makes its shard larger than the others. Slots count up from 0 in each shard. Repeated
    rows get slots of their own. An empty table gives an empty one; other columns are left out.
    """
    spark = prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))
    rows = store(rows.withColumn("bin", F.pmod(F.xxhash64("digest"), F.lit(BINS)).cast("int")), "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    least = max(1, total // (shards * HEAVY))
    heavy = rows.groupBy("digest").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") >= least).orderBy("digest").collect()
    large = spark.createDataFrame([(bytes(r["digest"]), BINS + k) for k, r in enumerate(heavy)], "digest binary, item int")
    rows = rows.join(F.broadcast(large), "digest", "left").withColumn("item", F.coalesce("item", "bin"))
    # Each shard's rows are numbered in many parts, dealt by doc_id and text, whose counts give where each part starts.
    parts = max(64, partitions(spark))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "digest", "item"), F.lit(parts)).cast("int")).drop("bin", "digest")
    items = {r["item"]: r["bytes"] for r in rows.groupBy("item").agg(F.sum("size").alias("bytes")).collect()}
    keys = sorted(items)
    placed = list(zip(keys, differencing([items[k] for k in keys], shards), strict=True))
    rows = rows.join(F.broadcast(spark.createDataFrame(placed, "item int, shard int")), "item")
    counts = {(r["shard"], r["part"]): r["count"] for r in rows.groupBy("shard", "part").count().collect()}
    starts, so_far = [], {}
    for (shard, part), n in sorted(counts.items()):
        starts.append((shard, part, so_far.get(shard, 0)))
        so_far[shard] = so_far.get(shard, 0) + n
    rows = rows.join(F.broadcast(spark.createDataFrame(starts, "shard int, part int, start long")), ["shard", "part"])
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + rank - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
