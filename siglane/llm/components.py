"""Connected components of a graph that no machine holds, by alternating stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import prepare, store


#: Edges that a task takes at a time when what is left is put together.
TOGETHER = 1 << 18


def _forest(batches):
    """Edges of a partition, replaced by edges from each of its nodes to the smallest one it is connected with here."""
    parent: dict[bytes, bytes] = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, top) for x in parent if (top := root(x)) != x]
    for k in range(0, len(rows), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[k : k + 50_000]], pa.binary()) for i in (0, 1)], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for each node of ``edges`` (a, b: binary); others are alone.

    Each partition first keeps a spanning star of its own edges. Where these are TOGETHER at most, one task, which never
    holds more, makes the stars of all of them, and that is all. Else large and small stars alternate: a node hands its
    larger neighbours, then its smaller ones, to the smallest it knows. Both only need the minimum of a node's
    neighbours, which is summed up before it is dealt; it ends when a round changes nothing, after about as many
    rounds as the logarithm of the longest chain, or when so few edges are left.
    """
    prepare(edges.sparkSession)
    now = store(edges.select("a", "b").mapInArrow(_forest, "u binary, v binary").distinct(), "stars")

    def mark(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    before = mark(now)
    while True:
        if before[0] <= TOGETHER:
            now = store(now.repartition(1).mapInArrow(_forest, "u binary, v binary"), "stars")
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = store(small, "stars")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
