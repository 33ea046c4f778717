"""Bloom filters of a fixed number of bytes, built by executors in segments and gathered whole."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import mix, prepare

SEGMENTS = 64
PROBES = 4


def positions(keys: np.ndarray, bits: int, probes: int = PROBES) -> np.ndarray:
    """(probes, keys) bit numbers within a segment of ``bits`` bits, by double hashing."""
    a, b = mix(keys, 1), mix(keys, 2) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(a + np.uint64(i) * b) % np.uint64(bits) for i in range(probes)])


def insert(segment: np.ndarray, keys: np.ndarray, probes: int = PROBES) -> None:
    if len(keys):
        at = positions(keys, len(segment) * 8, probes).ravel()
        np.bitwise_or.at(segment, (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))


def probe(segment: np.ndarray, keys: np.ndarray, probes: int = PROBES) -> np.ndarray:
    at = positions(keys, len(segment) * 8, probes)
    return np.all((segment[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1, axis=0)


class Filter:
    """SEGMENTS equal segments; a key's top six bits name its segment."""

    def __init__(self, segments: dict[int, bytes], size: int):
        self.bits = np.zeros((SEGMENTS, size), dtype=np.uint8)
        for k, v in segments.items():
            self.bits[k] = np.frombuffer(v, dtype=np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """True for every key that was put in, and for a few others."""
        at = positions(keys, self.bits.shape[1] * 8)
        row = (keys >> np.uint64(58)).astype(np.int64)
        return np.all((self.bits[row, (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1, axis=0)


def build(keys: DataFrame, column: str, size: int = 1 << 18) -> Filter:
    """Filter of a long column; SEGMENTS x size bytes (16 MB), however many keys there are.

    Keys go to the task of their segment, which ORs them in as they come; callers send each key once.
    The more keys, the more strangers pass: callers must confirm what passes.
    """
    prepare(keys.sparkSession)

    def segments(batches):
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            k = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
            row = (k >> np.uint64(58)).astype(np.int64)
            for s in np.unique(row):
                insert(own.setdefault(int(s), np.zeros(size, dtype=np.uint8)), k[row == s])
        for s, v in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["segment", "bits"])

    dealt = keys.select(F.col(column).cast("long").alias("key")).na.drop()
    dealt = dealt.withColumn("segment", F.shiftrightunsigned("key", 58).cast("int")).repartitionById(SEGMENTS, "segment")
    whole = dealt.mapInArrow(segments, "segment int, bits binary")
    return Filter({r["segment"]: bytes(r["bits"]) for r in whole.collect()}, size)
