"""Exact duplicates by a tree-merge of sorted digest runs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import SPACES, by_place, fresh, lookup, partitions, prepare, row_hash, store, trimmed

#: Bits of the digest that one round settles: a task merges the runs of 2 ** ROUND_BITS others.
ROUND_BITS = 3
#: Records that a row of a run holds, and that a task gathers before it merges them.
ROW, GATHER = 1 << 13, 1 << 16
#: A record of a run: a text's sha256, its md5 and length as a check, the best row's length and id, the rows it stands for.
RECORD = np.dtype([("digest", "S32"), ("check", "S16"), ("n_normal", "<i4"), ("n_points", "<i4"), ("has_id", "u1"), ("doc_id", "<i8"), ("rows", "<i8")])
_RUN = "dest int, first binary, records binary"
_FOUND = "digest binary, keep_id long, group_size long"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest and check (sha256 and md5 of the text without white space), its length and the text's."""
    text = F.coalesce("text", F.lit(""))
    normal = F.translate(text, SPACES, "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(normal, 256)).alias("digest"), F.unhex(F.md5(normal.cast("binary"))).alias("check"), F.length(normal).alias("n_normal"), F.length(text).alias("n_points"))


def merged(runs: list[np.ndarray]) -> np.ndarray:
    """One sorted run of sorted runs, with one record for each digest.

    Of equal digests the record with the most code points, then the smallest doc_id (null last) stays, and rows add up.
    Equal digests of texts that differ in length or in their second digest would be a collision, which stops the job.
    """
    every = np.concatenate(runs) if runs else np.zeros(0, dtype=RECORD)
    if len(every) < 2:
        return every
    every = every[np.lexsort((every["doc_id"], 1 - every["has_id"], -every["n_points"], every["digest"]))]
    same = every["digest"][1:] == every["digest"][:-1]
    if ((every["check"][1:] != every["check"][:-1]) | (every["n_normal"][1:] != every["n_normal"][:-1]))[same].any():
        raise ValueError("different texts have the same sha256 digest")
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    rows = np.add.reduceat(every["rows"], starts)
    every = every[starts]
    every["rows"] = rows
    return every


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of one width."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=f"S{width}")


def _opened(batch: pa.RecordBatch) -> np.ndarray:
    """Records of a batch of rows (digest, check, n_normal, n_points, doc_id), each standing for itself."""
    out = np.zeros(batch.num_rows, dtype=RECORD)
    out["digest"], out["check"] = _fixed(batch.column(0), 32), _fixed(batch.column(1), 16)
    out["n_normal"], out["n_points"], out["rows"] = np.asarray(batch.column(2)), np.asarray(batch.column(3)), 1
    out["has_id"] = np.asarray(batch.column(4).is_valid())
    out["doc_id"] = np.asarray(batch.column(4).fill_null(0))
    return out


def _sent(run: np.ndarray, shift: int, width: int, bits: int) -> pa.RecordBatch:
    """Rows of a run, each with the partition that it goes to: this one's number, ``width`` bits of which from ``shift`` on are the digest's."""
    mask = ((1 << width) - 1) << shift
    head = np.frombuffer(run["digest"].astype("S4").tobytes(), dtype=">u4").astype(np.int64) >> (32 - bits)
    dest = (TaskContext.get().partitionId() & ~mask) | (head & mask)
    rows = []
    for k in np.unique(dest).tolist():
        own = run[dest == k]
        for at in range(0, len(own), ROW):
            part = own[at : at + ROW]
            rows.append((k, part[:1].tobytes()[:32], part.tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["dest", "first", "records"])


def _found(run: np.ndarray) -> pa.RecordBatch:
    ids = pa.array(run["doc_id"], mask=run["has_id"] == 0)
    digest = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(run), [None, pa.py_buffer(np.ascontiguousarray(run["digest"]).tobytes())])
    return pa.RecordBatch.from_arrays([digest.cast(pa.binary()), ids, pa.array(run["rows"])], names=["digest", "keep_id", "group_size"])


def _round(out, opened: bool):
    """A task's part of a round: merges sorted input as it comes, and hands what is settled to ``out``.

    Input rows come in the order of their first digests, so what is smaller than the latest first is settled: no more
    is held than GATHER records and a row of each run.
    """

    @trimmed
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in [_opened(batch)] if opened else [np.frombuffer(x, dtype=RECORD) for x in batch.column(1).to_pylist()]:
                if not len(part):
                    continue
                held.append(part)
                size += len(part)
                if size > GATHER:
                    every = merged(held)
                    cut = int(np.searchsorted(every["digest"], part["digest"][-1 if opened else 0]))
                    if cut:
                        yield out(every[:cut])
                    held, size = [every[cut:]], 0
        every = merged(held)
        if len(every):
            yield out(every)

    return run


def keepers(rows: DataFrame) -> DataFrame:
    """digest, keep_id, group_size for each digest of ``rows`` (digests()'s columns).

    Every partition sorts its rows into a run and merges equal digests. Then, round by round, groups of up to
    2 ** ROUND_BITS partitions whose numbers differ in the round's bits only exchange runs, each taking the records
    whose digest has its own bits there, and merge the sorted runs. After the last round a partition holds all records
    of its part of the digests. What a partition sends of one digest is one record, however many copies there are, and
    no partition holds more than its share of the distinct digests.
    """
    spark = prepare(rows.sparkSession)
    bits = max(1, math.ceil(math.log2(partitions(spark))))
    runs = rows.select("digest", "check", "n_normal", "n_points", "doc_id")
    runs = runs.repartition(1 << bits) if runs.rdd.getNumPartitions() > 1 << bits else runs
    runs, opened = runs.sortWithinPartitions("digest"), True
    for low in range(0, bits, ROUND_BITS):
        width = min(ROUND_BITS, bits - low)
        sent = runs.mapInArrow(_round(lambda run, low=low, width=width: _sent(run, low, width, bits), opened), _RUN)
        runs, opened = sent.repartitionById(1 << bits, "dest").sortWithinPartitions("first").select("first", "records"), False
    return runs.mapInArrow(_round(_found, opened), _FOUND)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without white space. Null text counts as empty; texts without anything but white
    space are equal to each other. Of equal texts the row with most code points stays, of those the smallest doc_id
    (null after all others). Repeated rows of the id that stays are the same document, and all show kept. An empty
    table gives an empty one; other columns are left out.
    """
    rows = store(digests(docs), "digests")
    found = store(keepers(rows), "keepers")
    total = rows.count()
    joined = lookup(rows.select("doc_id", "digest"), found, "digest", "group_size", total)
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


@by_place
def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, in their own columns: one for each text, whatever its white space.

    Which one stays is as in exact_duplicates(). Of repeated rows of the id that stays, those with the most code points
    count, and of these the one whose columns hash highest, so reruns agree; repeated rows are summed up before they are
    dealt, however many there are. Null texts and texts of white space are one group; an empty table gives an empty one;
    columns of any name pass through.
    """
    sha, keep, points, best = fresh(docs, "sha", "keep", "points", "best")
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), SPACES, ""), 256)
    found = exact_duplicates(docs).filter("kept").groupBy(F.col("text_sha256").alias(sha)).agg(F.min("keep_id").alias(keep), F.first("group_size").alias(points))
    own = docs.withColumn(sha, digest)
    # Dealt by text and id, so that the copies of one text don't meet in one task.
    kept = own.join(found.withColumnRenamed(sha, best), (F.col(sha) == F.col(best)) & F.col("doc_id").cast("long").eqNullSafe(F.col(keep))).drop(best)
    # A text that occurs once needs no choice.
    alone = kept.filter(F.col(points) == 1).select(*docs.columns)
    order = F.struct(F.length(F.coalesce("text", F.lit(""))), row_hash(docs))
    chosen = kept.filter(F.col(points) > 1).groupBy(sha).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), order).alias(best))
    return alone.unionByName(chosen.select(f"{best}.*"))
