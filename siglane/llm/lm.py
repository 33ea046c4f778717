"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

The filter knows, of each unigram and bigram of the training texts, the level 1 + floor(log(count) / log(BASE)): it
holds (n-gram, 1) to (n-gram, level), so repeated probes find the level, and never less than it. It is built in pieces
by the keys' first bits, each of BITS_EACH bits for every entry that it holds, at any size of the corpus. No machine
holds the whole: the n-grams of the texts, in slices, are sent to the pieces, and what these say is sent back to the
slices. Probabilities interpolate bigrams with unigrams.

Exact unigram counts, for the base score, and levels are broadcast for the most frequent tokens, HEAD at most; those
of all others come from the pieces.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import fold_of, hashes, joined, mix, partitions, prepare, slices, store, trimmed, utf8, words

FOLDS, HELD_OUT = 7, 2
BASE = 1.5
PROBES, BITS_EACH = 3, 8
PREFIX = 10
HEAD = 1 << 21
#: Texts of about so many bytes ask together: of more, each n-gram is asked for less often.
SLICE = 12 << 20
#: n-grams that a task gathers before it sends them on.
GATHER = 6_000_000
#: n-grams that a task holds against a piece at a time.
ASK = 1 << 18
#: What a bigram's unigram probability weighs against its context's count.
PRIOR = 8.0
END = np.uint64(xxhash.xxh3_64_intdigest(b" end "))
_LOW = np.uint64(0xFFFF)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, first token of each text and the total): words, then one end for each text."""
    distinct, codes, bounds = words(texts)
    n = np.diff(bounds) + 1
    ends = np.cumsum(n)
    out = np.full(int(ends[-1]) if len(ends) else 0, END, dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[ends - 1] = False
    out[inner] = hashes(distinct)[codes]
    return out, np.concatenate([[0], ends])


def bigrams(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of neighbouring tokens of a text, place of the second). The last 16 bits of a key are zero."""
    second = np.ones(len(tokens), dtype=bool)
    second[bounds[:-1]] = False
    at = np.flatnonzero(second)
    with np.errstate(over="ignore"):
        return mix(mix(tokens[at - 1], 5) + tokens[at], 6) & ~_LOW, at


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _packed(keys: np.ndarray, counts: np.ndarray, kind: int):
    """Rows (kind, bucket, ones, keys, counts) of sorted keys; bigram keys as 6 bytes, counts only where above 1."""
    bucket = (keys >> np.uint64(64 - PREFIX)).astype(np.int64)
    bounds = np.searchsorted(bucket, np.arange((1 << PREFIX) + 1))

    def blob(x):
        raw = x.astype(">u8").view(np.uint8).reshape(-1, 8)
        return (raw[:, :6] if kind == 2 else raw).tobytes()

    rows = []
    for k in np.unique(bucket).tolist():
        own, n = keys[bounds[k] : bounds[k + 1]], counts[bounds[k] : bounds[k + 1]]
        rows.append((kind, k, blob(own[n == 1]), blob(own[n > 1]), n[n > 1].astype("<u8").tobytes()))
    return rows


def _unpacked(data: bytes, kind: int) -> np.ndarray:
    if kind == 1:
        return np.frombuffer(data, dtype=">u8").astype(np.uint64)
    raw = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    raw[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return raw.view(">u8").ravel().astype(np.uint64)


def levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


#: The count that each level stands for: the middle of those that fall into it.
VALUES = np.array([0.0] + [(math.ceil(BASE**j - 1e-9) + max(math.ceil(BASE**j - 1e-9), math.ceil(BASE ** (j + 1) - 1e-9) - 1)) / 2 for j in range(100)])


def places(keys: np.ndarray, level: int | np.ndarray, bits: np.ndarray) -> list[np.ndarray]:
    """Bit numbers of (key, level) within its piece."""
    with np.errstate(over="ignore"):
        x = mix(keys + np.asarray(level).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 21)
        y = mix(x, 22) | np.uint64(1)
        return [(x + np.uint64(i) * y) % bits for i in range(PROBES)]


class LogFilter:
    def __init__(self, pieces: dict[int, bytes]):
        sizes = np.array([len(pieces.get(k, b"\0")) for k in range(1 << PREFIX)], dtype=np.int64)
        self.first = (np.cumsum(sizes) - sizes) * 8
        self.bits = (sizes * 8).astype(np.uint64)
        self.data = np.frombuffer(b"".join(pieces.get(k, b"\0") for k in range(1 << PREFIX)), dtype=np.uint8)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level found for each key: at least its own, 0 for what was (probably) never put in."""
        out = np.zeros(len(keys), dtype=np.int64)
        bucket = (keys >> np.uint64(64 - PREFIX)).astype(np.int64)
        left, step = np.arange(len(keys)), 1
        first, bits = self.first[bucket], self.bits[bucket]
        while len(left) and step < len(VALUES):
            hit = np.ones(len(left), dtype=bool)
            for p in places(keys[left], step, bits[left]):
                at = first[left] + p.astype(np.int64)
                hit &= (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            left = left[hit]
            out[left] = step
            step += 1
        return out


_PIECE = "bucket int, bits binary, keys binary, counts binary, total long, distinct_ long, at_least array<long>"


def gather(docs: DataFrame) -> DataFrame:
    """One row for each bucket of keys: its piece of the filter, its unigrams and counts, their sum and number.

    ``docs`` (doc_id, text): every text counts whole. Tasks count their own n-grams before they send them, packed, to
    the bucket of their first PREFIX bits; a bucket's task holds one bucket at a time.
    """
    spark = prepare(docs.sparkSession)

    def batch_of(rows):
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["kind", "bucket", "ones", "keys", "counts"])

    @trimmed
    def local(batches):
        held: dict[int, list] = {1: [], 2: []}
        size = 0

        def flush():
            for kind, parts in held.items():
                if parts:
                    yield batch_of(_packed(*counted(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])), kind))
                    parts.clear()

        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in slices(texts):
                tokens, bounds = tokens_of(texts.slice(a, b - a))
                for kind, keys in ((1, tokens), (2, bigrams(tokens, bounds)[0])):
                    held[kind].append(counted(keys))
                    size += len(held[kind][-1][0])
                if size > GATHER:
                    yield from flush()
                    size = 0
        yield from flush()

    @trimmed
    def merged(batches):
        now, held = None, {1: ([], []), 2: ([], [])}

        def done():
            found = {}
            for kind, (keys, counts) in held.items():
                found[kind] = counted(np.concatenate([np.zeros(0, dtype=np.uint64), *keys]), np.concatenate([np.zeros(0, dtype=np.int64), *counts]))
                keys.clear()
                counts.clear()
            keys = np.concatenate([found[1][0], found[2][0]])
            level = levels(np.concatenate([found[1][1], found[2][1]]))
            size = max(8, int(level.sum()) * BITS_EACH // 8)
            piece = np.zeros(size, dtype=np.uint8)
            for step in range(1, int(level.max()) + 1):
                for p in places(keys[level >= step], step, np.uint64(size * 8)):
                    np.bitwise_or.at(piece, (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
            own, n = found[1]
            at_least = [int((n >= 1 << j).sum()) for j in range(48)]
            row = (now, piece.tobytes(), own.astype("<u8").tobytes(), n.astype("<i8").tobytes(), int(n.sum()), len(own), at_least)
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=["bucket", "bits", "keys", "counts", "total", "distinct_", "at_least"])

        for batch in batches:
            for kind, bucket, ones, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and bucket != now:
                    yield done()
                now = bucket
                for k, n in ((_unpacked(ones, kind), None), (_unpacked(keys, kind), np.frombuffer(counts, dtype="<u8").astype(np.int64))):
                    held[kind][0].append(k)
                    held[kind][1].append(np.ones(len(k), dtype=np.int64) if n is None else n)
        if now is not None:
            yield done()

    n = partitions(spark)
    sent = docs.mapInArrow(local, "kind int, bucket int, ones binary, keys binary, counts binary")
    dealt = sent.withColumn("__to", F.expr(f"cast((bucket * {n}) div {1 << PREFIX} as int)")).repartitionById(n, "__to").drop("__to").sortWithinPartitions("bucket")
    return store(dealt.mapInArrow(merged, _PIECE), "ngrams")


def _buckets(keys: np.ndarray) -> np.ndarray:
    """Where each bucket begins among sorted keys, and their number."""
    return np.searchsorted((keys >> np.uint64(64 - PREFIX)).astype(np.int64), np.arange((1 << PREFIX) + 1))


def _blobs(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that end at these bytes of data."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _found(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of keys in sorted ``known``, whether they are there)."""
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def _opened(sizes: bytes, one: bytes, which: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct tokens, each token as an index into them, first token of each text and the total) of a slice."""
    bounds = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, dtype="<i4"), dtype=np.int64)])
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(which), dtype=np.uint8).reshape(4, -1)
    return np.frombuffer(one, dtype="<u8"), np.ascontiguousarray(planes.T).view("<i4").ravel(), bounds


@trimmed
def _sliced(batches):
    """One row for each slice of texts: its ids, their tokens' numbers, its distinct tokens, the tokens as indices.

    The indices are packed as first bytes, second bytes and so on, of which the last are nearly all zero.
    """
    number, press = TaskContext.get().partitionId() << 40, zstandard.ZstdCompressor(level=3)
    for batch in joined(batches, SLICE):
        texts = utf8(batch.column(1))
        for a, b in slices(texts, SLICE):
            tokens, bounds = tokens_of(texts.slice(a, b - a))
            one, which = np.unique(tokens, return_inverse=True)
            row = (number, batch.column(0).slice(a, b - a).to_pylist(), np.diff(bounds).astype("<i4").tobytes(), one.astype("<u8").tobytes(), press.compress(which.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()))
            number += 1
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=["slice", "ids", "sizes", "one", "which"])


@trimmed
def _answered(batches):
    """What a bucket's piece says of the n-grams of each slice: levels, and the exact counts of unigrams."""
    own, keys, counts = LogFilter({}), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    now, asked, size = None, [], 0

    def done():
        ones, twos = [np.frombuffer(one, dtype="<u8") for _, one, _ in asked], [_unpacked(two, 2) for _, _, two in asked]
        one, two = np.concatenate(ones), np.concatenate(twos)
        at, there = _found(keys, one)
        c = np.where(there, counts[at], 0) if len(keys) else np.zeros(len(one), dtype=np.int64)
        ends1, ends2 = np.cumsum([len(x) for x in ones]), np.cumsum([len(x) for x in twos])
        columns = [pa.array([n for n, _, _ in asked], pa.int64()), pa.array([now] * len(asked), pa.int32()), _blobs(own.level(one).astype("u1"), ends1), _blobs(c.astype("<i8"), ends1 * 8), _blobs(own.level(two).astype("u1"), ends2)]
        asked.clear()
        return pa.RecordBatch.from_arrays(columns, names=["slice", "bucket", "levels1", "counts1", "levels2"])

    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            for number, bucket, one, two, bits, its_keys, its_counts in zip(*(c.to_pylist() for c in batch.slice(first, 256).columns), strict=True):
                if asked and (bucket != now or size > ASK):
                    yield done()
                    size = 0
                if bucket != now:
                    now, own, keys, counts = bucket, LogFilter({}), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
                if bits is not None:
                    own, keys, counts = LogFilter({bucket: bits}), np.frombuffer(its_keys, dtype="<u8"), np.frombuffer(its_counts, dtype="<i8")
                    continue
                asked.append((number, one, two))
                size += len(one) // 8 + len(two) // 6
    if asked:
        yield done()


def score_documents(docs: DataFrame, prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text).

    Learns from the rows whose fold isn't HELD_OUT. Null and empty texts have one token, the end. A text's first token
    has its unigram probability, each further one that of its bigram. Repeated rows count repeatedly in training and
    have equal scores. An empty table gives an empty one; other columns are left out.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = fold_of(F.col("doc_id"), FOLDS) == HELD_OUT
    learned = gather(docs.filter(~held_out))
    # 1 << PREFIX rows at most, of 48 numbers.
    pieces = learned.select("total", "distinct_", "at_least").collect()
    total, distinct = sum(r["total"] for r in pieces), sum(r["distinct_"] for r in pieces)
    above = np.sum([r["at_least"] for r in pieces], axis=0) if pieces else np.zeros(48, dtype=np.int64)
    threshold = 1 << int(np.flatnonzero(above <= HEAD)[0])

    def frequent(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, bits, keys, counts = (c[i].as_py() for c in batch.columns)
                k, n = np.frombuffer(keys, dtype="<i8"), np.frombuffer(counts, dtype="<i8")
                k, n = k[n >= threshold], n[n >= threshold]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n), pa.array(LogFilter({bucket: bits}).level(k.view(np.uint64)))], names=["key", "c", "level"])

    head = learned.select("bucket", "bits", "keys", "counts").mapInArrow(frequent, "key long, c long, level long").toArrow()
    keys, counts, level = (np.asarray(c.combine_chunks()) if c.num_chunks else np.zeros(0, dtype=np.int64) for c in head.columns)
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], counts[order], level[order].astype(np.uint8)))
    mass = total + distinct + 1

    @trimmed
    def asked(batches):
        known = shared.value[0]
        for batch in batches:
            for i in range(batch.num_rows):
                one, which, bounds = _opened(*(batch.column(k)[i].as_py() for k in (1, 2, 3)))
                two = np.unique(bigrams(one[which], bounds)[0])
                one = one[~_found(known, one)[1]]
                cuts1, cuts2 = _buckets(one), _buckets(two)
                some = np.flatnonzero(np.diff(cuts1) + np.diff(cuts2))
                columns = [pa.array(np.full(len(some), batch.column(0)[i].as_py(), dtype=np.int64)), pa.array(some.astype(np.int32)), _blobs(one.astype("<u8"), cuts1[some + 1] * 8), _blobs(two.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6], cuts2[some + 1] * 6)]
                yield pa.RecordBatch.from_arrays(columns, names=["slice", "bucket", "one", "two"])

    @trimmed
    def scored(batches):
        known, known_counts, known_levels = shared.value
        now, said = None, []

        def done():
            ids, *state = now
            one, which, bounds = _opened(*state)
            starts, n = bounds[:-1], np.diff(bounds)
            levels1, counts1, levels2 = (np.frombuffer(b"".join(s[k] for s in said), dtype=t) for k, t in enumerate(("u1", "<i8", "u1")))
            at, there = _found(known, one)
            level, c = np.zeros(len(one), dtype=np.int64), np.zeros(len(one), dtype=np.int64)
            level[there], c[there] = known_levels[at[there]], known_counts[at[there]]
            level[~there], c[~there] = levels1, counts1
            base = np.log10((c + 1.0) / mass)
            about = VALUES[level]
            keys2, second = bigrams(one[which], bounds)
            pair = np.unique(keys2, return_inverse=True)[1]
            context = about[which[second - 1]]
            both = np.minimum(VALUES[levels2][pair], context)
            p = ((about + 1) / mass)[which]
            p[second] = (both + prior * p[second]) / (context + prior)
            columns = [
                pa.array(ids, pa.int64()),
                pa.array(n.astype(np.int64)),
                pa.array(np.add.reduceat((c > 0)[which].astype(np.int64), starts)),
                pa.array(np.add.reduceat(base[which], starts)),
                pa.array(np.add.reduceat(np.log10(np.minimum(p, 1.0)), starts)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                for ids, sizes, one, which, levels1, counts1, levels2 in zip(*(c.to_pylist() for c in batch.slice(first, 256).columns[2:]), strict=True):
                    if sizes is None:
                        said.append((levels1, counts1, levels2))
                        continue
                    if now is not None:
                        yield done()
                    now, said = (ids, sizes, one, which), []
        if now is not None:
            yield done()

    parts = store(docs.mapInArrow(_sliced, "slice long, ids array<long>, sizes binary, one binary, which binary"), "slices", compression="none")
    sent = parts.select("slice", "sizes", "one", "which").mapInArrow(asked, "slice long, bucket int, one binary, two binary")
    # A bucket's piece comes first, then the slices that ask it.
    sent = learned.select(F.lit(-1).cast("long").alias("slice"), "bucket", "bits", "keys", "counts").unionByName(sent, allowMissingColumns=True)
    n = partitions(spark)
    dealt = sent.withColumn("__to", F.expr(f"cast((bucket * {n}) div {1 << PREFIX} as int)")).repartitionById(n, "__to").sortWithinPartitions("bucket", "slice")
    said = dealt.select("slice", "bucket", "one", "two", "bits", "keys", "counts").mapInArrow(_answered, "slice long, bucket int, levels1 binary, counts1 binary, levels2 binary")
    # A slice comes first, then what the pieces say, in the order of its keys.
    back = parts.withColumn("bucket", F.lit(-1)).unionByName(said, allowMissingColumns=True).repartition(n, "slice").sortWithinPartitions("slice", "bucket")
    rows = back.select("slice", "bucket", "ids", "sizes", "one", "which", "levels1", "counts1", "levels2").mapInArrow(scored, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return rows.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
