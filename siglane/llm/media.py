"""Media columns: payloads cut by content, chunks stored once, media put together again and verified.

A payload becomes a sound of 8-bit samples (a WAVE header of 44 bytes and the payload). Its samples are cut where a
rolling gear hash of the last 32 bytes ends in CUT_BITS zeros, not below LEAST and at MOST bytes at the latest. A
medium is kept as a row with its header and the ordered list of its chunks' digests and lengths. A chunk that occurs
once in the corpus is kept within that row; any other is kept once, in the chunk store, and found there by its digest.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm import bloom
from siglane.llm.common import HOT_SHARE, lookup, mix, partitions, prepare, slices, store, trimmed, utf8

UNIT = 64
LEAST, CUT_BITS, MOST = 512, 11, 16384
RATE = 8000
_GEAR = (mix(np.arange(256, dtype=np.uint64), 7) >> np.uint64(32)).astype(np.uint32)


def wave_header(n: int) -> bytes:
    """Header of n mono samples of 8 bits."""
    return b"RIFF" + struct.pack("<I", (36 + n) & 0xFFFFFFFF) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", n & 0xFFFFFFFF)


def payload(data: bytes) -> bytes:
    """Zero bytes fill up to a positive multiple of UNIT."""
    return data + b"\0" * (-len(data) % UNIT if data else UNIT)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: each of the last 32 bytes' random numbers, shifted by its age, summed."""
    h = _GEAR[data]
    step = 1
    while step < 32:
        older = h[:-step] << np.uint32(step)
        h[step:] += older
        step *= 2
    return h


#: Bytes that are hashed at once, after the REACH bytes before them that their hashes still count.
WINDOW, REACH = 1 << 20, 31


def _places(whole: np.ndarray) -> np.ndarray:
    """Where a chunk may end. Hashes take some twenty times their bytes, so they are made window by window."""
    found = [np.zeros(0, dtype=np.int64)]
    for a in range(0, len(whole), WINDOW):
        start = max(0, a - REACH)
        at = np.flatnonzero((gear(whole[start : a + WINDOW]) & np.uint32((1 << CUT_BITS) - 1)) == 0) + start
        found.append(at[at >= a] + 1)
    return np.concatenate(found)


def cuts(payloads: list[bytes]) -> list[list[int]]:
    """Where the chunks of each payload end. All are hashed together: a chunk's first LEAST bytes are never an end, so
    no hash counts that reaches back into another payload."""
    whole = np.frombuffer(payloads[0] if len(payloads) == 1 else b"".join(payloads), dtype=np.uint8)
    places = _places(whole)
    ends = np.cumsum([len(p) for p in payloads])
    starts = ends - [len(p) for p in payloads]
    low, high = np.searchsorted(places, starts, side="right"), np.searchsorted(places, ends, side="left")
    out = []
    for start, end, a, b in zip(starts.tolist(), ends.tolist(), low.tolist(), high.tolist(), strict=True):
        last, found = start, []
        for place in places[a:b].tolist():
            while place - last > MOST:
                last += MOST
                found.append(last - start)
            if place - last >= LEAST:
                last = place
                found.append(last - start)
        while end - last > MOST:
            last += MOST
            found.append(last - start)
        if end > last:
            found.append(end - start)
        out.append(found)
    return out


#: Texts of about so many bytes are chunked at a time.
TOGETHER = 1 << 20


def _chunks(batches):
    """(doc_ids, unpadded bytes, payloads, chunk digests, chunk bounds) of slices of Arrow batches."""
    for batch in batches:
        texts = utf8(batch.column(1))
        for a, b in slices(texts, TOGETHER):
            own = texts.slice(a, b - a)
            full = [payload(x) for x in own.cast(pa.large_binary()).to_pylist()]
            bounds = [[0, *c] for c in cuts(full)]
            digests = [[hashlib.sha256(memoryview(p)[x:y]).digest() for x, y in zip(c[:-1], c[1:], strict=True)] for p, c in zip(full, bounds, strict=True)]
            yield batch.column(0).slice(a, b - a).cast(pa.int64()), pc.binary_length(own).cast(pa.int64()), full, digests, bounds


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


_MANIFEST = "doc_id long, media_sha binary, n_bytes long, head binary, lengths array<int>, digests binary, shared binary, own binary"
_CHUNK = "digest binary, data binary"
_BOTH = pa.schema([("doc_id", pa.int64()), ("media_sha", pa.binary()), ("n_bytes", pa.int64()), ("head", pa.binary()), ("lengths", pa.list_(pa.int32())), ("digests", pa.binary()), ("shared", pa.binary()), ("own", pa.binary()), ("digest", pa.binary()), ("data", pa.binary())])


def write_media(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(manifest, chunk store) of the texts of ``docs`` (doc_id, text); null text counts as empty.

    The manifest has a row for each row of docs, repeated rows and those without doc_id too. Its ``shared`` has a byte
    for each chunk, 1 where the chunk is in the store, and ``own`` the compressed bytes of all others. A first pass
    counts chunk digests; those that occur more than once go into a Bloom filter of a fixed size, by which a second pass
    tells them. A chunk that passes it by chance is stored like a shared one, so the filter's errors cost room only.
    The store has digest, data and uses, which is larger than 0 for the digests with a large share of the uses of all
    shared chunks: HOT_SHARE at most, however long the texts.
    An empty table gives an empty manifest and store; other columns are left out. A text must fit into a row of Arrow
    data (2 GB), and a worker holds some copies of the longest.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")

    @trimmed
    def keys(batches):
        for _, _, _, digests, _ in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([_key(d) for own in digests for d in own], pa.int64())], names=["key"])

    counts = store(docs.mapInArrow(keys, "key long").groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "chunk-counts")
    all_uses = counts.agg(F.sum("n")).first()[0] or 0
    known = spark.sparkContext.broadcast(bloom.build(counts, "key").bits)

    def is_shared(digests: list[list[bytes]]) -> list[np.ndarray]:
        has = bloom.Filter({}, 1)
        has.bits = known.value
        flat = has.has(np.array([_key(d) for own in digests for d in own], dtype=np.int64).view(np.uint64))
        return np.split(flat, np.cumsum([len(own) for own in digests])[:-1])

    def both(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _BOTH], schema=_BOTH)

    @trimmed
    def written(batches):
        """Manifest rows, and each slice's shared chunks once."""
        press = zstandard.ZstdCompressor(level=6)
        for ids, sizes, full, digests, bounds in _chunks(batches):
            shared = is_shared(digests)
            heads = [wave_header(len(p)) for p in full]
            own = [press.compress(b"".join(p[x:y] for x, y, s in zip(c[:-1], c[1:], f.tolist(), strict=True) if not s)) for p, c, f in zip(full, bounds, shared, strict=True)]
            sums = []
            for h, p in zip(heads, full, strict=True):
                whole = hashlib.sha256(h)
                whole.update(p)
                sums.append(whole.digest())
            yield both(
                {
                    "doc_id": ids,
                    "media_sha": pa.array(sums, pa.binary()),
                    "n_bytes": sizes,
                    "head": pa.array(heads, pa.binary()),
                    "lengths": pa.array([np.diff(c).tolist() for c in bounds], pa.list_(pa.int32())),
                    "digests": pa.array([b"".join(d) for d in digests], pa.binary()),
                    "shared": pa.array([f.astype(np.uint8).tobytes() for f in shared], pa.binary()),
                    "own": pa.array(own, pa.binary()),
                },
                len(full),
            )
            found = {d: p[x:y] for p, own_, c, f in zip(full, digests, bounds, shared, strict=True) if f.any() for d, x, y, s in zip(own_, c[:-1], c[1:], f.tolist(), strict=True) if s}
            if found:
                yield both({"digest": pa.array(list(found), pa.binary()), "data": pa.array([press.compress(x) for x in found.values()], pa.binary())}, len(found))

    def once(batches):
        last = None
        for batch in batches:
            keep = []
            for i, d in enumerate(batch.column(0).to_pylist()):
                if d != last:
                    keep.append(i)
                    last = d
            yield batch.take(pa.array(keep, pa.int64()))

    rows = store(docs.mapInArrow(written, f"{_MANIFEST}, {_CHUNK}"), "media", compression="none")
    manifest = rows.filter("digest is null").drop("digest", "data")
    dealt = rows.filter("digest is not null").select("digest", "data").repartition(partitions(spark), "digest").sortWithinPartitions("digest")
    hot = counts.filter(F.col("n") * HOT_SHARE > F.lit(all_uses)).select(F.col("key").alias("hot"), F.col("n").alias("uses"))
    chunks = dealt.mapInArrow(trimmed(once), _CHUNK)
    key = F.conv(F.substring(F.hex("digest"), 1, 16), 16, -10).cast("long")
    chunks = chunks.join(F.broadcast(hot), key == F.col("hot"), "left").select("digest", "data", F.coalesce("uses", F.lit(0)).alias("uses"))
    return manifest, store(chunks, "chunks", compression="none")


_FEATURES = "media_sha binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def feature(samples: np.ndarray, chunks: int) -> str:
    """Loudness, peak and zero crossings of 8-bit samples around their middle, in whole numbers."""
    counts, level = np.bincount(samples, minlength=256), np.arange(256) - 128
    low = samples < 128
    return f"sum={int((counts * level).sum())};energy={int((counts * level * level).sum())};peak={int(np.abs(level[counts > 0]).max())};crossings={int(np.count_nonzero(low[1:] != low[:-1]))};chunks={chunks}"


def _verified(media_sha: bytes, head: bytes, digests: bytes, chunks: list[bytes]) -> tuple:
    """Features of a medium put together from its chunks; raises if a chunk or the whole isn't what was stored."""
    for k, c in enumerate(chunks):
        if hashlib.sha256(c).digest() != digests[32 * k : 32 * k + 32]:
            raise ValueError("a chunk differs from its digest")
    samples = b"".join(chunks)
    digest = hashlib.sha256(head)
    digest.update(samples)
    whole = digest.digest()
    if whole != media_sha or head != wave_header(len(samples)):
        raise ValueError("a medium differs from its digest")
    return media_sha, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-UNIT:]), len(head) + len(samples), whole.hex(), feature(np.frombuffer(samples, dtype=np.uint8), len(chunks))


def _split_own(lengths: list[int], shared: bytes, own: bytes) -> list[bytes | None]:
    data, at, out = zstandard.ZstdDecompressor().decompress(own), 0, []
    for n, s in zip(lengths, shared, strict=True):
        out.append(None if s else data[at : at + n])
        at += 0 if s else n
    return out


def _record(rows: list[tuple], extra: list[pa.Array] | None = None, names: list[str] | None = None) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays((extra or []) + columns, names=(names or []) + [x.split()[0] for x in _FEATURES.split(", ")])


def read_media(manifest: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row for each row of the manifest: doc_id, n_bytes and what is computed from the bytes read back.

    Media with all their chunks in their own row are put together where they are read. Of the others, each distinct
    medium fetches its shared chunks from the store by a join on the digest, is put together once, and its features go
    to all rows that have it. Equal texts have equal values; an empty table gives an empty one.
    """
    spark = manifest.sparkSession
    names = ["media_sha", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    has_shared = F.instr(F.hex("shared"), "01") > 0

    @trimmed
    def whole(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sha, head, lengths, digests, shared, own = (part.column(k).to_pylist() for k in range(2, 8))
                rows = [_verified(s, h, d, _split_own(n, f, o)) for s, h, n, d, f, o in zip(sha, head, lengths, digests, shared, own, strict=True)]
                yield _record(rows, [part.column(0), part.column(1)], ["doc_id", "n_bytes"])

    def listed(batches):
        """(medium, place, digest) of each shared chunk."""
        for batch in batches:
            for sha, digests, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.flatnonzero(np.frombuffer(shared, dtype=np.uint8))
                all_ = np.frombuffer(digests, dtype="V32")[at]
                yield pa.RecordBatch.from_arrays([pa.array([sha] * len(at), pa.binary()), pa.array(at.astype(np.int32)), pa.array([x.tobytes() for x in all_], pa.binary())], names=["media_sha", "place", "digest"])

    alone = manifest.filter(~has_shared).select("doc_id", "n_bytes", "media_sha", "head", "lengths", "digests", "shared", "own").mapInArrow(whole, f"doc_id long, n_bytes long, {_FEATURES}")
    rest = manifest.filter(has_shared)
    copies = rest.groupBy("media_sha").agg(F.count("*").alias("copies"))
    media = rest.select("media_sha", "head", "lengths", "digests", "shared", "own").dropDuplicates(["media_sha"])
    wanted = rest.select("media_sha", "digests", "shared").dropDuplicates(["media_sha"]).mapInArrow(trimmed(listed), "media_sha binary, place int, digest binary")
    total = rest.count()
    fetched = lookup(wanted, chunks, "digest", "uses", 0)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("head", "binary"), ("lengths", "array<int>"), ("digests", "binary"), ("shared", "binary"))]
    parts = media.select("media_sha", F.lit(-1).alias("place"), F.col("own").alias("data"), "head", "lengths", "digests", "shared").unionByName(fetched.select("media_sha", "place", "data", *none))
    parts = parts.repartition(partitions(spark), "media_sha").sortWithinPartitions("media_sha", "place")

    @trimmed
    def assembled(batches):
        press = zstandard.ZstdDecompressor()
        now: tuple | None = None

        def done():
            sha, head, digests, found = now
            if any(c is None for c in found):
                raise ValueError("a chunk is missing from the store")
            return _verified(sha, head, digests, found)

        for batch in batches:
            rows = []
            for sha, place, data, head, lengths, digests, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place < 0:
                    if now:
                        rows.append(done())
                    now = (sha, head, digests, _split_own(lengths, shared, data))
                else:
                    now[3][place] = press.decompress(data)
            yield _record(rows)
        if now:
            yield _record([done()])

    made = store(parts.mapInArrow(assembled, _FEATURES).join(copies, "media_sha"), "features")
    shared_rows = lookup(rest.select("doc_id", "n_bytes", "media_sha"), made, "media_sha", "copies", total)
    return alone.select("doc_id", "n_bytes", *names[1:]).unionByName(shared_rows.select("doc_id", "n_bytes", *names[1:]))
