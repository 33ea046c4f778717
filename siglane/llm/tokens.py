"""Token ids in Simple-8b words: a file format for ids, its coder, and the corpus encoder.

A stream of unsigned ids is cut into blocks of BLOCK ids. Each block is a run of 64-bit words whose top four bits
are a selector: how many ids the word holds, and in how many bits each. Selectors 0 and 1 stand for runs of 240 and
120 zeros. Selector 15 is an escape: the next word is one raw id, for ids of more than 60 bits. A block starts at
its own word, listed in the segment's offsets, so that blocks decode on their own and all at once.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import partitions, prepare, slices, store, trimmed, utf8

BLOCK = 1024
END_ID = 0
#: Ids in each word, and bits of each, by selector. Fixed values of the format.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
ESCAPE = 15
#: The last selector doubles as the single 60-bit id: its payload's top bit says that a raw word follows.
RAW = np.uint64(1) << np.uint64(59)
LARGEST = (1 << 59) - 1
MAGIC = b"S8B1"


_WIDTHS = np.array([x.bit_length() for x in range(1 << 16)], dtype=np.uint8)


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    if len(ids) and ids.max() < len(_WIDTHS):
        return _WIDTHS[ids]
    out = np.zeros(len(ids), dtype=np.uint8)
    left = ids.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = left >= (np.uint64(1) << np.uint64(step))
        out[big] += step
        left[big] >>= np.uint64(step)
    return out + (left > 0)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets): the words of all blocks, and the first word of each block with the total at the end."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    wide = widths(ids)
    # Blocks step in lockstep: at each step every block that isn't done packs one word from its place on. What fits
    # into a word of many ids also fits into one of fewer, so each tries longer words until one doesn't fit.
    place = np.arange(0, n, BLOCK, dtype=np.int64)
    ends, steps = np.minimum(place + BLOCK, n), []
    while len(place):
        choice = np.full(len(place), ESCAPE, dtype=np.int64)
        alive, peak, seen = np.arange(len(place)), wide[place], 1
        for s in range(ESCAPE - 1, -1, -1):
            roomy = ends[alive] - place[alive] >= COUNTS[s]
            alive, peak = alive[roomy], peak[roomy]
            for j in range(seen, COUNTS[s]):
                peak = np.maximum(peak, wide[place[alive] + j])
            fits = peak <= BITS[s]
            alive, peak, seen = alive[fits], peak[fits], COUNTS[s]
            if not len(alive):
                break
            choice[alive] = s
        steps.append((place, choice))
        place = place + COUNTS[choice]
        more = place < ends
        place, ends = place[more], ends[more]
    at = np.concatenate([p for p, _ in steps])
    order = np.argsort(at)
    at, chosen = at[order], np.concatenate([c for _, c in steps])[order]
    raw = (chosen == ESCAPE) & (ids[at] > LARGEST)
    slot = np.arange(len(at)) + np.concatenate([[0], np.cumsum(raw)[:-1]])
    words = np.zeros(len(at) + int(raw.sum()), dtype=np.uint64)
    for s in np.unique(chosen):
        own = chosen == s
        word = np.full(int(own.sum()), np.uint64(int(s)) << np.uint64(60), dtype=np.uint64)
        if s == ESCAPE:
            word |= np.where(raw[own], RAW, ids[at[own]])
        elif BITS[s]:
            for k in range(COUNTS[s]):
                word |= ids[at[own] + k] << np.uint64(k * BITS[s])
        words[slot[own]] = word
    words[slot[raw] + 1] = ids[at[raw]]
    first = np.searchsorted(at, np.arange(0, n, BLOCK))
    return words, np.append(slot[first], len(words)).astype(np.int64)


def decode(words: np.ndarray, offsets: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of blocks first to last (all by default), many words at a time."""
    offsets = offsets[first : (len(offsets) - 1 if last is None else last) + 1]
    words = words[offsets[0] : offsets[-1]]
    selector = (words >> np.uint64(60)).astype(np.int64)
    follows = np.zeros(len(words), dtype=bool)
    suspects = np.flatnonzero((selector == ESCAPE) & ((words & RAW) > 0))
    for i in suspects.tolist():  # a raw word may itself look like an escape
        follows[i + 1 : i + 2] = not follows[i]
    heads = np.flatnonzero(~follows)
    sel, word = selector[heads], words[heads]
    ends = np.cumsum(COUNTS[sel])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    starts = ends - COUNTS[sel]
    for s in np.unique(sel):
        own = sel == s
        if s == ESCAPE:
            value = word[own] & np.uint64(LARGEST)
            raw = (word[own] & RAW) > 0
            value[raw] = words[heads[own][raw] + 1]
            out[starts[own]] = value
        elif BITS[s]:
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for k in range(COUNTS[s]):
                out[starts[own] + k] = (word[own] >> np.uint64(k * BITS[s])) & mask
    return out


def pack(ids: np.ndarray) -> bytes:
    """One segment of a file: magic, counts of ids and blocks, block offsets, words; little-endian."""
    words, offsets = encode(ids)
    head = np.array([len(ids), len(offsets)], dtype="<i8")
    return MAGIC + b"\0\0\0\0" + head.tobytes() + offsets.astype("<i8").tobytes() + words.astype("<u8").tobytes()


def unpack(data: bytes) -> np.ndarray:
    if data[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    n, k = np.frombuffer(data, dtype="<i8", count=2, offset=8)
    ids = decode(np.frombuffer(data, dtype="<u8", offset=24 + 8 * k), np.frombuffer(data, dtype="<i8", count=k, offset=24))
    if len(ids) != n:
        raise ValueError(f"segment of {n} ids decodes to {len(ids)}")
    return ids


class IdCache:
    """Ids of short pieces, found by 128 bits of hash: the first MOST pieces that come, which are the frequent ones.

    Pieces up to SHORT bytes are hashed by tables of random words, one for each place and byte (two such hashes, both of
    which must be equal). Arrays of some 50 MB hold them; looking up a slice's pieces makes no Python objects.
    """

    MOST, SHORT = 1 << 20, 32

    def __init__(self):
        self.tables = np.random.default_rng(1).integers(0, 1 << 64, (2, 256 * self.SHORT), dtype=np.uint64)
        self.keys, self.checks = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        self.first, self.size, self.flat = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def hashed(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, check, whether it is short enough) of each piece; none is empty."""
        offsets = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.int32)
        sizes, starts = np.diff(offsets), offsets[:-1] - offsets[0]
        place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
        data += np.minimum(place, self.SHORT - 1) * 256
        return *(np.bitwise_xor.reduceat(t[data], starts) for t in self.tables), sizes <= self.SHORT

    def get(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Where each piece is kept, -1 for those that aren't."""
        if not len(self.keys):
            return np.full(len(key), -1, dtype=np.int64)
        order = np.argsort(key)
        at = np.empty(len(key), dtype=np.int64)
        at[order] = np.searchsorted(self.keys, key[order])
        at = np.minimum(at, len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (self.checks[at] == check), at, -1)

    def put(self, key: np.ndarray, check: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        room = max(0, self.MOST - len(self.keys))
        key, check, size = key[:room], check[:room], size[:room]
        if not len(key):
            return
        keys = np.concatenate([self.keys, key])
        order = np.argsort(keys, kind="stable")
        self.keys, self.checks = keys[order], np.concatenate([self.checks, check])[order]
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])[order]
        self.size, self.flat = np.concatenate([self.size, size])[order], np.concatenate([self.flat, flat[: int(size.sum())]])


class ByteEncoder:
    """Encodes whole texts as the tokenizers library does by default, each distinct piece of a slice once.

    Byte-level pre-tokens never run across a blank that a visible character follows, so a text may be cut before
    such blanks without any change of its ids. Python's white space holds all that the library counts as white
    space; a text with a blank before one of these is given to the library whole, and so is one that holds the name
    of an added token, which the library finds before it cuts anything.
    """

    #: Pieces that the library is given in one text.
    TOGETHER = 2000

    def __init__(self, path: str):
        # A task has one core; the library's own threads would be too many, with memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        spec = json.loads(self.tool.to_str())
        cut, model = spec["pre_tokenizer"] or {}, spec["model"]
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex") or spec["normalizer"] or model["type"] != "BPE" or model["ignore_merges"]:
            raise ValueError(f"{path} isn't a plain byte-level tokenizer")
        self.known = IdCache()
        self.marks = {c: self.tool.encode(c, add_special_tokens=False).ids for c in ",.;:!?"}
        self.added = [t["content"] for t in spec["added_tokens"]]
        # Where byte 32 stands in the alphabet of byte-level pieces; blanks are nowhere but in front of a piece.
        self.opens = np.zeros(self.tool.get_vocab_size(), dtype=bool)
        for token, k in self.tool.get_vocab().items():
            self.opens[k] = token.startswith("\u0120") and token not in self.added

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each), by the library."""
        found = [x.ids for x in self.tool.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32, count=int(n.sum())), n

    def fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces with a blank before each, number of ids of each), by the library.

        A piece of ASCII letters is one pre-token, and a punctuation mark after it another: they go to the library's model
        at once. It is given all others many in one text, which it cuts before each blank; an id that begins with a
        blank begins a piece.
        """
        found: list = [None] * len(pieces)
        tokenize, rest = self.tool.model.tokenize, []
        for k, p in enumerate(pieces):
            if p.isascii() and p.isalpha():
                found[k] = [t.id for t in tokenize("\u0120" + p)]
            elif p.isascii() and p[-1] in self.marks and p[:-1].isalpha():
                found[k] = [t.id for t in tokenize("\u0120" + p[:-1])] + self.marks[p[-1]]
            else:
                rest.append(k)
        flat, _ = self.plain([" " + " ".join([pieces[k] for k in rest[i : i + self.TOGETHER]]) for i in range(0, len(rest), self.TOGETHER)])
        starts = np.flatnonzero(self.opens[flat]).tolist()
        if len(starts) != len(rest):
            raise ValueError("the library doesn't cut before each blank")
        flat = flat.tolist()
        for k, a, b in zip(rest, starts, [*starts[1:], len(flat)][: len(rest)], strict=True):
            found[k] = flat[a:b]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32, count=int(size.sum())), size

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct pieces with a blank before each, number of ids of each)."""
        key, check, short = self.known.hashed(pieces)
        at = np.where(short, self.known.get(key, check), -1)
        new = np.flatnonzero(at < 0)
        flat, fresh = self.fresh(pieces.take(pa.array(new)).to_pylist())
        starts = np.cumsum(fresh) - fresh
        size, first = np.empty(len(pieces), dtype=np.int64), np.empty(len(pieces), dtype=np.int64)
        old = np.flatnonzero(at >= 0)
        size[new], first[new] = fresh, len(self.known.flat) + starts
        size[old], first[old] = self.known.size[at[old]], self.known.first[at[old]]
        both = np.concatenate([self.known.flat, flat]) if len(old) else flat
        if not len(old):
            first -= len(self.known.flat)
        keep = short[new]
        self.known.put(key[new][keep], check[new][keep], flat[np.repeat(keep, fresh)], fresh[keep])
        return both[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))], size

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        parts = pc.split_pattern(texts, " ")
        bounds = np.asarray(parts.offsets, dtype=np.int64)
        bounds = bounds - bounds[0]
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        pieces = coded.dictionary
        heads = pc.utf8_slice_codeunits(coded.dictionary, 0, 1).dictionary_encode()
        odd = np.array([not c or c.isspace() or "\x1c" <= c <= "\x1f" for c in heads.dictionary.to_pylist()], dtype=bool)[heads.indices.to_numpy(zero_copy_only=False)]
        # A text's first piece has no blank before it; a text with an odd later piece goes whole.
        inner = odd[codes]
        inner[bounds[:-1]] = False
        whole = np.add.reduceat(inner.astype(np.int64), bounds[:-1]) > 0
        for name in self.added:
            whole |= np.asarray(pc.match_substring(texts, name))
        firsts = pieces.take(pa.array(codes[bounds[:-1]])).to_pylist()
        for i in np.flatnonzero(whole).tolist():
            firsts[i] = texts[i].as_py()
        used = np.zeros(len(pieces), dtype=bool)
        later = np.repeat(~whole, np.diff(bounds))
        later[bounds[:-1]] = False
        used[codes[later]] = True
        size = np.zeros(len(pieces) + len(texts), dtype=np.int64)
        flat, size[: len(pieces)][used] = self.pieces(pieces.filter(pa.array(used))) if used.any() else (np.zeros(0, dtype=np.uint32), 0)
        own, size[len(pieces) :] = self.plain(firsts)
        flat = np.concatenate([flat, own])
        start = np.cumsum(size) - size
        codes[bounds[:-1]] = np.arange(len(texts)) + len(pieces)
        n = size[codes]
        later[bounds[:-1]] = True
        n[~later] = 0
        at = np.repeat(start[codes] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return flat[at], np.add.reduceat(n, bounds[:-1])


_encoders: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


#: Bytes of text that make a segment. Of twice as many, each piece comes less often anew.
SEGMENT_BYTES = 4 << 20
SEGMENT_SCHEMA = "part int, seq long, doc_id array<long>, n_tokens array<long>, data binary"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Files of packed ids of ``docs`` (doc_id, text) in ascending doc_id order, as the table of their segments.

    Rows are dealt by range of doc_id and sorted within each range; a task writes its range as segments, numbered by
    ``part`` (the range) and ``seq``. Null text counts as empty, null doc_id comes first; rows of one doc_id follow
    each other by text. A segment holds whole documents, of a few MB of text or a single longer one. An empty table
    gives no segment; other columns are left out.
    """
    spark = prepare(docs.sparkSession)

    @trimmed
    def encoded(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in slices(texts, SEGMENT_BYTES):
                ids, n = encoder(tokenizer).batch(texts.slice(a, b - a))
                n = n + 1
                out = np.full(int(n.sum()), end_id, dtype=np.uint64)
                inner = np.ones(len(out), dtype=bool)
                inner[np.cumsum(n) - 1] = False
                out[inner] = ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seq]), pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())), pa.array([pack(out)], pa.binary())],
                    names=["part", "seq", "doc_id", "n_tokens", "data"],
                )
                seq += 1

    ordered = docs.select("doc_id", "text").repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    return store(ordered.mapInArrow(encoded, SEGMENT_SCHEMA), "tokens", compression="none")


def read_tokens(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, decoded from the segments of write_tokens().

    Where a range starts follows from the token counts of the ranges before, one number for each range. No segments
    give an empty table.
    """
    spark = segments.sparkSession
    totals = segments.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda x, y: x + y).alias("n")).groupBy("part").agg(F.sum("n").alias("n")).collect()
    base, so_far = {}, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        base[r["part"]] = so_far
        so_far += r["n"]
    starts = spark.createDataFrame(list(base.items()) or [(0, 0)], "part int, base long")
    within = segments.select("part", "seq", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda x, y: x + y).alias("n"))
    from pyspark.sql import Window

    offsets = within.withColumn("before", F.sum("n").over(Window.partitionBy("part").orderBy("seq")) - F.col("n")).join(F.broadcast(starts), "part")
    placed = offsets.select("part", "seq", (F.col("base") + F.col("before")).alias("start"))

    @trimmed
    def decoded(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                part, seq, docs, sizes, data = (c[k].as_py() for c in batch.columns)
                ids = unpack(data).astype("<u4")
                n = np.array(sizes, dtype=np.int64)
                ends = np.cumsum(n)
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int32()), pa.array([seq] * len(docs), pa.int64()), pa.array(docs, pa.int64()), pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    rows = segments.mapInArrow(decoded, "part int, seq long, doc_id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(placed, ["part", "seq"]).select("doc_id", (F.col("start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
