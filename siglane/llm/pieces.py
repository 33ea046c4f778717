"""Encoding and decoding by merge-type SentencePiece vocabularies, with an agenda of symbol pairs of our own.

A text is normalised by the library and cut before each blank sign that a non-blank precedes (no piece of the vocabulary
may run across such a place, which is looked up; where one does, a text is one cut). Each distinct cut of a slice is
merged once. A cut's agenda holds all adjacent symbol pairs that form a piece; the best score goes first, of equal
scores the leftmost, and the merged symbol's new pairs join the agenda. Cuts of up to SHORT symbols are merged in
lockstep, a row of a matrix each; longer ones have a heap. What no piece covers falls back to bytes.

The library encodes every whole text too, batch by batch. Where it disagrees its ids are taken, and the row says so.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from siglane.llm.common import prepare, slices, trimmed, utf8

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Cuts of more symbols than this are merged one by one.
SHORT = 48
#: Symbols that are merged in lockstep at a time.
CELLS = 1 << 18


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + n]
            at += n


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class PieceEncoder:
    """ids of texts by the vocabulary at ``path``; begin and end ids are put around each text's."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        byte_ids = np.full(256, -1, dtype=np.int64)
        kinds = set()
        with open(path, "rb") as f:
            pieces = [dict(_fields(v)) for k, v in _fields(f.read()) if k == 1]
        for i, p in enumerate(pieces):
            text, kind = p[1].decode(), p.get(3, NORMAL)
            kinds.add(kind)
            if kind == NORMAL:
                self.ids[text] = i
                self.cost[text] = -struct.unpack("<f", p[2])[0]
            elif kind == BYTE:
                byte_ids[int(text[3:-1], 16)] = i
        if kinds & {USER_DEFINED, UNUSED} or (byte_ids < 0).any():
            raise ValueError("only merge-type vocabularies with all 256 bytes and without user-defined or unused pieces")
        self.byte_ids = byte_ids
        self.safe = not any(re.search(f"[^{BLANK}]{BLANK}", t) for t in self.ids)
        self.n = len(pieces)
        # A symbol is a piece's id, or n + its code point for a character that is no piece.
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.n
        for t, i in self.ids.items():
            if len(t) == 1:
                self.of_char[ord(t)] = i
        rank = {c: k for k, c in enumerate(sorted(set(self.cost.values())))}
        pairs = [(left * (1 << 32) + right, rank[self.cost[t]], i) for t, i in self.ids.items() for j in range(1, len(t)) if (left := self._symbol(t[:j])) is not None and (right := self._symbol(t[j:])) is not None]
        pairs.sort()
        self.pairs, self.rank, self.merged = (np.array([p[k] for p in pairs], dtype=np.int64) for k in range(3))
        self.none = np.int64(len(rank))

    def _symbol(self, text: str) -> int | None:
        return self.ids.get(text, self.n + ord(text) if len(text) == 1 else None)

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of each pair's piece or ``none``, the piece's id)."""
        key = (left.astype(np.int64) << 32) + right
        at = np.minimum(np.searchsorted(self.pairs, key), max(0, len(self.pairs) - 1))
        there = self.pairs[at] == key if len(self.pairs) else np.zeros(len(key), dtype=bool)
        return np.where(there, self.rank[at] if len(self.pairs) else 0, self.none), self.merged[at] if len(self.pairs) else at

    def merge(self, text: str) -> list[int]:
        """Symbols of a normalised text, by the agenda in a heap."""
        symbols: list[str] = list(text)
        n, cost = len(symbols), self.cost
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            c = cost.get(pair := symbols[i] + symbols[i + 1])
            if c is not None:
                agenda.append((c, i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or after[left] != right or len(symbols[left]) + len(symbols[right]) != len(pair):
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = pair, ""
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                c = cost.get(new := pair + symbols[following])
                if c is not None:
                    heapq.heappush(agenda, (c, left, following, new))
            if (previous := before[left]) >= 0:
                c = cost.get(new := symbols[previous] + pair)
                if c is not None:
                    heapq.heappush(agenda, (c, previous, left, new))
        return [self._symbol(s) for s in symbols if s]

    def _lockstep(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols left of all rows, number of each row's); rows hold symbols, -1 where a row is shorter."""
        n, width = rows.shape
        size = (rows >= 0).sum(axis=1)
        out, left = rows.copy(), np.arange(n)
        rank, piece = (x.reshape(n, max(0, width - 1)) for x in self._ranked(rows[:, :-1].ravel(), rows[:, 1:].ravel()))
        while len(left) and width > 1:
            best = rank.argmin(axis=1)
            every = np.arange(len(left))
            found = rank[every, best] < self.none
            if not found.all():
                out[left[~found], :width] = rows[~found]
                left, rows, rank, piece, best, every = left[found], rows[found], rank[found], piece[found], best[found], np.arange(int(found.sum()))
                if not len(left):
                    break
            rows[every, best] = piece[every, best]
            size[left] -= 1
            # What stands right of the pair moves one place to the left.
            moved = np.arange(width - 1)
            moved = moved + (moved > best[:, None])
            rows = np.take_along_axis(rows, moved, axis=1)
            moved = np.arange(width - 2)
            moved = moved + (moved >= best[:, None])
            rank, piece = np.take_along_axis(rank, moved, axis=1), np.take_along_axis(piece, moved, axis=1)
            width -= 1
            for step in (0, 1):  # the new symbol with the one after it, then with the one before it
                own = np.flatnonzero(best < width - 1) if not step else np.flatnonzero(best > 0)
                at = best[own] - step
                rank[own, at], piece[own, at] = self._ranked(rows[own, at], rows[own, at + 1])
            out[left, width] = -1
        if len(left):
            out[left, :width] = rows
        return out[out >= 0], size

    def cuts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct cuts, the cuts as indices into them, first cut of each text and the total) of normalised texts."""
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        starts = offsets[:-1][np.diff(offsets) > 0]
        if self.safe and len(starts):
            data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[: offsets[-1]]
            sign = np.frombuffer(BLANK.encode(), dtype=np.uint8)
            blank = np.flatnonzero((data[:-2] == sign[0]) & (data[1:-1] == sign[1]) & (data[2:] == sign[2]))
            blank = blank[blank >= offsets[0]]
            follows = np.diff(blank, prepend=-9) == len(sign)
            starts = np.sort(np.concatenate([starts, blank[~follows]]), kind="stable")
            starts = starts[np.diff(starts, prepend=-1) > 0]
        if not len(starts):
            return pa.array([], pa.large_string()), np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
        ends = np.append(starts, offsets[-1])
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), texts.buffers()[2]]).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(starts, offsets)

    def symbols(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all cuts, number of each cut's)."""
        size = np.asarray(pc.utf8_length(cuts)).astype(np.int64)
        points = np.frombuffer("".join(cuts.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        starts = np.cumsum(size) - size
        order = np.argsort(size, kind="stable")
        long = order[np.searchsorted(size[order], SHORT, side="right") :]
        parts, counts, at = [], np.zeros(len(size), dtype=np.int64), 0
        done = []
        while at < len(order) - len(long):
            most = at + max(1, CELLS // int(size[order[at]]))
            width = int(size[order[min(most, len(order) - len(long)) - 1]])
            own = order[at : min(at + max(1, CELLS // width), len(order) - len(long))]
            width = int(size[own[-1]])
            place = starts[own][:, None] + np.arange(width)
            there = np.arange(width) < size[own][:, None]
            rows = np.where(there, self.of_char[points[np.where(there, place, 0)]], -1).astype(np.int64)
            flat, n = self._lockstep(rows)
            parts.append(flat)
            counts[own] = n
            done.append(own)
            at += len(own)
        for k in long.tolist():
            flat = self.merge(cuts[k].as_py())
            parts.append(np.array(flat, dtype=np.int64))
            counts[k] = len(flat)
        done.append(long)
        if not len(size):
            return np.zeros(0, dtype=np.int64), counts
        flat, where = np.concatenate(parts), np.concatenate(done)
        first = np.empty(len(size), dtype=np.int64)
        first[where] = np.cumsum(counts[where]) - counts[where]
        return flat[_ranges(first, counts)], counts

    def spelt(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each cut's): characters that are no pieces as the ids of their bytes."""
        bare = symbols >= self.n
        if not bare.any():
            return symbols, counts
        points = symbols[bare] - self.n
        raw = np.frombuffer("".join(map(chr, points.tolist())).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        width = np.ones(len(symbols), dtype=np.int64)
        width[bare] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        out = np.repeat(symbols, width)
        out[np.repeat(bare, width)] = self.byte_ids[raw]
        ends = np.concatenate([[0], np.cumsum(width)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return out, np.diff(ends[bounds])

    def batch(self, texts: pa.Array) -> list[tuple[np.ndarray, bool]]:
        """(ids with begin and end, whether the library agrees on all of them) of each text."""
        plain = texts.to_pylist()
        distinct, codes, bounds = self.cuts(pa.array(self.library.normalize(plain), pa.large_string()))
        flat, size = self.spelt(*self.symbols(distinct))
        first = np.cumsum(size) - size
        n = size[codes]
        ids = flat[_ranges(first[codes], n)].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(n)])[bounds]
        out = []
        begin, end = np.array([self.library.bos_id()], dtype="<u4"), np.array([self.library.eos_id()], dtype="<u4")
        for theirs, a, b in zip(self.library.encode(plain, num_threads=1, return_type="numpy"), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            own = ids[a:b]
            fine = np.array_equal(own, theirs)
            out.append((np.concatenate([begin, own if fine else theirs.astype("<u4"), end]), fine))
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode_documents(docs: DataFrame, model: str, keep_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agreed, one row for each row of ``docs`` (doc_id, text).

    Every whole text is held against the library; where its ids were others, the job would fail, not return them, so
    ``agreed`` is true. Null text counts as empty, which gives the begin and end ids alone. Rows are independent of each other: repeated
    rows give repeated results, an empty table an empty one, null doc_id stays null, other columns are left out.
    With ``keep_text`` the ids and decoded text themselves are returned too.
    """
    prepare(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agreed boolean" + ", ids array<int>, decoded string" * keep_text

    @trimmed
    def encoded(batches):
        own = encoder(model)
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in slices(texts):
                rows = own.batch(texts.slice(a, b - a))
                if not all(fine for _, fine in rows):
                    raise ValueError("the agenda's ids are not the library's")
                ids = [x.tolist() for x, _ in rows]
                decoded = own.library.decode(ids, num_threads=1)
                columns = [
                    batch.column(0).slice(a, b - a).cast(pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x, _ in rows]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded]),
                    pa.array([f for _, f in rows]),
                ]
                if keep_text:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agreed", "ids", "decoded"][: len(columns)])

    return docs.select("doc_id", "text").mapInArrow(encoded, schema)
