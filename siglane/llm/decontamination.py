"""Benchmark decontamination: test items' windows of words in one Aho-Corasick automaton, texts scanned once.

Texts and items are lower-cased (A-Z) and cut into words. Every window of an item, as a sequence of word numbers, is a
key of the automaton; a text's words, numbered likewise, run through it once, and where a window ends its words are hit.
Words are the same bytes in the original text, so hits have their places there.

Items are no larger than a test set, but nothing here relies on it: their words are dealt, in pieces of PIECE words, to
blocks of about BLOCK words, and the texts pass block after block. A block is what the driver holds and broadcasts.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import fresh, prepare, slices, store, trimmed, utf8, words

WINDOW = 10
#: What is no part of a word, once A-Z are lower-cased.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a piece of an item, and of a block of pieces.
PIECE, BLOCK = 1 << 14, 1 << 18
#: a-z, digits and all bytes from 0x80, the parts of longer characters, as they are; A-Z lower-cased; all others blank.
FOLD = bytes(i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else i + 32 if 65 <= i <= 90 else 32 for i in range(256))
#: The automaton that this worker has built last.
_built: dict[str, Automaton] = {}


class Automaton:
    """The windows of a block's pieces. pieces: (number of the item within the block, its words)."""

    def __init__(self, pieces: list[tuple[int, list[str]]], window: int):
        numbers: dict[str, int] = {}
        items: dict[tuple[int, ...], set[int]] = {}
        for item, own in pieces:
            coded = [numbers.setdefault(w, len(numbers) + 1) for w in own]
            size = min(window, len(coded))
            for k in range(len(coded) - size + 1 if size else 0):
                items.setdefault(tuple(coded[k : k + size]), set()).add(item)
        self.known = pa.array([w.encode() for w in numbers], pa.large_binary())
        self.size = np.array([len(w) for w in items], dtype=np.int64)
        self.first = np.cumsum([0, *(len(x) for x in items.values())])
        self.items = np.array([i for x in items.values() for i in sorted(x)], dtype=np.int64)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, w in enumerate(items):
            self.machine.add_word(w, k)
        self.machine.make_automaton()

    def scan(self, distinct: pa.Array, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether each word is hit; texts and items that meet, each pair once) of the words of texts, as words() has them."""
        hit = np.zeros(len(codes), dtype=bool)
        none = np.zeros(0, dtype=np.int64)
        if not len(self.size) or not len(codes):
            return hit, none, none
        number = pc.fill_null(pc.index_in(distinct, self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        # 0, which no window has, between texts.
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        place = np.arange(len(codes)) + text
        line = np.zeros(len(codes) + len(bounds), dtype=np.int64)
        line[place] = number[codes]
        found = np.array([x for x in self.machine.iter(tuple(line.tolist()))], dtype=np.int64).reshape(-1, 2)
        ends, which = found[:, 0], found[:, 1]
        word = np.searchsorted(place, ends)
        change = np.bincount(word - self.size[which] + 1, minlength=len(codes) + 1) - np.bincount(word + 1, minlength=len(codes) + 1)
        hit = np.cumsum(change[: len(codes)]) > 0
        pairs = np.unique(np.stack([text[word], which]), axis=1)
        n = np.diff(self.first)[pairs[1]]
        at = np.repeat(self.first[pairs[1]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pairs = np.unique(np.stack([np.repeat(pairs[0], n), self.items[at]]), axis=1)
        return hit, pairs[0], pairs[1]


def _runs(hit: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last word) of each run of hit words; a run ends with its text."""
    before = np.concatenate([[False], hit[:-1]])
    before[bounds[:-1][bounds[:-1] < len(hit)]] = False
    after = np.concatenate([hit[1:], [False]])
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    return np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after)


def _places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of each word of ``texts`` in code points of its text."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    inside = np.frombuffer(FOLD, dtype=np.uint8)[data] != 32
    before = np.concatenate([[False], inside[:-1]])
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.concatenate([inside[1:], [False]])
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    base = point[offsets[:-1]][np.searchsorted(offsets[1:], starts, side="right")]
    return point[starts] - base, point[ends] - base


def _lists(owners: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """The values of each of n rows; owners is sorted."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owners, np.arange(n + 1)).astype(np.int32)), values)


def _merged(a: list | None, b: list | None) -> list:
    """Union of word ranges [first, last], in order."""
    out: list = []
    for first, last in sorted((x["first"], x["last"]) for x in (a or []) + (b or [])):
        if out and first <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32())])


def pieces_of(items: DataFrame, window: int) -> DataFrame:
    """item, w: the words of each item in pieces that lose no window."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.filter(F.split(lower, BREAKS), lambda w: w != "").alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(PIECE))
    return rows.select("item", F.explode(starts).alias("at"), "w").select("item", F.slice("w", F.col("at") + 1, F.lit(PIECE + window - 1)).alias("w"))


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` with n_words, spans and items: what of each text is in a window of an item.

    A window is ``window`` words in a row of an item, or all words of a shorter one. n_words counts the text's words;
    spans are the runs of hit words, as first and last (word numbers from 0) and start and stop (code points of the
    original text); items are the distinct ids, as strings, of the items whose windows occur, sorted. Result columns
    take other names where ``docs`` has them (see fresh()), so no column is lost; columns are renamed by place while
    they are worked on, so names with dots do no harm.

    Null and empty texts have no words and no spans. Null, empty and wordless items are in no text; a null item_id is
    the id ''. Items with one id are one item. Repeated rows have equal results; an empty table gives an empty one, and
    without items nothing is contaminated.
    """
    spark = prepare(docs.sparkSession)
    names = docs.columns
    added = fresh(docs, "n_words", "spans", "items")
    place = names.index("text")
    now = docs.toDF(*(f"c{k}" for k in range(len(names))))
    pieces = pieces_of(items, window)
    number = pieces.agg(F.sum(F.size("w")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-number // block))
    if blocks > 1:
        pieces = store(pieces, "pieces")
    state = "n_words int, spans array<struct<first:int,last:int,start:int,stop:int>>, items array<string>"
    for b in range(blocks):
        # A block's words: the driver holds one block at a time.
        own = pieces.filter(F.pmod(F.xxhash64("item", "w"), F.lit(blocks)) == b).orderBy("item", "w").collect()
        ids = sorted({r["item"] for r in own})
        index = {x: k for k, x in enumerate(ids)}
        shared = spark.sparkContext.broadcast(([(index[r["item"]], list(r["w"])) for r in own], ids))
        schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema.fields))
        now = now.mapInArrow(_scanner(shared, window, len(names), place, b > 0), f"{schema}, {state}")
        if b + 1 < blocks:
            now = store(now, "scanned")
    return now.toDF(*names, *added)


def _scanner(shared, window: int, n: int, place: int, again: bool):
    token = uuid.uuid4().hex

    @trimmed
    def scan(batches):
        if token not in _built:
            _built.clear()
            _built[token] = Automaton(shared.value[0], window)
        machine, ids = _built[token], pa.array(shared.value[1], pa.string())
        for batch in batches:
            texts = utf8(batch.column(place))
            for a, b in slices(texts):
                own = texts.slice(a, b - a)
                distinct, codes, bounds = words(own, FOLD)
                hit, text, item = machine.scan(distinct, codes, bounds)
                found = _lists(text, b - a, ids.take(pa.array(item)))
                first, last = _runs(hit, bounds)
                starts, stops = _places(own)
                of = np.searchsorted(bounds[1:], first, side="right")
                base = bounds[:-1][of] if len(of) else first
                values = [first - base, last - base, starts[first], stops[last]]
                spans = _lists(of, b - a, pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in values], names=["first", "last", "start", "stop"]))
                rows = batch.slice(a, b - a)
                if again:
                    found = pa.array([sorted({*x, *y}) for x, y in zip(rows.column(n + 2).to_pylist(), found.to_pylist(), strict=True)], pa.list_(pa.string()))
                    spans = _united(rows.column(n + 1), spans, bounds, starts, stops)
                counts = pa.array(np.diff(bounds).astype(np.int32))
                columns = [rows.column(k) for k in range(n)] + [counts, spans, found]
                yield pa.RecordBatch.from_arrays(columns, names=[*(f"c{k}" for k in range(n)), "n_words", "spans", "items"])

    return scan


def _united(one: pa.Array, two: pa.Array, bounds: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The spans of both."""
    out = []
    for k, (a, b) in enumerate(zip(one.to_pylist(), two.to_pylist(), strict=True)):
        at = int(bounds[k])
        out.append([{**x, "start": int(starts[at + x["first"]]), "stop": int(stops[at + x["last"]])} for x in _merged(a, b)])
    return pa.array(out, two.type)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that share no window with an item, in their own columns; see contaminated()."""
    out = contaminated(docs, items, window)
    spans = F.col(f"`{out.columns[-2]}`")
    kept = out.filter(F.size(spans) == 0)
    n = len(docs.columns)
    renamed = kept.toDF(*(f"c{k}" for k in range(n + 3)))
    return renamed.select(*(f"c{k}" for k in range(n))).toDF(*docs.columns)


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row of ``docs``; see contaminated()."""
    rows = contaminated(docs.select("doc_id", "text"), items, window, block)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)
    return rows.select("doc_id", F.col("n_words").cast("long").alias("n_words"), hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
