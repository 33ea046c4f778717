"""Toxicity by subword-bag embeddings: vectors of n-grams averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character n-grams (with word ends) and of itself, all hashed into BUCKETS
rows, so a misspelt word shares most of its vectors with the word. A passage's vector is the mean of its words'; a
softmax of two classes over it gives the passage's probability. A text is as toxic as its most toxic passage, so a few
words show in a long text as well as in a short one. Vectors and softmax are trained together by gradient descent: first on whole texts
taken as one passage, then on each text's most toxic passage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.llm.common import by_place, fold_of, mix, prepare, slices, trimmed, utf8, words

BUCKETS, WIDTH = 1 << 17, 8
GRAMS = (3, 4, 5)
PASSAGE = 3
FOLDS = 5
#: Labelled rows of each class that the fit uses at most: those whose ids hash lowest.
MOST_LABELLED = 1500
#: Buckets of fewer labelled texts than this keep a zero vector.
LEAST_TEXTS = 4
WARM_STEPS, STEPS, RATE = 20, 100, 1.0
#: So many distinct words are cut into n-grams at a time; beyond that, the fit holds 4 bytes of each n-gram.
BLOCK = 1 << 13


def _characters(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each character of binary UTF-8 words: its bytes put together; the characters of each word)."""
    n = len(distinct)
    offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[distinct.offset : distinct.offset + n + 1]
    data = np.frombuffer(distinct.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, dtype=np.uint8)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(first, len(data)))
    out = data[first].astype(np.uint64)
    for j in range(1, 4):
        more = size > j
        out[more] = out[more] * np.uint64(256) + data[first[more] + j]
    return out, np.diff(np.searchsorted(first, offsets - offsets[0]))


def grams(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word of each) of all n-grams of binary words and of the words themselves."""
    n = len(distinct)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    source, lengths = _characters(distinct)
    ends = np.cumsum(lengths + 2)
    starts = ends - lengths - 2
    data = np.empty(int(ends[-1]), dtype=np.uint64)
    inner = np.ones(len(data), dtype=bool)
    inner[starts] = inner[ends - 1] = False
    data[starts], data[ends - 1], data[inner] = 256, 257, source  # 256 and 257 are no character's
    word = np.repeat(np.arange(n), lengths + 2)
    room = np.repeat(ends, lengths + 2) - np.arange(len(data))
    buckets, owners = [], []
    value = np.zeros(len(data), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, max(GRAMS) + 1):
            m = len(data) - k + 1
            if m <= 0:
                break
            value = value[:m] * np.uint64(0x100000001B3) + data[k - 1 :]
            if k in GRAMS:
                fits = room[:m] >= k
                buckets.append(mix(value[fits], k))
                owners.append(word[:m][fits])
        powers = np.uint64(0x9E3779B97F4A7C15) ** (room % 64).astype(np.uint64)
        buckets.append(mix(np.add.reduceat(mix(data, 31) * powers, starts), 29))
    owners.append(np.arange(n))
    return (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


class Model:
    """``weights`` is, for each bucket, its vector's product with the difference of the softmax's two rows."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        distinct, codes, bounds = words(texts)
        value = np.zeros(len(distinct))
        for a in range(0, len(distinct), BLOCK):
            bucket, owner = grams(distinct.slice(a, BLOCK))
            value[a : a + BLOCK] = np.bincount(owner, weights=self.weights[bucket]) / np.bincount(owner)
        out = np.full(len(texts), self.bias)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            out[full] += np.maximum.reduceat(passages(value[codes], bounds), bounds[:-1][full])
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def passages(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The mean of each passage of PASSAGE words, by its first word; -inf where the text ends before it does.

    A shorter text is one passage. Sums are made in the order of the words, so that equal passages have equal means.
    """
    out = value.copy()
    for j in range(1, PASSAGE):
        out[: max(0, len(out) - j)] += value[j:]
    out /= PASSAGE
    n = np.diff(bounds)
    for j in range(1, PASSAGE):
        out[bounds[1:][n >= j] - j] = -np.inf
    for size in range(1, PASSAGE):
        first = bounds[:-1][n == size]
        out[first] = sum(value[first + j] for j in range(size)) / size
    return out


def blocks(distinct: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, in the order of the words; where each word's begin) for every BLOCK words."""
    out = []
    for a in range(0, len(distinct), BLOCK):
        bucket, owner = grams(distinct.slice(a, BLOCK))
        order = np.argsort(owner, kind="stable")
        # Every word has one bucket at least: itself.
        out.append((bucket[order].astype(np.int32), np.flatnonzero(np.diff(owner[order], prepend=-1))))
    return out


def train(texts: list[str] | pa.Array, labels: list[int], shares: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Fits vectors and softmax; shares are the labelled rows that one row of class 0 and of class 1 stands for."""
    if not len(texts) or len(set(labels)) < 2:
        constant = 60.0 if labels and labels[0] else -60.0
        return Model(np.zeros(BUCKETS), constant)
    distinct, codes, bounds = words(texts if isinstance(texts, pa.Array) else utf8(pa.array(texts)))
    parted = blocks(distinct)
    parts = np.concatenate([np.diff(np.append(firsts, len(bucket))) for bucket, firsts in parted] or [np.zeros(0, dtype=np.int64)])

    def by_words(of_bucket: np.ndarray) -> np.ndarray:
        return np.concatenate([np.add.reduceat(of_bucket[bucket], firsts) for bucket, firsts in parted] or [np.zeros(0)])

    def by_buckets(of_word: np.ndarray) -> np.ndarray:
        out, at = np.zeros(BUCKETS), 0
        for bucket, firsts in parted:
            n = len(firsts)
            out += np.bincount(bucket, weights=np.repeat(of_word[at : at + n], parts[at : at + n]), minlength=BUCKETS)
            at += n
        return out

    # Texts that each bucket occurs in, at most: the texts of its words, added up.
    pairs = np.unique(np.repeat(np.arange(len(texts)), np.diff(bounds)) * max(1, len(distinct)) + codes)
    trained = by_buckets(np.bincount(pairs % max(1, len(distinct)), minlength=len(distinct))) >= LEAST_TEXTS
    del pairs
    wanted = np.array(labels, dtype=np.float64)
    weight = np.where(wanted > 0, shares[1], shares[0])
    weight /= weight.sum()
    whole = np.flatnonzero(np.diff(bounds))
    random = np.random.default_rng(0)
    vectors = random.uniform(-0.1, 0.1, (BUCKETS, WIDTH)) * trained[:, None]
    rows = random.uniform(-1, 1, (2, WIDTH))
    bias = np.zeros(2)
    state = [[np.zeros_like(x), 0.0] for x in (vectors, rows, bias)]
    for step in range(1, WARM_STEPS + STEPS + 1):
        across = rows[1] - rows[0]
        value = by_words(vectors @ across) / parts
        begins, of = bounds[:-1][whole], whole
        n = np.diff(np.append(begins, len(codes)))
        if step <= WARM_STEPS:
            mean = np.add.reduceat(value[codes], begins) / n if len(begins) else np.zeros(0)
        else:
            mean = passages(value[codes], bounds)
            if len(of):
                best = np.flatnonzero(mean == np.repeat(np.maximum.reduceat(mean, begins), n))
                begins, n = best[np.searchsorted(best, begins)], np.minimum(n, PASSAGE)
                mean = mean[begins]
        logit = np.full(len(texts), bias[1] - bias[0])
        logit[of] += mean
        error = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - wanted) * weight
        at = np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        slopes = np.bincount(codes[at], weights=np.repeat(error[of] / n, n), minlength=len(distinct)) / parts
        by_bucket = by_buckets(slopes) * trained
        slope = by_bucket @ vectors
        pulls = [np.outer(by_bucket, across), np.stack([-slope, slope]), np.array([-error.sum(), error.sum()])]
        # One step length for each array: a vector moves by the evidence there is for it, not by as much as any other.
        for x, g, s in zip((vectors, rows, bias), pulls, state, strict=True):
            s[0] += 0.1 * (g - s[0])
            s[1] += 0.05 * (float(np.abs(g).max()) - s[1])
            x -= RATE * s[0] / max(s[1], 1e-12) * (1.0 if x is vectors else 0.1)
    return Model(vectors @ (rows[1] - rows[0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of the labelled rows of ``docs`` whose fold isn't 0, of MOST_LABELLED rows of each class at most.

    Labels of unknown documents, null labels and labels other than 0 and 1 are left out; of several labels of one
    document the larger counts, of several rows of one id the least text.
    """
    known = labels.filter(F.col("toxic").isin(0, 1)).filter(fold_of(F.col("doc_id"), FOLDS) != 0).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.xxhash64("doc_id")
    chosen = None
    for c in (0, 1):
        own = known.filter(F.col("toxic") == c).orderBy(place, "doc_id").limit(MOST_LABELLED)
        chosen = own if chosen is None else chosen.unionByName(own)
    # MOST_LABELLED ids of each class: a proven bound for the broadcast.
    # Of several rows of one id the least text: so many ids, so many rows at most.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").toArrow()
    toxic = sample.column("toxic").to_pylist()
    shares = tuple(counts.get(c, 0) / max(1, toxic.count(c)) for c in (0, 1))
    return train(utf8(sample.column("text")), toxic, shares)


def _scored(docs: DataFrame, model: Model, keep: bool) -> DataFrame:
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def scores(column):
        weights, bias = shared.value
        own = Model(weights, bias)
        texts = utf8(column)
        return np.concatenate([own.scores(texts.slice(a, b - a)) for a, b in slices(texts)] or [np.zeros(0)])

    place = docs.columns.index("text")

    @trimmed
    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(place)) < 0.5))

    @trimmed
    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1)), pa.float64())], names=["doc_id", "score"])

    if keep:
        return docs.mapInArrow(kept, docs.schema)
    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    Null, empty and blank texts have the score of the softmax's bias alone. Without labels of both classes all scores
    are those of the one class there is, or 0. Repeated rows have equal scores; an empty table gives an empty one;
    other columns are left out and never used.
    """
    rows = _scored(docs.withColumn("doc_id", F.col("doc_id").cast("long")), fit(docs, labels), keep=False)
    return rows.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@by_place
def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, in their own columns, whatever their names.

    Null, empty and blank texts score by the softmax's bias alone, repeated rows alike; null ids are scored as others
    and never learnt from. Without labels of both classes nothing is dropped, or, where all labels are toxic, all. An
    empty table gives an empty one.
    """
    return _scored(docs, fit(docs, labels), keep=True)
