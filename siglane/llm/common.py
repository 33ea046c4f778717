"""What the training-data operators share: scratch tables, words of Arrow batches, skew-safe lookups."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siglane.session import file_system, fresh, prepare, shared_dir

#: White space of every contract here: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: A key counts as hot when it holds more than this share of all rows, so there are at most HOT_SHARE of them.
HOT_SHARE = 1024
#: Texts of an Arrow batch are handled in slices of about so many bytes.
SLICE_BYTES = 2 << 20

_FOLD = bytes(32 if chr(i) in SPACES else i + 32 if 65 <= i <= 90 else i for i in range(256))
_scratch: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("scratch", default=None)


def store(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes ``df`` to a fresh folder of the shared place and reads it again: the lineage ends here."""
    spark = prepare(df.sparkSession)
    path = f"{shared_dir(spark)}/siglane/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    if (made := _scratch.get()) is not None:
        made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch():
    """A list of the folders that store() makes within; release() deletes them once the results are written elsewhere."""
    made: list[tuple[SparkSession, str]] = []
    token = _scratch.set(made)
    try:
        yield made
    finally:
        _scratch.reset(token)


def release(made: list[tuple[SparkSession, str]]) -> None:
    """Deletes these folders, and no others."""
    while made:
        spark, path = made.pop()
        files, where = file_system(spark, path)
        files.delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def by_place(work):
    """``work(docs, ...)``, whose result has the columns of ``docs``, on columns renamed by their place, so that no name
    does harm: one with a dot or a backquote, one that is there twice. doc_id, text and source keep theirs."""

    @functools.wraps(work)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        names, kept = docs.columns, {"doc_id", "text", "source"}
        plain = [n if n in kept and n not in names[:k] else f"column_{k}" for k, n in enumerate(names)]
        return work(docs.toDF(*plain), *args, **options).toDF(*names)

    return run


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row, to choose among rows in the same way in every run; it is nobody's key.

    Spark's hash leaves out nulls and takes no maps, so where nulls stand is hashed too, and nested columns as JSON.
    """
    own = [(F.col(f"`{c}`"), t.startswith(("array", "map", "struct"))) for c, t in docs.dtypes]
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return F.xxhash64(*(F.to_json(F.struct(c), exact) if nested else c for c, nested in own), *(c.isNull() for c, _ in own))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds. Null ids count as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def lookup(rows: DataFrame, found: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows with one row of ``found`` for each key, of which column ``size`` counts the rows.

    A key with more than total / HOT_SHARE rows is hot; there are fewer than HOT_SHARE of them, so they are
    broadcast. All others meet in an ordinary join, where no key is large.
    """
    hot = F.col(size) * HOT_SHARE > F.lit(total)
    by_hot = rows.join(F.broadcast(found.filter(hot)), key)
    cold = rows.join(F.broadcast(found.filter(hot).select(key)), key, "left_anti")
    return by_hot.unionByName(cold.join(found.filter(~hot), key))


def _trim() -> None:
    """Gives a worker's free memory back, as it stays idle beside others until its next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def trimmed(work):
    """``work`` on Arrow batches, after which the worker gives back what it no longer needs."""

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            _trim()

    return run


def utf8(column: pa.Array) -> pa.Array:
    """A string column as large strings (offsets of 64 bits), null as ''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def joined(batches, most: int):
    """Arrow batches put together until they hold about ``most`` bytes, or are one that does."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def slices(texts: pa.Array, most: int = SLICE_BYTES):
    """(from, to) of rows that hold about ``most`` bytes; a longer text stands alone."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts)))
    start, n = 0, len(texts)
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, min(stop, n)
        start = stop


def words(texts: pa.Array, fold: bytes = _FOLD) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-cased (A-Z) words as binary, the words as indices into them, and each text's first index.

    The last has one entry more than there are texts. ``fold`` says what each byte counts as; blanks part words. Works
    on whole texts, in C++ and numpy only.
    """
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = texts.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if len(texts) and texts.buffers()[2] is not None else b""
    folded = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets - (offsets[0] if len(offsets) else 0))), pa.py_buffer(whole.translate(fold))])
    parts = pc.split_pattern(folded, b" ")
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(coded.dictionary, pa.scalar(b"", coded.dictionary.type)).as_py()
    bounds = np.asarray(parts.offsets, dtype=np.int64)
    bounds = bounds - bounds[0]
    if empty >= 0:
        there = codes != empty
        before = np.concatenate([[0], np.cumsum(there)])
        return coded.dictionary, codes[there], before[bounds]
    return coded.dictionary, codes, bounds


def hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """Unsigned 64-bit hashes of binary values."""
    return np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in distinct.to_numpy(zero_copy_only=False)), dtype=np.uint64, count=len(distinct))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
