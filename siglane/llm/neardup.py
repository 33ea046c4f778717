"""Near duplicates by an LSH forest: sorted orders of signatures, whose longest common prefixes give candidates.

Documents with the same words are one class; only classes are compared. A class has TREES signatures of DEPTH min-hash
values each. For each tree all classes are sorted by signature. In sorted order, the documents that share the longest
prefix with one are its neighbours, however dense its region is: where few documents share LEAST_DEPTH values these
are all, where many do the order goes on by deeper values. Each class is paired with the NEAR next ones that share
LEAST_DEPTH values at least. Pairs are confirmed on the whole shingle sets, of whole texts. In regions of more than
NEAR documents, whatever pairs lie farther apart are found exactly, by their rarest shingles.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from siglane.llm import bloom
from siglane.llm.common import by_place, fresh, hashes, lookup, mix, partitions, prepare, row_hash, slices, store, trimmed, utf8, words
from siglane.llm.components import components

TREES, DEPTH, LEAST_DEPTH, NEAR = 16, 8, 3, 4
#: Pairs confirmed first: so many of each class, those with the longest prefixes over all trees.
FIRST = 2
#: Shingle sets that a task remembers between pairs, in bytes, and what each takes besides its hashes.
KEPT_BYTES, SET_BYTES = 8 << 20, 300
_A = mix(np.arange(TREES * DEPTH, dtype=np.uint64), 11) | np.uint64(1)
_B = mix(np.arange(TREES * DEPTH, dtype=np.uint64), 12)


def shingles(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of k words in a row; with fewer words, of all of them; of no words, none."""
    n = len(word_hashes)
    if not n:
        return word_hashes
    size = min(k, n)
    with np.errstate(over="ignore"):
        out = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
        for i in range(size):
            out = mix(out ^ word_hashes[i : n - size + 1 + i], 3)
    return np.unique(out)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, TREES * DEPTH) min-hash values of 32 bits; all sets hold something."""
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), len(_A)), dtype=np.uint32)
    first = 0
    while first < len(sets):
        last = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), 32_768, side="right")) + first)
        flat = np.concatenate(sets[first:last])
        starts = np.cumsum(sizes[first:last]) - sizes[first:last]
        with np.errstate(over="ignore"):
            for j in range(len(_A)):
                out[first:last, j] = np.minimum.reduceat((flat * _A[j] + _B[j]) >> np.uint64(32), starts)
        first = last
    return out


def _digests(hashed: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """The class of each text's words, None where there are none."""
    return [hashlib.blake2b(hashed[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _classes(texts: pa.Array, k: int):
    """(class or None, shingle set) of each text."""
    distinct, codes, bounds = words(texts)
    hashed = hashes(distinct)[codes]
    for name, a, b in zip(_digests(hashed, bounds), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield name, shingles(hashed[a:b], k)


def _signed(k: int):
    @trimmed
    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in slices(texts):
                found = list(_classes(texts.slice(a, b - a), k))
                full = [s for c, s in found if c is not None]
                made = iter(signatures(full).astype(">u4") if full else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array([c for c, _ in found], pa.binary()), pa.array([len(s) for _, s in found], pa.int64()), pa.array([None if c is None else next(made).tobytes() for c, _ in found], pa.binary())],
                    names=["doc_id", "class", "n_shingles", "signature"],
                )

    return run


_PAIRS = "a binary, b binary, shared int, tree int, key binary, class binary"


def _neighbours(tree: np.ndarray, key: np.ndarray, name: list[bytes], fresh: int) -> list[tuple[bytes, bytes | None, int]]:
    """Pairs of sorted rows not more than NEAR apart, of which the later is at ``fresh`` or after; and marks (class,
    None, -1) of rows that share LEAST_DEPTH values with one farther away."""
    out = []
    for step in range(1, NEAR + 2):
        low = max(0, fresh - step)
        x, y = slice(low, len(tree) - step), slice(low + step, len(tree))
        if len(tree) <= low + step:
            continue
        same = np.cumprod(key[x] == key[y], axis=1).sum(axis=1)
        if step > NEAR:  # farther apart than pairs are made: both are only marked
            for i in np.flatnonzero((tree[x] == tree[y]) & (same >= LEAST_DEPTH)).tolist():
                out += [(name[low + i], None, -1), (name[low + i + step], None, -1)]
            continue
        for i in np.flatnonzero((tree[x] == tree[y]) & (same >= LEAST_DEPTH)).tolist():
            a, b = name[low + i], name[low + i + step]
            if a != b:
                out.append((min(a, b), max(a, b), int(same[i])))
    return out


def _walk(ends: bool):
    """Candidate pairs of sorted rows (tree, key, class); with ``ends`` also the partition's first and last rows."""

    @trimmed
    def run(batches):
        tree, key, name = np.zeros(0, dtype=np.int64), np.zeros((0, DEPTH), dtype=np.uint32), []
        kept: list[tuple[int, bytes, bytes]] = []
        last: list[tuple[int, bytes, bytes]] = []
        seen = 0
        for batch in batches:
            t, keys, n = np.asarray(batch.column(0)).astype(np.int64), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            if not n:
                continue
            rows = list(zip(t.tolist(), keys, n, strict=True))
            kept += rows[: max(0, NEAR + 1 - seen)]
            last = (last + rows[-NEAR - 1 :])[-NEAR - 1 :]
            seen += len(rows)
            fresh = len(name)
            tree, name = np.concatenate([tree, t]), name + n
            key = np.concatenate([key, np.frombuffer(b"".join(keys), dtype=np.uint32).reshape(-1, DEPTH)])
            found = _neighbours(tree, key, name, fresh)
            tree, key, name = tree[-NEAR - 1 :], key[-NEAR - 1 :], name[-NEAR - 1 :]
            none = [None] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.binary(), pa.binary(), pa.int32()))] + [pa.array(none, kind) for kind in (pa.int32(), pa.binary(), pa.binary())], names=["a", "b", "shared", "tree", "key", "class"])
        if ends and seen:
            edge = list(dict.fromkeys(kept + last))
            none = [None] * len(edge)
            yield pa.RecordBatch.from_arrays([pa.array(none, kind) for kind in (pa.binary(), pa.binary(), pa.int32())] + [pa.array([e[i] for e in edge], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["a", "b", "shared", "tree", "key", "class"])

    return run


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b, votes: pairs of classes, and the prefix values that they share over all trees where they are neighbours;
    class: those of regions where some lie too far apart to be paired).

    The sorted orders are dealt by range, so a dense region is split like any other; the few rows at the ends of the
    partitions are walked once more together, which gives the pairs across them.
    """
    spark = classes.sparkSession
    trees = classes.select("class", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    trees = trees.select("tree", F.expr(f"substring(signature, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("key"), "class")
    trees = trees.repartitionByRange(partitions(spark), "tree", "key", "class").sortWithinPartitions("tree", "key", "class")
    walked = store(trees.mapInArrow(_walk(True), _PAIRS), "neighbours")
    ends = walked.filter("tree is not null").select("tree", "key", "class").repartition(1).sortWithinPartitions("tree", "key", "class").mapInArrow(_walk(False), _PAIRS)
    pairs = walked.filter("a is not null").select("a", "b", "shared").unionByName(ends.select("a", "b", "shared"))
    pairs = store(pairs, "walked")
    votes = pairs.filter("b is not null").groupBy("a", "b").agg(F.sum("shared").alias("votes"))
    return store(votes, "candidates"), store(pairs.filter("b is null").select(F.col("a").alias("class")).distinct(), "dense")


def _far_pairs(dense: DataFrame, texts: DataFrame, label: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b: all pairs of dense classes in different components that may reach percent/100, by prefix filtering.

    Of two sets of n and m that do, each has one of the other's shingles among its first n - ceil(percent n / 100) + 1 in any
    common order. Rarest first, a shingle that only one set has counts towards these and pairs nothing, and what many
    texts share comes last. Only shingles that stand first in sets of different components are joined. At the first
    shingle that two sets have in common, place i of n and j of m, at most 1 + min(n - i, m - j) shingles are left to
    share; pairs for which that can't be percent/100 of the union are left out, which every pair asked for survives at
    that shingle.
    """

    @trimmed
    def run(batches):
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                names, packed = (c.to_pylist() for c in batch.slice(at, 100).columns)
                plain = utf8(pa.array([press.decompress(t).decode() for t in packed], pa.large_string()))
                for start, stop in slices(plain):
                    sets = [s for _, s in _classes(plain.slice(start, stop - start), k)]
                    sizes = [len(s) for s in sets]
                    own = [n for n, z in zip(names[start:stop], sizes, strict=True) for _ in range(z)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64)), pa.array(own, pa.binary()), pa.array(np.repeat(sizes, sizes), pa.int64())], names=["shingle", "class", "n"])

    own = texts.join(dense, "class").select("class", "text").mapInArrow(run, "shingle long, class binary, n long")
    own = store(own, "dense-shingles")
    often = own.groupBy("shingle").agg(F.count("*").alias("f")).filter("f > 1")
    shared = own.join(often, "shingle")
    by_class = Window.partitionBy("class")
    alone = F.col("n") - F.count("*").over(by_class)
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    shared = shared.withColumns({"alone": alone, "place": F.row_number().over(by_class.orderBy("f", "shingle"))}).withColumn("place", F.col("place") + F.col("alone")).filter(F.col("place") <= first)
    shared = shared.join(label.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    shared = store(shared.select("shingle", "class", "n", "place", "component"), "dense-first")
    mixed = shared.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("shingle")
    shared = shared.join(mixed, "shingle")
    x = shared.select("shingle", F.col("class").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"))
    y = shared.select("shingle", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"))
    close = (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    close &= (100 + percent) * (1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))) >= percent * (F.col("na") + F.col("nb"))
    return x.join(y, "shingle").filter(close).select("a", "b").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose shingle sets have percent/100 of their union in common at least."""
    x = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    y = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))

    @trimmed
    def run(batches):
        press, kept, held = zstandard.ZstdDecompressor(), {}, 0

        def sets(names, packed):
            nonlocal held
            new = {n: t for n, t in zip(names, packed, strict=True) if n not in kept}
            if new:
                plain = utf8(pa.array([press.decompress(t).decode() for t in new.values()], pa.large_string()))
                for start, stop in slices(plain):
                    part = list(new)[start:stop]
                    for n, (_, s) in zip(part, _classes(plain.slice(start, stop - start), k), strict=True):
                        kept[n] = s
                        held += s.nbytes + SET_BYTES
            return [kept[n] for n in names]

        for batch in batches:
            for at in range(0, batch.num_rows, 50):
                a, b, s, t = (c.to_pylist() for c in batch.slice(at, 50).columns)
                if held > KEPT_BYTES:
                    kept.clear()
                    held = 0
                out = []
                for n, m, u, v in zip(a, b, sets(a, s), sets(b, t), strict=True):
                    both = len(np.intersect1d(u, v, assume_unique=True))
                    if 100 * both >= percent * (len(u) + len(v) - both):
                        out.append((n, m))
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def _components(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class, n_shingles, signature of each row; class, rep, copies, component, component_id of each class)."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = store(docs.mapInArrow(_signed(k), "doc_id long, class binary, n_shingles long, signature binary"), "signed", compression="none")
    full = rows.filter("class is not null")
    classes = store(full.groupBy("class").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("signature").alias("signature")), "classes", compression="none")
    pairs, dense = candidates(classes)
    nodes = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    nodes = store(nodes.join(classes.select("class", "rep"), "class"), "nodes")

    def mark(name: bytes, doc_id) -> int:
        return xxhash.xxh3_64_intdigest(name + str(doc_id).encode()) - (1 << 63)

    def marks(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([mark(n, r) for n, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], pa.int64())], names=["key"])

    known = spark.sparkContext.broadcast(bloom.build(nodes.select("class", "rep").mapInArrow(marks, "key long"), "key").bits)

    @trimmed
    def members(batches):
        press, own = zstandard.ZstdCompressor(level=3), bloom.Filter({}, 1)
        own.bits = known.value
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in slices(texts):
                ids, some = batch.column(0).slice(a, b - a).to_pylist(), texts.slice(a, b - a)
                distinct, codes, bounds = words(some)
                hashed = hashes(distinct)[codes]
                names = [hashlib.blake2b(hashed[x:y].tobytes(), digest_size=16).digest() for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                there = np.flatnonzero(own.has(np.array([mark(n, i) for n, i in zip(names, ids, strict=True)], dtype=np.int64).view(np.uint64))).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in there], pa.binary()), pa.array([ids[i] for i in there], pa.int64()), pa.array([press.compress(some[i].as_py().encode()) for i in there], pa.binary())], names=["class", "rep", "text"])

    found = docs.mapInArrow(members, "class binary, rep long, text binary").withColumnRenamed("rep", "of")
    found = found.join(nodes, "class").filter(F.col("rep").eqNullSafe(F.col("of"))).select("class", "text").dropDuplicates(["class"])
    texts = store(found, "texts", compression="none")

    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), "votes").unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other"), "votes"))
    best = ends.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("votes"), "other"))).filter(F.col("place") <= FIRST)
    first = store(best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "first")
    links = store(_confirmed(first, texts, k, percent), "links")
    so_far = store(components(links), "components")
    ca, cb = so_far.select(F.col("node").alias("a"), F.col("component").alias("ca")), so_far.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    rest = pairs.select("a", "b").join(first, ["a", "b"], "left_anti").join(ca, "a", "left").join(cb, "b", "left")
    rest = rest.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    more = store(_confirmed(rest, texts, k, percent), "links")
    # Components so far are stars, so the rest's links only have to join these.
    stars = so_far.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    stars = stars.unionByName(more)
    label = store(components(stars), "components") if more.limit(1).count() else so_far
    if dense.limit(1).count():
        far = _far_pairs(dense, texts, label, k, percent).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
        far = store(_confirmed(far, texts, k, percent), "links")
        if far.limit(1).count():
            label = components(stars.unionByName(far))
    label = store(label.join(classes.select(F.col("class").alias("node"), "rep"), "node"), "labels")
    named = label.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
    by_class = lookup(label.select("node", "component"), named, "component", "n", label.count()).select(F.col("node").alias("class"), "component", "component_id")
    by_class = classes.select("class", "rep", "copies").join(by_class, "class", "left").select("class", "rep", "copies", F.coalesce("component", "class").alias("component"), F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("component_id")).alias("component_id"))
    return rows, store(by_class, "class-components")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Rows of different texts without doc_id, or under one repeated doc_id, are of one component only where links
    connect them, though the names of their components are equal.

    Words are lower-cased (A-Z) runs without white space; a text's set holds its distinct runs of k words, or all its
    words as one where there are fewer. Documents are linked when their sets have percent/100 of their union in
    common; a component is all that links reach, named by its smallest doc_id. Texts without words, and null, have an
    empty set and are alone. Repeated rows are linked to each other; null doc_id is named after all others. An empty
    table gives an empty one; other columns are left out.

    Candidates are confirmed in two steps: first each class's FIRST best pairs, then all pairs of classes that these
    have not connected; then those pairs of dense regions that the order has put too far apart. No link between
    components can be missed by that, as each candidate pair of theirs is confirmed.
    """
    rows, by_class = _components(docs, k, percent)
    full = rows.filter("class is not null")
    of = lookup(full.select("doc_id", "n_shingles", "class"), by_class.select("class", "copies", "component_id"), "class", "copies", rows.count())
    alone = rows.filter("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = of.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@by_place
def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, in its own columns: the smallest doc_id's, null after all others.

    Texts without words, and null, are in no component and all stay. Of different texts under one id each has its own
    component, or the links that it has. Of repeated rows one stays, and of rows of one id and text with other values
    the one whose columns hash highest, so reruns agree. An empty table gives an empty one; columns of any name pass
    through.
    """
    name, kept_name, kept_rep, copies, best = fresh(docs, "class", "kept", "rep", "copies", "best")
    _, by_class = _components(docs, k, percent)
    least = by_class.groupBy("component").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "class", "copies")).alias("x"))
    kept = least.select(F.col("x.class").alias(kept_name), F.col("x.rep").alias(kept_rep), F.col("x.copies").alias(copies))
    place = docs.columns.index("text")

    @trimmed
    def named(batches):
        for batch in batches:
            texts, names = utf8(batch.column(place)), []
            for a, b in slices(texts):
                distinct, codes, bounds = words(texts.slice(a, b - a))
                names += _digests(hashes(distinct)[codes], bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.binary())], names=[*batch.schema.names, name])

    own = docs.mapInArrow(named, StructType([*docs.schema.fields, StructField(name, BinaryType())]))
    full = own.join(kept, (F.col(name) == F.col(kept_name)) & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_rep)))
    # Repeated rows of one text and id: one stays, summed up before they are dealt.
    order = row_hash(docs)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = full.filter(F.col(copies) > 1).groupBy(name).agg(F.max_by(F.struct(*columns), order).alias(best)).select(f"{best}.*")
    return full.filter(F.col(copies) == 1).select(*columns).unionByName(one).unionByName(own.filter(F.col(name).isNull()).select(*columns))
