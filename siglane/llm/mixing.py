"""Mixing sources to target weights by Pareto order sampling of whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siglane.llm.common import WORD_PATTERN, by_place, fresh, prepare, row_hash, store

#: Weights of the sources in their order, repeating; a source's words may be taken so many times at most.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Each source's ranks are cut into so many intervals, of which only the one that holds the limit is sorted.
INTERVALS = 4096
#: Passes fill what is missing of a target until no source lacks more than this part of it, or nothing fits.
NEAR = 0.01
#: So many sources are few enough for a broadcast of one row each.
FEW = 1 << 16


def targets(sizes: list[tuple[object, int]], weights: tuple[int, ...] = WEIGHTS, most: float = MOST_TIMES) -> dict:
    """Words to take from each source (null last, else by code point): all words, shared by weight, none above most x size."""
    order = sorted(sizes, key=lambda x: (x[0] is None, [ord(c) for c in x[0] or ""]))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(order)}
    size = dict(order)
    whole, capped = sum(size.values()), set()
    while True:
        free = [s for s in size if s not in capped]
        left, shares = whole - sum(most * size[s] for s in capped), sum(weight[s] for s in free)
        out = {s: float(most * size[s]) if s in capped else left * weight[s] / shares for s in size}
        above = {s for s in free if out[s] > most * size[s]}
        if not above:
            return out
        capped |= above


def uniform(doc_id: Column, seed: str) -> Column:
    """A number above 0 and below 1 that depends on the id and seed only."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def _mixed(docs: DataFrame, weights: tuple[int, ...], most: int, seed: str, number: str | None = None) -> DataFrame:
    """mix() with two columns more: copies taken, and ``row``, the row's value of the column ``number``.

    Rows that tie in everything else come by a hash of their columns.
    """
    spark = prepare(docs.sparkSession)
    own = docs.drop(number) if number else docs
    rows = store(docs.select("doc_id", "source", words("text").alias("size"), row_hash(own).alias("hash"), (F.col(number) if number else F.lit(0).cast("long")).alias("row")), "words")
    by_source = store(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    # One row for each source, as many as the mix has weights for: a list of names, not data.
    named = [(r["source"], r["source_size"]) for r in by_source.collect()]
    wanted = targets(named, weights, most) if named else {}
    sizes = dict(named)
    plan = spark.createDataFrame([(s, sizes[s], float(t), min(int(t // sizes[s]), most) if sizes[s] else 0) for s, t in wanted.items()], "source string, source_size long, target double, whole int")
    few = len(named) <= FEW

    rows = _with_source(rows, plan, few).withColumn("copies", F.col("whole").cast("long"))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    rows = rows.withColumn("gap", rest)
    short = rows.filter((F.col("size") <= F.col("gap")) & (F.col("size") > 0))
    sums = short.groupBy("source").agg(F.sum("size").alias("s1"), F.sum(F.col("size") * F.col("size")).alias("s2"))
    rows = _with_source(rows, sums, few, "left")
    level = F.col("gap") / F.greatest(F.col("s1") - F.col("s2") / F.greatest("gap", F.lit(1.0)), F.lit(1.0))
    damped = 1 - F.col("size") / F.greatest("gap", F.lit(1.0))
    tiny = F.lit(1e-12)
    p = F.least(F.greatest(F.coalesce(level, F.lit(0.0)) * damped, tiny), 1 - tiny)
    u = uniform(F.col("doc_id"), seed)
    rank = (u / (1 - u)) / (p / (1 - p))
    # Intervals cut the ranks put back between 0 and 1, which keeps their order.
    middle = F.least(F.greatest(F.coalesce(level, F.lit(0.0)), tiny), 1 - tiny)
    spread = rank * (middle / (1 - middle))
    rows = rows.withColumn("rank", rank).withColumn("interval", F.floor(F.least(spread / (1 + spread) * INTERVALS, F.lit(INTERVALS - 1))).cast("int"))
    rows = store(rows.drop("s1", "s2").withColumn("extra", F.lit(0).cast("long")), "ranked")
    done = 0
    while True:
        open_ = _open(most, done > 1)
        sums = rows.filter(open_).groupBy("source", "interval").agg(F.sum("size").alias("words"))
        before = F.sum("words").over(Window.partitionBy("source").orderBy("interval")) - F.col("words")
        # (source, interval) rows: INTERVALS for each source at most, of which one is the limit's.
        rows = _fill(rows, sums.withColumn("before", before), open_, few, f"fill{done}")
        done += 1
        # Every pass takes the first row that fits, so this comes to an end.
        if done > 2 and not rows.filter(_open(most, True) & (F.col("gap") > NEAR * F.col("target"))).limit(1).count():
            break
    copies = F.when(F.col("size") > 0, F.col("copies") + F.col("extra")).otherwise(0)
    return rows.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", copies.alias("times"), "row")


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _with_source(left: DataFrame, right: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """left joined with one row for each source, which is broadcast where sources are few."""
    (name,) = fresh(left, "of_source")
    right = right.withColumnRenamed("source", name)
    return left.join(F.broadcast(right) if few else right, F.col("source").eqNullSafe(F.col(name)), how).drop(name)


def _open(most: int, again: bool) -> Column:
    """Whether one more copy of a document may be taken."""
    fits = (F.col("size") > 0) & (F.col("size") <= F.col("gap")) & (F.col("copies") + F.col("extra") < most)
    return fits if again else fits & (F.col("extra") == 0)


def _fill(rows: DataFrame, sums: DataFrame, open_: Column, few: bool, name: str) -> DataFrame:
    """rows with one more ``extra`` for those that fit one after the other, and ``gap`` less what they hold."""
    gaps = rows.select("source", "gap").distinct()
    limits = _with_source(sums, gaps, few).filter(F.col("before") + F.col("words") > F.col("gap"))
    limits = limits.groupBy("source").agg(F.min("interval").alias("limit"), F.min_by("before", "interval").alias("before"))
    joined = _with_source(rows, limits, few, "left")
    below = open_ & (F.col("limit").isNull() | (F.col("interval") < F.col("limit")))
    at = open_ & (F.col("interval") == F.col("limit"))
    sorted_ = Window.partitionBy("source", "interval").orderBy("rank", "doc_id", "size", "hash", "row")
    inside = joined.filter(at).withColumn("sum", F.sum("size").over(sorted_.rowsBetween(Window.unboundedPreceding, 0)))
    inside = inside.withColumn("extra", F.when(F.col("before") + F.col("sum") <= F.col("gap"), F.col("extra") + 1).otherwise(F.col("extra"))).drop("sum")
    outside = joined.filter(~F.coalesce(at, F.lit(False))).withColumn("extra", F.when(below, F.col("extra") + 1).otherwise(F.col("extra")))
    both = store(inside.unionByName(outside).drop("limit", "before"), name)
    held = both.groupBy("source").agg(F.sum(F.col("extra") * F.col("size")).alias("held"))
    gap = F.col("target") - F.col("whole") * F.col("source_size") - F.col("held")
    return _with_source(both, held, few).withColumn("gap", gap).drop("held")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES, seed: str = "mix:") -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, source.

    Size is the number of words of the text (null: 0). Each document gets the whole copies that its source's target
    contains of all of the source, floor(target / source_size). What is left of the target is a sample without
    replacement: a document's inclusion probability p falls linearly with its size, to 0 where it alone would fill the
    rest, at a level that makes the expected words the rest; documents are ranked by U / (1 - U) over p / (1 - p), and
    taken from the first on while their words fit. Further passes take, in the same order, documents that fit into what
    is still missing: first those left out, then, pass by pass, any that has fewer than ``most`` copies, until no source
    lacks more than NEAR of its target or nothing fits. Rows of one doc_id and source share their random number; null
    doc_id counts as ''. Texts without words, and null, are in no mix. Rows are told apart, where they tie, by a hash of
    all their columns. An empty table gives an empty one; other columns are left out.

    Every pass sums words by source and interval of rank; only rows of the interval in which a source's limit lies are
    sorted. So no source is ever held by one task, however large.
    """
    return _mixed(docs, weights, most, seed).drop("times", "row")


@by_place
def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES, seed: str = "mix:") -> DataFrame:
    """The rows of ``docs`` as often as mix() takes them, in their own columns; rows that it leaves out are gone.

    Every row is taken for itself: rows are numbered once, in a stored table, so none is replaced by another, however
    alike they are. Null ids, sources and texts are values like others (a null text is never taken). An empty table
    gives an empty one; columns of any name and type pass through.
    """
    number, row, times, copy = fresh(docs, "number", "row", "times", "copy")
    numbered = store(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    chosen = _mixed(numbered, weights, most, seed, number).select(F.col("row").alias(row), F.col("times").alias(times)).filter(F.col(times) > 0)
    own = numbered.join(chosen, F.col(number) == F.col(row))
    return own.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)
