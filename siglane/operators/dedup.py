"""Duplicate reports: fingerprints, similarity, clusters and their primary reports."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglane.functions.text import month_of
from siglane.schema import DedupConfig
from siglane.session import fresh

#: Fields of a fingerprint and what each weighs in a similarity.
WEIGHTS = {"age_bucket": 1, "sex": 1, "country": 1, "event_month": 2, "fp_drug": 3, "fp_reaction": 2}
#: Fields of a report, of its fingerprint, and those that are lost between them.
REPORT_DIMENSION, FINGERPRINT_DIMENSION = 13, 7
CODIMENSION = REPORT_DIMENSION - FINGERPRINT_DIMENSION
RADIUS, STRICT_RADIUS, LENIENT_RADIUS = 0.15, 0.05, 0.30


def fingerprint(reports: DataFrame, config: DedupConfig = DedupConfig()) -> DataFrame:
    """reports with the seven fingerprint columns."""
    return reports.withColumns({
        "age_bucket": (F.floor(F.col("patient_age") / config.age_bucket) * config.age_bucket).cast("int"),
        "sex": F.col("patient_sex"),
        "country": F.col("occur_country"),
        "event_month": month_of(F.col("event_date")),
        "fp_drug": F.upper("primary_drug"),
        "fp_reaction": F.upper("primary_reaction"),
        "fp_mfr": F.upper(F.trim("mfr_num")),
    })


#: The fingerprint as an embedding of reports into fewer dimensions.
embed = fingerprint


def in_image() -> Column:
    """Whether a fingerprint is some report's: each is, as its fields are those of a report that has no others."""
    return F.lit(True)


def similarity(x: str, y: str) -> Column:
    """Similarity of the fingerprints in columns with prefixes x and y."""
    matches, total = F.lit(0), F.lit(0)
    for name, weight in WEIGHTS.items():
        a, b = F.col(x + name), F.col(y + name)
        there = a.isNotNull() | b.isNotNull()
        total += F.when(there, weight).otherwise(0)
        matches += F.when(there & a.eqNullSafe(b), weight).otherwise(0)
    same = (F.col(x + "fp_mfr") == F.col(y + "fp_mfr")) & (F.col(x + "fp_mfr") != "")
    return F.when(F.coalesce(same, F.lit(False)), 1.0).otherwise(F.coalesce(F.try_divide(matches, total), F.lit(0.0)))


def is_potential_duplicate(x: str, y: str, radius: float = RADIUS) -> Column:
    """Whether the fingerprints in columns with prefixes x and y lie within ``radius``, which belongs to it."""
    return 1.0 - similarity(x, y) <= radius


def completeness() -> Column:
    fields = ("patient_age", "patient_sex", "patient_weight", "occur_country", "primary_drug", "primary_reaction", "event_date", "report_type")
    return sum((F.col(c).isNotNull().cast("int") for c in fields), F.lit(0)) + F.col("mfr_num").isNotNull().cast("int") * 2


def deduplicate(reports: DataFrame, order: str, config: DedupConfig = DedupConfig()) -> DataFrame:
    """reports with cluster, cluster_size, is_primary. ``order`` is a column with the rows' order, which tells them apart.

    Reports with a manufacturer number cluster by it, all others by their whole fingerprint; a report whose fields are
    all null is alone. The latest version, then the most complete report, then the first in order is primary; of rows
    that have one place in the order, all are. A cluster's primary and size are summed up by each task before they meet
    and joined back to its reports, so that one number on half of all reports makes no long task.
    """
    rows = fingerprint(reports, config)
    by_number = F.coalesce(F.col("fp_mfr") != "", F.lit(False))
    names = [*WEIGHTS, "fp_mfr"]
    blank = F.coalesce(*(F.col(c).cast("string") for c in WEIGHTS)).isNull()
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in names]
    key = F.when(by_number, F.concat(F.lit("m|"), F.col("fp_mfr"))).when(blank, F.concat(F.lit("o|"), F.col(order).cast("string"))).otherwise(F.concat(F.lit("f|"), F.concat_ws("|", *parts)))
    version = [F.col("case_version").isNull(), -F.col("case_version")] * config.prefer_latest
    best = F.struct(*version, *[-completeness()] * config.prefer_complete, F.col(order).isNull(), F.col(order))
    best_name, first, of = fresh(rows, "best", "first", "of")
    rows = rows.withColumn("cluster", key).withColumn(best_name, best)
    found = rows.groupBy(F.col("cluster").alias(of)).agg(F.count("*").alias("cluster_size"), F.min(best_name).alias(first))
    out = rows.join(found, F.col("cluster") == F.col(of))
    return out.withColumn("is_primary", F.col(best_name) == F.col(first)).drop(*names, best_name, first, of)


def dedup_summary(clustered: DataFrame) -> DataFrame:
    """One row: reports, clusters, reports removed."""
    return clustered.agg(F.count("*").alias("input_count"), F.count_if("is_primary").alias("unique_count"), F.count_if(~F.col("is_primary")).alias("removed_count"))


def _may_differ(radius: float) -> list[set[str]]:
    """The largest sets of fields in which two reports within ``radius`` may differ: no more than its share of all weights."""
    most = radius * sum(WEIGHTS.values()) + 1e-9
    fits = [set(c) for n in range(len(WEIGHTS) + 1) for c in combinations(WEIGHTS, n) if sum(WEIGHTS[f] for f in c) <= most]
    return [c for c in fits if not any(c < other for other in fits)]


def neighbour_classes(reports: DataFrame, key: str, radius: float = RADIUS, config: DedupConfig = DedupConfig()) -> tuple[DataFrame, DataFrame]:
    """(class, way, group: which classes may be within ``radius``; report, class, number, fields of each report).

    A class is all reports that agree in every field of the fingerprint but the manufacturer number, named by its
    smallest key; number is the smallest key of those with the report's manufacturer number, or null. Reports with one
    number are at distance 0; all others are as far apart as their classes.

    A way is a set of fields that may differ within the radius, by its place among _may_differ(). The classes that agree
    in all other fields, null equal to null, are a group of that way, named by its smallest class; groups of one are
    left out. So there are a few rows for each report, however many of them are alike; links() gives the pairs of
    classes and expand() those of reports.
    """
    fp = fingerprint(reports, config).select(F.col(key).alias("report"), F.struct(*WEIGHTS).alias("fields"), F.when(F.col("fp_mfr") != "", F.col("fp_mfr")).alias("number"))
    classes = fp.groupBy("fields").agg(F.min("report").alias("class"))
    numbers = fp.filter("number is not null").groupBy("number").agg(F.min("report").alias("of_number"))
    members = fp.join(classes, "fields").join(numbers, "number", "left").select("report", "class", F.col("of_number").alias("number"), "fields")
    kinds = dict(classes.select("fields.*").dtypes)
    ways = [F.struct(F.lit(k).alias("way"), F.struct(*(F.lit(None).cast(kinds[c]).alias(c) if c in differ else F.col(f"fields.{c}").alias(c) for c in WEIGHTS)).alias("rest")) for k, differ in enumerate(_may_differ(radius) if radius >= 0 else [])]
    if not ways:
        return classes.select("class", F.lit(0).alias("way"), F.col("class").alias("group")).limit(0), members
    # Two reports without any field have similarity 0.
    there = F.coalesce(*(F.col(f"fields.{c}").cast("string") for c in WEIGHTS)).isNotNull()
    own = (classes if radius >= 1 else classes.filter(there)).select("class", F.explode(F.array(*ways)).alias("k"))
    groups = own.groupBy("k").agg(F.min("class").alias("group"), F.count("*").alias("n")).filter("n > 1")
    return own.join(groups, "k").select("class", "k.way", "group"), members


def links(groups: DataFrame, members: DataFrame, radius: float = RADIUS) -> DataFrame:
    """a, b, distance: the pairs of classes within ``radius`` that neighbour_classes() stands for, each with itself too."""
    classes = members.groupBy("class").agg(F.first("fields").alias("fields")).select("class", "fields.*")
    x = classes.select([F.col(c).alias("x_" + c) for c in classes.columns] + [F.lit("").alias("x_fp_mfr")])
    y = classes.select([F.col(c).alias("y_" + c) for c in classes.columns] + [F.lit("").alias("y_fp_mfr")])
    there = F.coalesce(*(F.col("x_" + c).cast("string") for c in WEIGHTS)).isNotNull()
    own = x.select(F.col("x_class").alias("a"), F.col("x_class").alias("b"), F.when(there, 0.0).otherwise(1.0).alias("distance"))
    one = groups.join(x, F.col("class") == F.col("x_class")).drop("class")
    two = groups.select(F.col("class").alias("c"), F.col("way").alias("w"), F.col("group").alias("g")).join(y, F.col("c") == F.col("y_class")).drop("c")
    # A pair counts in the first way in which it meets.
    first = F.lit(None).cast("int")
    for k, differ in reversed(list(enumerate(_may_differ(radius) if radius >= 0 else []))):
        meets = reduce(lambda p, c: p & F.col("x_" + c).eqNullSafe(F.col("y_" + c)), [c for c in WEIGHTS if c not in differ], F.lit(True))
        first = F.when(meets, k).otherwise(first)
    met = one.join(two, (F.col("way") == F.col("w")) & (F.col("group") == F.col("g")) & (F.col("x_class") < F.col("y_class"))).filter(F.col("way") == first)
    met = met.select(F.col("x_class").alias("a"), F.col("y_class").alias("b"), (1.0 - similarity("x_", "y_")).alias("distance"))
    return own.unionByName(met).filter(F.col("distance") <= radius)


def expand(pairs: DataFrame, members: DataFrame, block: str | None = None) -> DataFrame:
    """a, b, distance: the pairs of reports of links(); with ``block``, a field of the fingerprint, only those that are
    equal in it."""
    x = members.select(F.col("report").alias("x"), F.col("class").alias("x_class"), F.col("number").alias("x_number"), F.col("fields").alias("x_fields"))
    y = members.select(F.col("report").alias("y"), F.col("class").alias("y_class"), F.col("number").alias("y_number"), F.col("fields").alias("y_fields"))
    same = x.join(y, (F.col("x_number") == F.col("y_number")) & (F.col("x") < F.col("y"))).withColumn("distance", F.lit(0.0))
    apart = ~F.coalesce(F.col("x_number") == F.col("y_number"), F.lit(False))
    met = pairs.join(x, F.col("a") == F.col("x_class")).join(y, F.col("b") == F.col("y_class")).filter(apart & ((F.col("a") != F.col("b")) | (F.col("x") < F.col("y"))))
    out = same.select("x", "y", "x_fields", "y_fields", "distance").unionByName(met.select("x", "y", "x_fields", "y_fields", "distance"))
    if block:
        out = out.filter(F.col(f"x_fields.{block}").eqNullSafe(F.col(f"y_fields.{block}")))
    return out.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "distance")


def neighbours(reports: DataFrame, key: str, radius: float = RADIUS, block: str | None = None, config: DedupConfig = DedupConfig()) -> DataFrame:
    """a, b, distance: all pairs of reports whose distance, 1 - similarity, is ``radius`` at most; with ``block``, a
    field of the fingerprint other than the number, only those that are equal in it. Of n reports of one number that is n (n - 1) / 2 rows:
    neighbour_classes() says the same in n."""
    groups, members = neighbour_classes(reports, key, radius, config)
    return expand(links(groups, members, radius), members, block)
