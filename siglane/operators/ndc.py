"""Drug-code directory: exact and fuzzy lookup of names and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siglane.functions.text import coded, normalize_drug_name, normalize_ndc
from siglane.session import fresh

MOST_EDITS = 3


def directory(products: DataFrame, order: str) -> DataFrame:
    """One row for each code, the last in ``order``, with its search keys. Keys are only lower-cased."""
    code, row = fresh(products, "code", "row")
    last = products.groupBy(F.col("product_ndc").alias(code)).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in products.columns)), F.struct(order)).alias(row))
    return last.select(f"{row}.*").withColumns({"k_ndc": normalize_ndc(F.col("product_ndc")), "k_brand": F.lower("brand_name"), "k_generic": F.lower("generic_name")})


#: Kinds of match by their place, and what each says.
KINDS = {0: ("ExactNdc", 1.0), 1: ("ExactBrand", 1.0), 2: ("ExactGeneric", 1.0), 3: ("ExactIngredient", 0.95)}


def inverted(products: DataFrame) -> DataFrame:
    """by_code, key, product_ndc, place: a row for every key that a product is found by."""
    of = lambda place, key: F.struct(F.lit(place).alias("place"), key.alias("key"))
    listed = F.transform(F.coalesce("active_ingredients", F.array().cast("array<string>")), lambda i: of(3, F.lower(i)))
    keys = F.concat(F.array(of(0, F.col("k_ndc")), of(1, F.col("k_brand")), of(2, F.col("k_generic"))), listed)
    rows = products.select("product_ndc", F.explode(keys).alias("k")).filter("k.key is not null")
    return rows.select((F.col("k.place") == 0).alias("by_code"), "k.key", "product_ndc", "k.place")


def lookup(queries: DataFrame, products: DataFrame, fuzzy: bool = False) -> DataFrame:
    """query, product_ndc, match_type, confidence. ``queries`` has query; ``products`` is a directory().

    A code that matches stands alone; else brands, generics and ingredients match by name, each code by its first kind
    of match; only queries without any match are compared by edit distance. A query's matches come by confidence.
    All keys of a query meet all keys of the directory in one join.
    """
    q = queries.select("query").distinct().withColumns({"q_ndc": normalize_ndc(F.col("query")), "q_name": normalize_drug_name(F.col("query"))})
    asked = q.select("query", F.explode(F.array(F.struct(F.lit(True).alias("by_code"), F.col("q_ndc").alias("key")), F.struct(F.lit(False).alias("by_code"), F.col("q_name").alias("key")))).alias("k"))
    hits = asked.select("query", "k.by_code", "k.key").join(inverted(products), ["by_code", "key"]).select("query", "product_ndc", "place")
    # Dealt by query, which is enough for a code's first place and for the query's least.
    best = hits.repartition("query").groupBy("query", "product_ndc").agg(F.min("place").alias("place"))
    best = best.withColumn("least", F.min("place").over(Window.partitionBy("query"))).filter("least > 0 or place = 0").drop("least")
    kind, sure = (coded(F.col("place"), {k: v[i] for k, v in KINDS.items()}) for i in (0, 1))
    found = best.select("query", "product_ndc", kind.alias("match_type"), sure.alias("confidence"), "place")
    if fuzzy:
        near = _fuzzy(q.join(found.select("query").distinct(), "query", "left_anti"), products)
        first = F.min(F.struct("place", "match_type", "confidence")).alias("x")
        found = found.unionByName(near.groupBy("query", "product_ndc").agg(first).select("query", "product_ndc", "x.match_type", "x.confidence", "x.place"))
    return found.orderBy("query", F.desc("confidence"), "place", "product_ndc").select("query", "product_ndc", "match_type", "confidence")


def _fuzzy(q: DataFrame, products: DataFrame) -> DataFrame:
    """Names within MOST_EDITS edits. Each name and query is cut into MOST_EDITS + 1 pieces by the name's length: of two
    within MOST_EDITS edits one piece of the name is found whole in the query, up to MOST_EDITS places off. So pairs
    meet by (length of the name, piece number, piece), an equi-join, and only those are measured."""
    names = products.select("product_ndc", F.col("k_brand").alias("name"), F.lit(4).alias("place")).unionByName(products.select("product_ndc", F.col("k_generic").alias("name"), F.lit(5).alias("place"))).filter("name is not null")
    k = MOST_EDITS + 1
    bounds = F.expr(f"transform(sequence(0, {k - 1}), p -> struct(p as p, cast(floor(len * p / {k}) as int) as s, cast(floor(len * (p + 1) / {k}) as int) as e))")
    pieces = names.select("name").distinct().withColumn("len", F.length("name")).withColumn("x", F.explode(bounds)).select("name", "len", "x.p", F.expr("substring(name, x.s + 1, x.e - x.s)").alias("piece"))
    near = q.select("query", "q_name").withColumn("len", F.explode(F.expr(f"sequence(greatest(length(q_name) - {MOST_EDITS}, 0), length(q_name) + {MOST_EDITS})")))
    near = near.withColumn("x", F.explode(bounds)).withColumn("off", F.explode(F.expr(f"sequence(greatest(x.s - {MOST_EDITS}, 0), x.s + {MOST_EDITS})")))
    near = near.select("query", "q_name", "len", "x.p", F.expr("substring(q_name, off + 1, x.e - x.s)").alias("piece")).distinct()
    met = near.join(pieces, ["len", "p", "piece"]).select("query", "q_name", "name").distinct()
    met = met.withColumn("d", F.levenshtein("q_name", "name", MOST_EDITS)).filter("d >= 0")
    most = F.greatest(F.octet_length("q_name"), F.octet_length("name"), F.lit(1))
    met = met.withColumn("confidence", 1.0 - F.col("d") / most)
    return met.join(names, "name").select("query", "product_ndc", F.lit("Fuzzy").alias("match_type"), "confidence", "place")


def directory_size(products: DataFrame) -> DataFrame:
    return products.agg(F.countDistinct("product_ndc").alias("codes"), F.countDistinct("k_brand").alias("brand_names"), F.countDistinct("k_generic").alias("generic_names"))


def names(products: DataFrame, kind: str) -> DataFrame:
    """name: the distinct search names of a directory, ``kind`` being brand or generic, in their order."""
    return products.select(F.col(f"k_{kind}").alias("name")).filter("name is not null").distinct().orderBy("name")


def is_empty(products: DataFrame) -> bool:
    return products.isEmpty()
