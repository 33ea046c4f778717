"""Report-shaped views of the star-schema tables, in DataFrame form and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglane.operators import contingency
from siglane.schema import SUSPECT_ROLES


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Role of a line by its return flag.
ROLES = {"A": "PS", "R": "SS"}


def drugs(spark: SparkSession, d: str, roles: tuple[str, ...] | None = None) -> DataFrame:
    """case_id, drug, role: a row for each line; with ``roles`` only lines of these suspect roles, chosen in the scan."""
    lines = table(spark, d, "lineitem")
    if roles:
        lines = lines.filter(F.col("l_returnflag").isin(*(k for k, r in ROLES.items() if r in roles)))
    part = table(spark, d, "part").select("p_partkey", F.upper(F.concat_ws(" ", "p_brand", "p_type")).alias("drug"))
    role = F.when(F.col("l_returnflag") == "A", "PS").when(F.col("l_returnflag") == "R", "SS").otherwise("C")
    return lines.select(F.col("l_orderkey").alias("case_id"), "l_partkey", role.alias("role")).join(part, F.col("l_partkey") == F.col("p_partkey")).select("case_id", "drug", "role")


def size(spark: SparkSession, d: str) -> int:
    """Lines, and so the rows of drugs() and the most of reactions(): from the footers of the files."""
    return table(spark, d, "lineitem").count()


def reactions(spark: SparkSession, d: str) -> DataFrame:
    """case_id, event: distinct, dealt by case."""
    part = table(spark, d, "part").select("p_partkey", F.upper("p_name").alias("event"))
    events = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("case_id"), "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey")).select("case_id", "event")
    return contingency.dealt(events, "case_id", size(spark, d)).distinct()


def rows(spark: SparkSession, d: str, all_roles: bool = False) -> DataFrame:
    """case_id, drug, role, event."""
    lines = contingency.select_roles(drugs(spark, d, None if all_roles else SUSPECT_ROLES), all_roles)
    return contingency.cross_events(contingency.dealt(lines, "case_id", size(spark, d)), reactions(spark, d))


def cases(spark: SparkSession, d: str) -> DataFrame:
    """A row for each line of a suspect drug: drug, event and the codes that the analytics need."""
    part = table(spark, d, "part").select("p_partkey", F.upper(F.concat_ws(" ", "p_brand", "p_type")).alias("drug"), F.upper("p_name").alias("event"))
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.substring("o_orderpriority", 1, 1).alias("qualification"), F.date_format("o_orderdate", "yyyyMMdd").alias("receipt_date"))
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    lines = table(spark, d, "lineitem").filter(F.col("l_returnflag").isin("A", "R")).select("l_orderkey", "l_partkey", F.col("l_linenumber").cast("string").alias("outcome_code"), F.col("l_quantity").cast("int").alias("q"))
    out = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    names = ("other", "hospitalization", "disabling", "life_threatening", "congenital", "death")
    flags = [F.when(F.col("q").bitwiseAND(1 << k) > 0, "1").alias(x) for k, x in enumerate(names)]
    return out.select("drug", "event", "outcome_code", "qualification", "receipt_date", "country", *flags)


def combinations(spark: SparkSession, d: str) -> DataFrame:
    """case_id, drugs, event: a row for each order, with the least name among its events."""
    part = table(spark, d, "part").select("p_partkey", "p_brand", F.upper("p_name").alias("event"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy(F.col("l_orderkey").alias("case_id")).agg(F.collect_list("p_brand").alias("drugs"), F.min("event").alias("event"))


def reports(spark: SparkSession, d: str) -> DataFrame:
    """A report for each order, in the 13 fields of reports, and ``ord``."""
    customer = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    o = table(spark, d, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    return o.select(
        key.cast("string").alias("safety_report_id"), (key % 3 + 1).cast("int").alias("case_version"), F.date_format("o_orderdate", "yyyyMMdd").alias("receipt_date"), (F.col("o_custkey") % 90).cast("int").alias("patient_age"),
        F.col("o_orderstatus").alias("patient_sex"), F.lit(70.0).alias("patient_weight"), F.col("c_mktsegment").alias("occur_country"), F.col("o_orderpriority").alias("primary_drug"), F.lit("Headache").alias("primary_reaction"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("event_date"), F.lit(1).alias("report_type"), F.lit(True).alias("serious"), F.when(key % 3 == 0, F.concat(F.lit(" mfr-"), (key % 1000).cast("string"))).alias("mfr_num"), key.alias("ord"),
    )


def products(spark: SparkSession, d: str) -> DataFrame:
    """A directory of parts."""
    # Keys of more digits are whole: lpad() alone would cut them.
    padded = lambda c, n: F.lpad(F.col(c).cast("string"), F.greatest(F.lit(n), F.length(F.col(c).cast("string"))), F.lit("0"))
    code = F.concat(padded("p_partkey", 6), F.lit("-"), padded("p_size", 3))
    return table(spark, d, "part").select(code.alias("product_ndc"), F.col("p_name").alias("brand_name"), F.col("p_type").alias("generic_name"), F.col("p_brand").alias("labeler_name"), F.array("p_brand").alias("active_ingredients"), F.col("p_partkey").alias("ord"))


def openfda(spark: SparkSession, d: str) -> DataFrame:
    """Nested reports of one drug line and its event each."""
    part = table(spark, d, "part")
    line = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    code = F.when(F.col("l_returnflag") == "A", "1").otherwise("2")
    drug = F.struct(code.alias("drugcharacterization"), F.lower("p_brand").alias("medicinalproduct"))
    event = F.struct(F.lower("p_name").alias("reactionmeddrapt"), F.lit("1").alias("reactionoutcome"))
    return line.select(F.col("l_orderkey").cast("string").alias("safetyreportid"), F.struct(F.array(drug).alias("drug"), F.array(event).alias("reaction")).alias("patient"))


#: The views in SQL, to put before a query.
SQL = """
drugs AS (SELECT l_orderkey AS case_id, upper(p_brand || ' ' || p_type) AS drug, CASE l_returnflag WHEN 'A' THEN 'PS' WHEN 'R' THEN 'SS' ELSE 'C' END AS role FROM lineitem JOIN part ON l_partkey = p_partkey),
reactions AS (SELECT DISTINCT l_orderkey AS case_id, upper(p_name) AS event FROM lineitem JOIN part ON l_partkey = p_partkey),
all_rows AS (SELECT d.case_id, drug, role, event FROM drugs d JOIN reactions r ON d.case_id = r.case_id),
sus AS (SELECT * FROM all_rows WHERE role IN ('PS', 'SS')),
counts AS (SELECT drug, event, count(*) AS n FROM sus GROUP BY drug, event),
kept AS (SELECT * FROM counts WHERE n >= 3),
margins AS (SELECT drug, event, n, CAST(sum(n) OVER (PARTITION BY drug) AS BIGINT) AS drug_total, CAST(sum(n) OVER (PARTITION BY event) AS BIGINT) AS event_total, CAST(sum(n) OVER () AS BIGINT) AS total FROM kept),
cells AS (SELECT drug, event, n AS a, greatest(drug_total - n, 0) AS b, greatest(event_total - n, 0) AS c, greatest(total - (drug_total + event_total - n), 0) AS d FROM margins),
half AS (SELECT *, CASE WHEN least(a, b, c, d) = 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS h FROM cells),
fixed AS (SELECT *, a + h AS xa, b + h AS xb, c + h AS xc, d + h AS xd, CAST(a + b + c + d AS DOUBLE) AS t, CAST(a AS DOUBLE) AS fa, CAST(b AS DOUBLE) AS fb, CAST(c AS DOUBLE) AS fc, CAST(d AS DOUBLE) AS fd FROM half),
metrics AS (SELECT drug, event, a AS n,
  (xa / (xa + xb)) / (xc / (xc + xd)) AS prr, sqrt(greatest(1 / xa - 1 / (xa + xb) + 1 / xc - 1 / (xc + xd), 0)) AS prr_se,
  (xa * xd) / (xb * xc) AS ror, sqrt(1 / xa + 1 / xb + 1 / xc + 1 / xd) AS ror_se,
  CASE WHEN (fa + fb) * (fc + fd) * (fa + fc) * (fb + fd) > 0 THEN t * greatest(abs(fa * fd - fb * fc) - t / 2, 0) ** 2 / ((fa + fb) * (fc + fd) * (fa + fc) * (fb + fd)) ELSE 0 END AS chi,
  log2((a + 0.5) / ((fa + fb) * (fa + fc) / t + 0.5)) AS ic FROM fixed),
freq AS (SELECT drug, event, n, prr, exp(ln(prr) - 1.96 * prr_se) AS prr_lower_ci, exp(ln(prr) + 1.96 * prr_se) AS prr_upper_ci, prr >= 2 AND chi >= 4 AND n >= 3 AS prr_signal,
  ror, exp(ln(ror) - 1.96 * ror_se) AS ror_lower_ci, exp(ln(ror) - 1.96 * ror_se) > 1 AND n >= 3 AS ror_signal,
  ic, ic - 3.3 * (n + 0.5) ** -0.5 - 2 * (n + 0.5) ** -1.5 AS ic025, ic - 3.3 * (n + 0.5) ** -0.5 - 2 * (n + 0.5) ** -1.5 > 0 AS ic_signal FROM metrics),
cases AS (SELECT upper(p_brand || ' ' || p_type) AS drug, upper(p_name) AS event, CAST(l_linenumber AS VARCHAR) AS code, substr(o_orderpriority, 1, 1) AS qualification, strftime(o_orderdate, '%Y%m') AS month, upper(n_name) AS country, CAST(l_quantity AS INTEGER) AS q
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_returnflag IN ('A', 'R')),
lines AS (SELECT l_orderkey AS case_id, upper(p_brand) AS drug, upper(p_name) AS event FROM lineitem JOIN part ON l_partkey = p_partkey),
combos AS (SELECT case_id, min(event) AS event FROM lines GROUP BY case_id),
reports AS (SELECT o_orderkey AS ord, o_orderkey % 3 + 1 AS version, CAST(floor((o_custkey % 90) / 5) * 5 AS INTEGER) AS age, o_orderstatus AS sex, c_mktsegment AS country, strftime(o_orderdate, '%Y%m') AS month, upper(o_orderpriority) AS drug,
  CASE WHEN o_orderkey % 3 = 0 THEN 'MFR-' || (o_orderkey % 1000) END AS mfr FROM orders JOIN customer ON o_custkey = c_custkey),
clusters AS (SELECT *, coalesce('m|' || mfr, 'f|=' || age || '|=' || sex || '|=' || country || '|=' || month || '|=' || drug || '|=HEADACHE|-') AS cluster FROM reports),
primaries AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS cluster_size, row_number() OVER (PARTITION BY cluster ORDER BY version DESC, ord) = 1 AS is_primary FROM clusters)
"""
