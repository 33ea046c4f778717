"""Outcome, velocity, seriousness, polypharmacy, reporter and geographic analytics.

Names are upper-cased; results come in a stated order with drug and event as tie-breaks, so reruns agree.
All sums are algebraic: no group is collected, and partial sums are made before rows are dealt.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siglane.functions.stats import chi_squared_tail, ratio
from siglane.functions.text import coded, month_of
from siglane.schema import (
    OUTCOME_WEIGHTS,
    REPORTER_WEIGHTS,
    SERIOUSNESS_WEIGHTS,
    CascadeConfig,
    GeographicConfig,
    OutcomeConfig,
    PolypharmacyConfig,
    ReporterConfig,
    VelocityConfig,
)

PAIR = ("drug", "event")


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"drug": F.upper("drug"), "event": F.upper("event")})


def outcome_conditioned(cases: DataFrame, prrs: DataFrame, config: OutcomeConfig = OutcomeConfig()) -> DataFrame:
    """PRR adjusted by the mean severity of known outcomes. cases: drug, event, outcome_code; prrs: drug, event, prr."""
    code = F.trim("outcome_code")
    rows = _named(cases).withColumn("code", code).withColumn("weight", coded(code, OUTCOME_WEIGHTS))
    counts = [F.count_if(F.col("code") == k).alias(f"n_{k}") for k in OUTCOME_WEIGHTS]
    by = rows.groupBy(*PAIR).agg(F.count("*").alias("total"), F.count("weight").alias("known"), F.sum("weight").alias("weights"), *counts)
    by = by.filter((F.col("total") >= config.min_cases) & (F.col("known") > 0)).join(prrs.select(*PAIR, "prr"), list(PAIR), "left")
    osi, prr = F.col("weights") / F.col("known"), F.coalesce("prr", F.lit(1.0))
    out = by.select(*PAIR, "total", "known", *(f"n_{k}" for k in OUTCOME_WEIGHTS), osi.alias("osi"), (F.col("n_5") / F.col("known")).alias("fatality_rate"), prr.alias("standard_prr"), (1.0 + osi / 5.0).alias("severity_factor"), (prr * (1.0 + osi / 5.0)).alias("adjusted_prr"))
    return out.withColumn("is_signal", F.col("adjusted_prr") >= config.threshold).orderBy(F.desc("adjusted_prr"), *PAIR)


def monthly_counts(cases: DataFrame) -> DataFrame:
    """drug, event, month, n; rows without a month go."""
    return _named(cases).withColumn("month", month_of(F.col("receipt_date"))).filter("month is not null").groupBy(*PAIR, "month").agg(F.count("*").alias("n"))


def signal_velocity(cases: DataFrame, known: DataFrame, config: VelocityConfig = VelocityConfig()) -> DataFrame:
    """First and second differences of counts between active months. cases: drug, event, receipt_date; known: drug, event, prr."""
    w = Window.partitionBy(*PAIR).orderBy("month")
    months = monthly_counts(cases).withColumn("v", F.col("n") - F.lag("n").over(w))
    months = months.withColumn("a", F.col("v") - F.lag("v").over(w))
    by = months.groupBy(*PAIR).agg(
        F.sum("n").alias("total"), F.count("*").alias("active_months"), F.avg("v").alias("mean_velocity"),
        F.max(F.when(F.col("v").isNotNull(), F.struct("v", "month"))).alias("peak"), F.max(F.struct("month", "v", "a")).alias("last"),
    )
    by = by.filter((F.col("active_months") >= max(config.min_months, 2)) & (F.col("total") >= config.min_cases))
    by = by.join(known.select(*PAIR, "prr"), list(PAIR), "left")
    fast = F.coalesce(F.col("last.a"), F.lit(0)) > config.acceleration
    out = by.select(
        *PAIR, "total", "active_months", F.col("last.v").cast("double").alias("velocity"), F.coalesce(F.col("last.a"), F.lit(0)).cast("double").alias("acceleration"), "mean_velocity",
        F.col("peak.v").cast("double").alias("peak_velocity"), F.col("peak.month").alias("peak_month"), fast.alias("is_accelerating"), (fast & (F.coalesce("prr", F.lit(0.0)) < config.known_prr)).alias("is_early_warning"),
    )
    return out.orderBy(F.desc("acceleration"), *PAIR)


def seriousness_cascade(cases: DataFrame, config: CascadeConfig = CascadeConfig()) -> DataFrame:
    """Severity over time. cases: drug, event, receipt_date and a string column for each flag; only "1" sets one."""
    flags = {k: F.col(k).eqNullSafe("1") for k in SERIOUSNESS_WEIGHTS}
    score = sum((F.when(on, SERIOUSNESS_WEIGHTS[k]).otherwise(0.0) for k, on in flags.items()), F.lit(0.0))
    rows = _named(cases).withColumn("score", score).withColumn("month", month_of(F.col("receipt_date")))
    by_month = rows.groupBy(*PAIR, "month").agg(F.count("*").alias("n"), F.sum("score").alias("scores"), *(F.count_if(on).alias(k) for k, on in flags.items()))
    dated = by_month.filter("month is not null").withColumn("x", F.row_number().over(Window.partitionBy(*PAIR).orderBy("month")) - 1)
    slopes = dated.groupBy(*PAIR).agg(F.count("*").alias("months"), F.regr_slope(F.col("scores") / F.col("n"), F.col("x")).alias("slope"))
    by = by_month.groupBy(*PAIR).agg(F.sum("n").alias("total"), F.sum("scores").alias("scores"), *(F.sum(k).alias(k) for k in flags)).filter(F.col("total") >= config.min_cases)
    by = by.join(slopes, list(PAIR), "left")
    months, slope = F.coalesce("months", F.lit(0)), F.when(F.col("months") >= 2, F.coalesce("slope", F.lit(0.0))).otherwise(0.0)
    rising = (slope > 0) & (months >= 2)
    rate = F.col("death") / F.col("total")
    worst = F.coalesce(*(F.when(F.col(k) > 0, k) for k, _ in sorted(SERIOUSNESS_WEIGHTS.items(), key=lambda x: -x[1])))
    out = by.select(*PAIR, "total", (F.col("scores") / F.col("total")).alias("mean_cascade"), *((F.col(k) / F.col("total")).alias(f"{k}_rate") for k in flags), worst.alias("max_severity"), months.alias("months"), slope.alias("velocity"), rising.alias("is_escalating"), ((rate >= config.death_rate) | (rising & (F.col("death") > 0))).alias("requires_review"))
    return out.orderBy(F.desc("velocity"), *PAIR)


def _drug_pairs(cases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(drug entries, distinct ordered pairs, cases) by event. cases: drugs array<string>, event; one row a case."""
    named = cases.select(F.upper("event").alias("event"), F.transform("drugs", lambda d: F.upper(d)).alias("drugs"))
    singles = named.select("event", F.explode("drugs").alias("drug"))
    distinct = F.array_sort(F.array_distinct("drugs"))
    # The pairs of a case are the operator's result, not an intermediate: a case lists its own few drugs.
    first = named.select("event", distinct.alias("drugs")).select("event", "drugs", F.posexplode("drugs").alias("i", "drug_a"))
    pairs = first.select("event", "drug_a", F.explode(F.slice("drugs", F.col("i") + 2, F.size("drugs"))).alias("drug_b"))
    return singles, pairs, named


def polypharmacy(cases: DataFrame, config: PolypharmacyConfig = PolypharmacyConfig()) -> DataFrame:
    """Interaction of drug pairs by the simplified ratios: a pair's or drug's rate over the event's rate, times all cases
    over its own.

    The count of the pair or drug cancels out of its ratio, so the ratios of one event are equal but for rounding and the
    interaction is 0; polypharmacy_corrected() has exposure groups.
    """
    singles, pairs, named = _drug_pairs(cases)
    by_event = named.groupBy("event").agg(F.count("*").alias("event_total"))
    by_drug = singles.groupBy("drug", "event").agg(F.count("*").alias("n"))
    by_pair = pairs.groupBy("drug_a", "drug_b", "event").agg(F.count("*").alias("pair_count")).filter(F.col("pair_count") >= config.min_pair_count)
    out = by_pair.join(by_event, "event").join(by_drug.withColumnsRenamed({"drug": "drug_a", "n": "a_count"}), ["drug_a", "event"]).join(by_drug.withColumnsRenamed({"drug": "drug_b", "n": "b_count"}), ["drug_b", "event"])
    out = out.crossJoin(F.broadcast(named.agg(F.count("*").alias("total"))))
    zero = F.lit(0)

    def simplified(n: str) -> Column:
        rate, of_event = F.col(n) / F.col("total"), F.col("event_total") / F.col("total")
        return F.when(F.col(n) > 0, rate / of_event * F.col("total") / F.col(n)).otherwise(0.0)

    out = out.withColumns({"pair_prr": simplified("pair_count"), "prr_a": simplified("a_count"), "prr_b": simplified("b_count")})
    out = out.withColumn("interaction", F.round(F.col("pair_prr") - F.greatest("prr_a", "prr_b"), 9) + 0.0)
    out = out.select("drug_a", "drug_b", "event", "pair_count", F.greatest(F.col("a_count") - F.col("pair_count"), zero).alias("a_only"), F.greatest(F.col("b_count") - F.col("pair_count"), zero).alias("b_only"), "event_total", "pair_prr", "prr_a", "prr_b", "interaction")
    return out.withColumn("is_synergistic", F.col("interaction") > config.interaction).orderBy(F.desc("interaction"), "drug_a", "drug_b", "event")


def polypharmacy_corrected(cases: DataFrame, config: PolypharmacyConfig = PolypharmacyConfig()) -> DataFrame:
    """Interaction of drug pairs from the PRR of each exposure against cases without it.

    An exposure (both drugs, one drug) counts once a case; PRR is [a/(a+b)]/[c/(c+d)], with half a case in each cell
    where one is 0.
    """
    singles, pairs, named = _drug_pairs(cases.withColumn("drugs", F.array_distinct(F.transform("drugs", lambda d: F.upper(d)))))
    event = named.groupBy("event").agg(F.count("*").alias("event_total"))
    by_drug = singles.groupBy("drug", "event").agg(F.count("*").alias("n"))
    of_drug = singles.groupBy("drug").agg(F.count("*").alias("exposed"))
    by_drug = by_drug.join(of_drug, "drug")
    by_pair = pairs.groupBy("drug_a", "drug_b", "event").agg(F.count("*").alias("pair_count")).filter(F.col("pair_count") >= config.min_pair_count)
    of_pair = pairs.groupBy("drug_a", "drug_b").agg(F.count("*").alias("exposed"))
    out = by_pair.join(of_pair, ["drug_a", "drug_b"]).join(event, "event").crossJoin(F.broadcast(named.agg(F.count("*").alias("total"))))
    for x in "ab":
        out = out.join(by_drug.withColumnsRenamed({"drug": f"drug_{x}", "n": f"{x}_count", "exposed": f"{x}_exposed"}), [f"drug_{x}", "event"])

    def prr(n, exposed):
        a, b, c = F.col(n), F.col(exposed) - F.col(n), F.col("event_total") - F.col(n)
        d = F.col("total") - F.col(exposed) - c
        half = F.when(F.least(a, b, c, d) == 0, 0.5).otherwise(0.0)
        return ((a + half) / (a + b + 2 * half)) / ((c + half) / (c + d + 2 * half))

    out = out.withColumns({"pair_prr": prr("pair_count", "exposed"), "prr_a": prr("a_count", "a_exposed"), "prr_b": prr("b_count", "b_exposed")})
    out = out.withColumn("interaction", F.col("pair_prr") - F.greatest("prr_a", "prr_b")).withColumn("is_synergistic", F.col("interaction") > config.interaction)
    return out.select("drug_a", "drug_b", "event", "pair_count", "event_total", "pair_prr", "prr_a", "prr_b", "interaction", "is_synergistic").orderBy(F.desc("interaction"), "drug_a", "drug_b", "event")


def reporter_weighted(cases: DataFrame, config: ReporterConfig = ReporterConfig()) -> DataFrame:
    """Counts weighted by the reporter's qualification, and their diversity. cases: drug, event, qualification."""
    code = F.trim("qualification")
    by = _named(cases).groupBy(*PAIR).agg(F.count("*").alias("raw_count"), *(F.count_if(code == k).alias(f"q_{k}") for k in REPORTER_WEIGHTS))
    known = sum((F.col(f"q_{k}") for k in REPORTER_WEIGHTS), F.lit(0))
    by = by.withColumn("known", known).filter((F.col("raw_count") >= config.min_cases) & (F.col("known") > 0))
    weighted = sum((F.col(f"q_{k}") * w for k, w in REPORTER_WEIGHTS.items()), F.lit(0.0))
    parts = [F.when(F.col(f"q_{k}") > 0, -(F.col(f"q_{k}") / F.col("known")) * F.log(F.col(f"q_{k}") / F.col("known"))).otherwise(0.0) for k in REPORTER_WEIGHTS]
    by = by.withColumns({"weighted_count": weighted, "entropy": sum(parts, F.lit(0.0))})
    norm = F.col("entropy") / math.log(len(REPORTER_WEIGHTS))
    out = by.select(*PAIR, "raw_count", "known", *(f"q_{k}" for k in REPORTER_WEIGHTS), "weighted_count", (F.col("weighted_count") / F.col("known")).alias("mean_weight"), "entropy", norm.alias("norm_entropy"), (norm >= config.diversity).alias("is_multi_source"), (norm * config.bonus).alias("confidence_bonus"))
    return out.orderBy(F.desc("weighted_count"), *PAIR)


def geographic_divergence(cases: DataFrame, config: GeographicConfig = GeographicConfig()) -> DataFrame:
    """Unequal reporting rates between countries. cases: drug, event, country."""
    rows = _named(cases).withColumn("country", F.upper("country"))
    cells = rows.groupBy(*PAIR, "country").agg(F.count("*").alias("n"))
    by_country = cells.groupBy("country").agg(F.sum("n").alias("country_total"))
    totals = cells.groupBy(*PAIR).agg(F.sum("n").alias("total")).filter(F.col("total") >= config.min_cases)
    whole = cells.agg(F.sum("n").alias("whole"))
    kept = cells.filter(F.col("n") >= config.min_country_cases).join(by_country, "country").join(totals, list(PAIR)).crossJoin(F.broadcast(whole))
    rate = F.col("n") / F.greatest("country_total", F.lit(1))
    expected = F.col("country_total") * (F.col("total") / F.col("whole"))
    kept = kept.withColumns({"rate": rate, "term": F.when(expected > 0, (F.col("n") - expected) * (F.col("n") - expected) / expected).otherwise(0.0)})
    by = kept.groupBy(*PAIR, "total", "whole").agg(F.count("*").alias("countries"), F.max(F.struct("rate", "country")).alias("high"), F.min(F.struct("rate", "country")).alias("low"), F.sum("term").alias("chi_squared")).filter("countries >= 2")
    by = by.withColumns({"ratio": ratio(F.col("high.rate"), F.col("low.rate")), "p_value": chi_squared_tail(F.col("chi_squared"), F.greatest(F.col("countries") - 1, F.lit(1)))})
    uneven = F.col("p_value") < config.alpha
    out = by.select(*PAIR, "total", "countries", "ratio", F.col("high.country").alias("highest_country"), F.col("low.country").alias("lowest_country"), (F.col("total") / F.col("whole")).alias("overall_rate"), "chi_squared", "p_value", uneven.alias("is_heterogeneous"), (uneven & (F.col("ratio") >= config.ratio)).alias("is_divergent"))
    return out.orderBy(F.desc("ratio"), *PAIR)
