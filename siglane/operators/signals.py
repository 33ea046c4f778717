"""Disproportionality of 2x2 tables: PRR, ROR, IC, EBGM.

Where a cell is 0, half a case is added to all four, so no ratio is infinite or undefined.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglane.functions.prior import fit
from siglane.functions.stats import empirical_bayes
from siglane.operators import contingency as tables
from siglane.schema import SIGNAL_COLUMNS, SignalConfig


def frequentist(cells: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """cells with PRR, ROR and IC, their bounds and flags."""
    cells = cells.withColumn("n", F.col("a").cast("long"))
    half = F.when(F.least("a", "b", "c", "d") == 0, 0.5).otherwise(0.0)
    cells = cells.withColumns({"_" + x: F.col(x) + half for x in "abcd"})
    a, b, c, d = (F.col("_" + x) for x in "abcd")
    cells = cells.withColumns({"prr": (a / (a + b)) / (c / (c + d)), "prr_se": F.sqrt(F.greatest(1 / a - 1 / (a + b) + 1 / c - 1 / (c + d), F.lit(0.0))), "ror": (a * d) / (b * c), "ror_se": F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)})
    x, y, v, w = (F.col(k).cast("double") for k in "abcd")
    whole = x + y + v + w
    lines = (x + y) * (v + w) * (x + v) * (y + w)
    gap = F.greatest(F.abs(x * w - y * v) - whole / 2, F.lit(0.0))
    chi = F.when(lines > 0, whole * gap * gap / lines).otherwise(0.0)
    expected = F.when(whole > 0, (x + y) * (x + v) / whole).otherwise(0.0)
    cells = cells.withColumns({"chi_squared": chi, "expected": expected})
    few = F.col("n") + 0.5
    ic = F.log2(few / (F.col("expected") + 0.5))
    z = config.z
    cells = cells.withColumns({
        "prr_lower_ci": F.exp(F.log("prr") - z * F.col("prr_se")),
        "prr_upper_ci": F.exp(F.log("prr") + z * F.col("prr_se")),
        "ror_lower_ci": F.exp(F.log("ror") - z * F.col("ror_se")),
        "ror_upper_ci": F.exp(F.log("ror") + z * F.col("ror_se")),
        "ic": ic,
        "ic025": ic - 3.3 * F.pow(few, F.lit(-0.5)) - 2.0 * F.pow(few, F.lit(-1.5)),
    })
    enough = F.col("n") >= config.min_cases
    return cells.withColumns({
        "prr_signal": (F.col("prr") >= config.prr) & (F.col("chi_squared") >= config.chi_squared) & enough,
        "ror_signal": (F.col("ror_lower_ci") > 1.0) & enough,
        "ic_signal": F.col("ic025") > 0.0,
    }).drop("_a", "_b", "_c", "_d", "prr_se", "ror_se")


def detect(cells: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """The 16 result columns of each pair."""
    out = frequentist(cells, config).withColumn("eb", empirical_bayes(F.col("n"), F.col("expected"), config.prior))
    out = out.withColumns({"ebgm": F.col("eb.ebgm"), "eb05": F.col("eb.eb05")}).withColumn("ebgm_signal", F.col("eb05") >= config.eb05)
    return out.select(*SIGNAL_COLUMNS)


#: Counts up to this are squashed as they are, those above and expected counts by so many steps of their logarithm.
EXACT, STEPS = 64, 16


def squashed(cells: DataFrame) -> DataFrame:
    """n, e, pairs of each bin of pairs with like n and expected count: their means, and their number.

    There are some EXACT bins of n and STEPS for each e-fold above, and STEPS for each e-fold of the expected counts,
    which lie within that of their product: thousands of bins, however many pairs.
    """
    rows = frequentist(cells).select("n", F.greatest("expected", F.lit(1e-12)).alias("e"))
    by_n = F.when(F.col("n") <= EXACT, F.col("n")).otherwise(EXACT + F.floor(F.log("n") * STEPS))
    return rows.groupBy(by_n.alias("n_bin"), F.floor(F.log("e") * STEPS).alias("e_bin")).agg(F.avg("n").alias("n"), F.avg("e").alias("e"), F.count("*").alias("pairs"))


def fitted_prior(cells: DataFrame, config: SignalConfig = SignalConfig(), least: int = 0) -> tuple[float, float, float, float, float]:
    """The two-gamma prior that makes the pairs of ``cells`` likeliest, fitted to their bins from the configured one.

    ``least`` is the count from which pairs are in the table at all. Without pairs the configured prior stays.
    """
    table = squashed(cells).orderBy("n_bin", "e_bin").toPandas()
    n, e, pairs = (table[k].to_numpy(dtype=float) for k in ("n", "e", "pairs"))
    return fit(n, np.maximum(e, 1e-12), pairs, config.prior, least)


def from_counts(counts: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    return detect(tables.contingency(counts), config)


ANY_SIGNAL = "prr_signal or ror_signal or ic_signal or ebgm_signal"


def any_signal(signals: DataFrame) -> DataFrame:
    return signals.filter(ANY_SIGNAL)


def signal_summary(signals: DataFrame) -> DataFrame:
    """One row: pairs, and how many each metric flags."""
    return signals.agg(F.count("*").alias("pairs"), *(F.count_if(f"{m}_signal").alias(f"{m}_signals") for m in ("prr", "ror", "ic", "ebgm")), F.count_if(F.expr(ANY_SIGNAL)).alias("any_signals"))
