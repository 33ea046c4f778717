"""The posterior at any count, the fitted prior, and plans that have to stay small."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siglane import catalog
from siglane.functions import stats
from siglane.functions.prior import fit, log_likelihood
from siglane.operators import contingency, dedup, ndc, signals
from siglane.schema import SignalConfig
from tests.conftest import SF

LONG = np.longdouble


def _log_gamma(x):
    x, shift = LONG(x), LONG(0)
    while x < 40:
        shift, x = shift + np.log(x), x + 1
    numbers = [LONG(1) / 6, -LONG(1) / 30, LONG(1) / 42, -LONG(1) / 30, LONG(5) / 66, -LONG(691) / 2730, LONG(7) / 6]
    return (x - LONG(1) / 2) * np.log(x) - x + np.log(LONG("6.283185307179586476925286766559")) / 2 + sum(b / (2 * k * (2 * k - 1)) / x ** (2 * k - 1) for k, b in enumerate(numbers, 1)) - shift


def _below(a, x):
    """The incomplete gamma function by its series, as many terms as it takes, in long doubles."""
    a, x = LONG(a), LONG(x)
    terms = int(200 + 14 * math.sqrt(float(a)) + (3 * float(a) if a < 300 else 0))
    return np.cumprod(np.concatenate([[1 / a], x / (a + np.arange(1, terms, dtype=LONG))])).sum() * np.exp(-x + a * np.log(x) - _log_gamma(a))


@pytest.mark.parametrize("ratio", [0.3, 1.0, 50.0])
@pytest.mark.parametrize("n", [1, 3, 100, 149, 150, 1000, 10**6, 10**7, 10**8])
def test_eb05_of_any_count(n, ratio):
    prior, e = SignalConfig().prior, n / ratio
    got = stats.posterior(np.array([float(n)]), np.array([e]), prior)[1][0]
    a1, b1, a2, b2, share = map(LONG, prior)
    weight = lambda a, b: _log_gamma(a + n) - _log_gamma(a) + a * np.log(b / (b + LONG(e))) + n * np.log(LONG(e) / (b + LONG(e)))
    q = 1 / (1 + np.exp(np.log((1 - share) / share) + weight(a2, b2) - weight(a1, b1)))
    under = lambda x: q * _below(a1 + n, x * (b1 + LONG(e))) + (1 - q) * _below(a2 + n, x * (b2 + LONG(e)))
    assert under(LONG(got) * (1 - LONG(1e-8))) < 0.05 < under(LONG(got) * (1 + LONG(1e-8)))


@pytest.mark.parametrize("least", [0, 3])
def test_prior_fit_is_the_likeliest(least):
    gen = np.random.default_rng(least)
    e = np.round(np.exp(gen.normal(1.5, 1, 4000)) * 4) / 4 + 0.25
    rate = np.where(gen.random(4000) < 0.4, gen.gamma(0.7, 2.0, 4000), gen.gamma(5, 0.25, 4000))
    n = gen.poisson(rate * e).astype(float)
    n, e = n[n >= least], e[n >= least]
    cells, weight = np.unique(np.stack([n, e], 1), axis=0, return_counts=True)
    value = lambda p: log_likelihood(cells[:, 0], cells[:, 1], weight.astype(float), p, least)
    found = fit(cells[:, 0], cells[:, 1], weight.astype(float), SignalConfig().prior, least)
    # Brute force: the best of ever smaller steps in each direction.
    free = lambda p: np.array([*map(math.log, p[:4]), math.log(p[4] / (1 - p[4]))])
    bound = lambda x: (*map(math.exp, x[:4]), 1 / (1 + math.exp(-x[4])))
    x, step = free(found), 0.1
    best = value(bound(x))
    while step > 1e-5:
        tries = [x + step * d for d in np.concatenate([np.eye(5), -np.eye(5)])]
        top = max(tries, key=lambda y: value(bound(y)))
        if value(bound(top)) > best:
            x, best = top, value(bound(top))
        else:
            step /= 2
    assert best - value(found) < 1e-6 and value(found) >= value(SignalConfig().prior)


def test_fitted_prior_of_pairs(spark):
    cells = contingency.contingency(catalog._kept(spark, SF))
    table = signals.squashed(cells).toPandas()
    assert table["pairs"].sum() == cells.count() and abs((table["n"] * table["pairs"]).sum() - cells.agg(F.sum("a")).first()[0]) < 1e-6
    prior = signals.fitted_prior(cells, least=3)
    value = lambda p: log_likelihood(*(table[k].to_numpy(dtype=float) for k in ("n", "e", "pairs")), p, 3)
    assert value(prior) >= value(SignalConfig().prior) and all(x > 0 for x in prior)
    out = catalog.ebgm_fitted(spark, SF).toPandas()
    assert len(out) == cells.count() and (out["eb05"] <= out["ebgm"] * 1.01).all() and np.isfinite(out["ebgm"]).all()
    assert signals.fitted_prior(cells.limit(0)) == SignalConfig().prior


def _shuffles(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"(?<![A-Za-z])Exchange ", plan)) - plan.count("ReusedExchange")


def test_totals_take_one_shuffle(spark):
    """Cases, events and pairs take one each, and all totals one more."""
    assert _shuffles(catalog.contingency_cells(spark, SF)) <= 4


def test_drug_codes_take_four_shuffles(spark):
    assert _shuffles(catalog.ndc_exact(spark, SF)) <= 4
    rows = spark.createDataFrame([("1-1", "a", "b", ["I", "i"], 1, "x"), ("1-1", "c", "b", None, 2, "y"), ("2-1", "C", None, ["c"], None, "z")], "product_ndc string, brand_name string, generic_name string, active_ingredients array<string>, ord int, `__n` string")
    d = ndc.directory(rows, "ord")
    assert sorted((r.product_ndc, r.brand_name, r["__n"]) for r in d.collect()) == [("1-1", "c", "y"), ("2-1", "C", "z")]
    found = ndc.lookup(spark.createDataFrame([("c",), ("11",), ("I",), ("zz",)], "query string"), d).collect()
    assert [tuple(r) for r in found] == [("11", "1-1", "ExactNdc", 1.0), ("c", "1-1", "ExactBrand", 1.0), ("c", "2-1", "ExactBrand", 1.0)]


def test_one_number_on_half_of_all_reports(spark):
    """Its reports make rows in proportion, and no task sorts them."""
    n = 4000
    rows = spark.range(n).select(F.col("id").cast("string").alias("safety_report_id"), (F.col("id") % 3).cast("int").alias("case_version"), F.lit("20240101").alias("receipt_date"), (F.col("id") % 90).cast("int").alias("patient_age"), F.lit("1").alias("patient_sex"), F.lit(70.0).alias("patient_weight"), F.lit("US").alias("occur_country"), F.concat(F.lit("D"), F.col("id") % 50).alias("primary_drug"), F.lit("R").alias("primary_reaction"), F.concat(F.lit("2024"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("event_date"), F.lit(1).alias("report_type"), F.lit(True).alias("serious"), F.when(F.col("id") % 2 == 0, "same").alias("mfr_num"), F.col("id").alias("ord"))
    out = dedup.deduplicate(rows, "ord")
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    top = out.filter("cluster = 'm|SAME' and is_primary").collect()
    assert [(r.cluster_size, r.case_version, r.ord) for r in top] == [(n // 2, 2, 2)]
    groups, members = dedup.neighbour_classes(rows, "ord")
    assert members.count() == n and groups.count() <= 3 * n and members.filter("number = 0").count() == n // 2


def test_fingerprints_as_an_embedding(spark):
    assert (dedup.REPORT_DIMENSION, dedup.FINGERPRINT_DIMENSION, dedup.CODIMENSION) == (13, 7, 6)
    rows = spark.createDataFrame([(k, 40 + k, "1", "US", "20240105", "asp", "ha", None) for k in (0, 1, 30)], "ord int, patient_age int, patient_sex string, occur_country string, event_date string, primary_drug string, primary_reaction string, mfr_num string")
    fp = dedup.embed(rows).select("ord", *dedup.WEIGHTS, "fp_mfr")
    x, y = (fp.select([F.col(c).alias(p + c) for c in fp.columns]) for p in ("x_", "y_"))
    near = x.join(y, F.col("x_ord") < F.col("y_ord")).select("x_ord", "y_ord", *(dedup.is_potential_duplicate("x_", "y_", r).alias(f"r{k}") for k, r in enumerate((dedup.STRICT_RADIUS, dedup.RADIUS))), dedup.in_image().alias("there"))
    assert {tuple(r) for r in near.collect()} == {(0, 1, True, True, True), (0, 30, False, True, True), (1, 30, False, True, True)}
