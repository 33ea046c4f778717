import json
import math
import random
from datetime import datetime, timedelta, timezone
from email.utils import format_datetime

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siglane import catalog, sinks
from siglane.functions.stats import posterior
from siglane.operators import analytics, contingency, dedup, ndc, signals
from siglane.schema import SIGNAL_COLUMNS, OutcomeConfig, SignalConfig
from siglane.plans import pipeline
from siglane.sources import faers, openfda, store
from siglane.streaming import quarters
from tests.conftest import SF

COUNTS = [("A", "X", 50), ("A", "Y", 5), ("B", "X", 10), ("B", "Y", 100), ("C", "X", 20), ("C", "Y", 500)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple("None" if v is None or v != v else str(float(v)) if isinstance(v, (int, float, np.number)) and not isinstance(v, (bool, np.bool_)) else str(v) for v in r) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, duck, name):
    ours, theirs = catalog.QUERIES[name](spark, SF).toPandas(), duck.sql(catalog.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)


def test_cells_and_signals(spark):
    counts = spark.createDataFrame(COUNTS, "drug string, event string, n long")
    out = {(r.drug, r.event): r for r in signals.from_counts(counts).collect()}
    assert len(out) == 6 and tuple(signals.from_counts(counts).columns) == SIGNAL_COLUMNS
    r = out["A", "X"]
    for got, want in ((r.prr, 19.090909), (r.prr_lower_ci, 13.331501), (r.prr_upper_ci, 27.338469), (r.ror_lower_ci, 74.333809), (r.ic, 2.866740), (r.ic025, 2.396792), (r.ebgm, 7.618904), (r.eb05, 6.000197)):
        assert math.isclose(got, want, rel_tol=1e-4)
    assert r.prr_signal and r.ebgm_signal and not out["A", "Y"].prr_signal
    zero = spark.createDataFrame([("DA", "EX", 10), ("DA", "EY", 5), ("DB", "EX", 8)], "drug string, event string, n long")
    cells = {(r.drug, r.event): (r.a, r.b, r.c, r.d) for r in contingency.contingency(zero).collect()}
    assert cells == {("DA", "EX"): (10, 5, 8, 0), ("DA", "EY"): (5, 10, 0, 8), ("DB", "EX"): (8, 0, 10, 5)}
    assert not [v for r in signals.from_counts(zero).collect() for v in r if isinstance(v, float) and (math.isnan(v) or math.isinf(v))]
    assert signals.from_counts(zero.limit(0)).count() == 0


def test_posterior_of_rare_and_frequent_pairs():
    ebgm, eb05 = posterior(np.array([5, 100, 0, 10_000]), np.array([48.576642, 97.153285, 1.0, 10.0]), SignalConfig().prior)
    assert np.allclose(ebgm[:2], [0.115893, 1.007359], atol=1e-4) and np.allclose(eb05[:2], [0.054725, 0.852639], atol=1e-4)
    assert np.isfinite(ebgm).all() and (eb05 <= ebgm * 1.01).all()


def test_outcomes(spark):
    case = lambda *codes: spark.createDataFrame([("asp" if k % 2 else "ASP", "ha", c) for k, c in enumerate(codes)], "drug string, event string, outcome_code string")
    prr = spark.createDataFrame([("ASP", "HA", 2.0)], "drug string, event string, prr double")
    r = analytics.outcome_conditioned(case("5", " 5 ", "1"), prr).first()
    assert (r.total, round(r.osi, 6), round(r.adjusted_prr, 6), r.is_signal) == (3, 3.333333, 3.333333, True)
    r = analytics.outcome_conditioned(case("5", "5", "1", "2"), prr.limit(0)).first()
    assert (r.fatality_rate, r.osi, round(r.adjusted_prr, 6), r.is_signal) == (0.5, 2.75, 1.55, False)
    assert analytics.outcome_conditioned(case("9", "x", None), prr).count() == 0
    assert analytics.outcome_conditioned(case("5"), prr, OutcomeConfig(min_cases=1)).count() == 1


@pytest.mark.parametrize("counts, want", [((1, 2, 4, 8), (4.0, 2.0, 4.0, "202404", True)), ((8, 4, 2, 1), (-1.0, 1.0, -1.0, "202404", True)), ((3, 3), None)])
def test_velocity(spark, counts, want):
    rows = [("d", "e", f"2024{m:02}15") for m, n in enumerate(counts, 1) for _ in range(n)] + [("d", "e", "2024"), ("d", "e", None)]
    known = spark.createDataFrame([], "drug string, event string, prr double")
    r = analytics.signal_velocity(spark.createDataFrame(rows, "drug string, event string, receipt_date string"), known).first()
    assert (r and (r.velocity, r.acceleration, r.peak_velocity, r.peak_month, r.is_early_warning)) == want


def test_cascade(spark):
    names = ("death", "congenital", "life_threatening", "disabling", "hospitalization", "other")
    rows = [("D", "E", f"2024{m}01", *("1" if n == k else None for n in names)) for m, k in (("01", "hospitalization"), ("02", "life_threatening"), ("03", "death"))]
    r = analytics.seriousness_cascade(spark.createDataFrame(rows, "drug string, event string, receipt_date string, " + ", ".join(f"{n} string" for n in names))).first()
    assert (r.total, round(r.mean_cascade, 6), r.velocity, r.is_escalating, r.requires_review, r.max_severity) == (3, 3.666667, 1.5, True, True, "death")


def test_polypharmacy(spark):
    rows = [(["a", "b"], "x")] * 3 + [(["A"], "x"), (["B"], "x"), (["c"], "other")]
    r = analytics.polypharmacy(spark.createDataFrame(rows, "drugs array<string>, event string")).first()
    assert (r.pair_count, r.a_only, r.b_only, r.event_total, round(r.pair_prr, 6), r.interaction, r.is_synergistic) == (3, 1, 1, 5, 1.2, 0.0, False)


def test_reporters(spark):
    r = analytics.reporter_weighted(spark.createDataFrame([("d", "e", q) for q in ("1", "2 ", "5")], "drug string, event string, qualification string")).first()
    assert [round(x, 6) for x in (r.weighted_count, r.mean_weight, r.entropy, r.norm_entropy, r.confidence_bonus)] == [2.5, 0.833333, 1.098612, 0.682606, 0.136521] and r.is_multi_source


def test_geography(spark):
    rows = [("d", "e", "us")] * 10 + [("x", "y", "US")] * 10 + [("D", "E", "jp")] * 2 + [("x", "y", "JP")] * 48
    r = {(r.drug, r.event): r for r in analytics.geographic_divergence(spark.createDataFrame(rows, "drug string, event string, country string")).collect()}["D", "E"]
    assert (r.total, r.ratio, r.highest_country, r.lowest_country, round(r.chi_squared, 6), r.is_divergent) == (12, 12.5, "US", "JP", 17.633333, True)
    assert math.isclose(r.p_value, 5.41027e-05, rel_tol=1e-4)


def test_dedup(spark):
    cols = "safety_report_id string, case_version int, receipt_date string, patient_age int, patient_sex string, patient_weight double, occur_country string, primary_drug string, primary_reaction string, event_date string, report_type int, serious boolean, mfr_num string, ord int"
    report = lambda i, k, age, drug="ASPIRIN", mfr=None, v=1: (i, v, "20240101", age, "1", 70.0, "US", drug, "HEADACHE", "20231215", 1, True, mfr, k)
    blank = ("n", 1, None, None, None, None, None, None, None, None, None, None, None)
    rows = [report("1", 0, 45), report("1b", 1, 46, v=2), report("2", 2, 25, "METFORMIN"), report("3", 3, 45, "X", " mfr-1"), report("4", 4, 25, "Y", "MFR-1"), (*blank, 5), (*blank, 6)]
    out = dedup.deduplicate(spark.createDataFrame(rows, cols), "ord")
    assert {r.safety_report_id for r in out.filter("is_primary").collect()} == {"1b", "2", "3", "n"}
    assert dedup.dedup_summary(out).first()[:] == (7, 5, 2)


@pytest.mark.parametrize("radius", [0.0, dedup.STRICT_RADIUS, dedup.RADIUS, dedup.LENIENT_RADIUS, 1.0])
def test_neighbours_lose_no_pair(spark, radius):
    gen = random.Random(7)
    some = lambda *of: gen.choice([None, *of])
    rows = [(k, some(40, 60), some("1", "2"), some("US", "JP"), some("20240105", "20240210"), some("asp", "ASP", "met"), some("ha", "nausea"), some(None, "", "m1", " M1", "m2")) for k in range(60)]
    rows += [(100, 40, "1", "US", "20240105", "asp", "ha", "x9"), (101, 60, "2", "JP", "20240210", "met", "nausea", "X9 "), (102, 40, "1", "US", None, "asp", "ha", None), (103, 60, "1", "US", None, "asp", "ha", None), (104, *[None] * 7), (105, *[None] * 7)]
    prints = {k: ((None if age is None else age // 5 * 5, sex, country, d and d[:6], drug and drug.upper(), reaction and reaction.upper()), mfr and mfr.strip().upper()) for k, age, sex, country, d, drug, reaction, mfr in rows}

    def distance(x, y):
        if x[1] and x[1] == y[1]:
            return 0.0
        there = [(w, a == b) for w, a, b in zip((1, 1, 1, 2, 3, 2), x[0], y[0], strict=True) if a is not None or b is not None]
        return 1.0 - (sum(w for w, same in there if same) / sum(w for w, _ in there) if there else 0.0)

    want = sorted((a, b, round(d, 6)) for a in prints for b in prints if a < b and (d := distance(prints[a], prints[b])) <= radius)
    df = spark.createDataFrame(rows, "ord int, patient_age int, patient_sex string, occur_country string, event_date string, primary_drug string, primary_reaction string, mfr_num string")
    assert sorted((r.a, r.b, round(r.distance, 6)) for r in dedup.neighbours(df, "ord", radius).collect()) == want
    assert radius == 1.0 or (100, 101, 0.0) in want


def test_ndc(spark):
    products = spark.createDataFrame([("0069-0150-01", "Lipitor", "Atorvastatin Calcium", ["x"], 1), ("0378-0127-01", "Atorvastatin Calcium Tablets", "Atorvastatin Calcium", ["x"], 2)], "product_ndc string, brand_name string, generic_name string, active_ingredients array<string>, ord int")
    d = ndc.directory(products, "ord")
    find = lambda q, **o: sorted((r.match_type, r.product_ndc, round(r.confidence, 6)) for r in ndc.lookup(spark.createDataFrame([(q,)], "query string"), d, **o).collect())
    assert find("Lipitor") == [("ExactBrand", "0069-0150-01", 1.0)]
    assert [x[0] for x in find("ATORVASTATIN CALCIUM")] == ["ExactGeneric"] * 2
    assert find("0069015001") == [("ExactNdc", "0069-0150-01", 1.0)]
    assert find("Liptor", fuzzy=True) == [("Fuzzy", "0069-0150-01", 0.857143)] and find("Liptor") == []


def test_ndc_queries_look_up_all_parts(spark, tmp_path):
    part = [(k, f"{chr(97 + k % 26)}name{k}" + " long" * (25 * (k in (3, 30))), f"TYPE{k}", f"Brand#{k}", k % 50) for k in range(1, 41)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_type string, p_brand string, p_size int").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    for name in ("ndc_exact", "ndc_fuzzy"):
        ours = catalog.QUERIES[name](spark, str(tmp_path)).toPandas()
        assert _rows(ours) == _rows(con.sql(catalog.ORACLES[name]).df())
        if name == "ndc_exact":
            assert {n.upper() for _, n, *_ in part} <= set(ours["query"])
        if name == "ndc_fuzzy":
            assert {n[1:] for _, n, *_ in part} == set(ours["query"])


def test_openfda(spark):
    report = {"safetyreportid": "1", "serious": "1", "receiptdate": "20240105", "patient": {"drug": [{"drugcharacterization": "1", "medicinalproduct": "asp", "openfda": {"brand_name": ["Asp"]}}, {"drugcharacterization": "2", "medicinalproduct": "b"}], "reaction": [{"reactionmeddrapt": "ha"}, {"reactionmeddrapt": "ha"}]}}
    calls = []

    def fetch(url):
        calls.append(url)
        if len(calls) > 1:
            raise openfda.RateLimited(5)
        return json.dumps({"results": [report]})

    now = [0.0]
    client = openfda.OpenFdaClient(spark, fetcher=fetch, clock=lambda: now[0])
    q = openfda.EventQuery(drug="asp", serious_only=True, date_from="20240101", date_to="20241231").with_limit(5000)
    assert "limit=1000" in q.url() and "serious:1" in q.url() and "receiptdate:[20240101+TO+20241231]" in q.url()
    reports = client.drug_events(q)
    assert [r[:] for r in openfda.pair_counts(openfda.filter_reports(reports, q)).collect()] == [("ASP", "HA", 2)]
    client.results(q)
    now[0] = 1000.0
    assert client.results(q) == [report] and len(calls) == 2
    client.clear_cache()
    with pytest.raises(openfda.RateLimited):
        client.results(q)


def test_faers_files_and_sinks(spark, tmp_path):
    files = {"DEMO25Q4": "primaryid$age$sex$wt$event_dt\n1$45$F$70$20240101\nx2$1$M$1$\n", "DRUG25Q4": "primaryid$drug_seq$role_cod$drugname\n1$1$PS$asp\n1$2$C$met\nx2$1$PS$asp\n", "REAC25Q4": "primaryid$pt\n1$ha\n1$nausea\nx2$ha\n", "OUTC25Q4": "primaryid$outc_cod\n1$HO\n1$DE\n", "THER25Q4": "primaryid$dsg_drug_seq$start_dt$end_dt\n1$1$2024$\n"}
    for name, text in files.items():
        (tmp_path / f"{name}.txt").write_text(text)
    rows = faers.ingest(spark, str(tmp_path)).orderBy("event").collect()
    assert [(r.case_id, r.drug, r.event, r.age_years, r.outcomes, r.therapy_summary, r.report_sources) for r in rows] == [(1, "ASP", e, 45.0, "DE|HO", "2024||1", None) for e in ("HA", "NAUSEA")]
    assert faers.ingest(spark, str(tmp_path), all_roles=True).count() == 4
    empty = faers.ingest(spark, str(tmp_path / "none"))
    assert empty.count() == 0 and len(empty.columns) == 18
    assert sinks.write_json(empty, str(tmp_path / "no")) == 0 and not (tmp_path / "no").exists()
    assert sinks.sink_output(spark.range(2), str(tmp_path / "c-%Y")) == 2


def test_store(spark, tmp_path):
    s = store.SignalStore(spark, str(tmp_path / "db"))
    ids = ["1", "2", "3", "4", "5"]
    s.insert_reports(spark.createDataFrame([(i, 1, "20240101", "US") for i in ids], "primary_id string, case_version int, receipt_date string, country string"))
    s.insert_reports(spark.createDataFrame([("1", 2, "20250101", "JP")], "primary_id string, case_version int, receipt_date string, country string"))
    s.insert_drugs(spark.createDataFrame([(i, "aspirin" if i < "5" else "metformin", "PS", 1) for i in ids], "primary_id string, drug string, role string, seq int"))
    s.insert_reactions(spark.createDataFrame([(i, "nausea" if i == "4" else "headache") for i in ids], "primary_id string, event string"))
    s.build_pairs()
    assert s.contingency("aspirin", "headache") == (3, 1, 1, 0) and s.count("ASPIRIN", "x") == 0
    assert s.stats().first()[:3] == (5, 5, 2) and [r.event for r in s.top_events("aspirin", 1).collect()] == ["HEADACHE"]
    assert s.export("signals", str(tmp_path / "x")) == 0 and s.sql("select count(*) c from {drugs}").first()[0] == 5


def test_stream_counts(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "A", "X"), (3, "b", "x")], "case_id long, drug string, event string")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        quarters.write_batches(quarters.read_rows(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert {r.drug: r.n for r in quarters.total_counts(spark, str(tmp_path / "out")).collect()} == {"A": 4, "B": 2}


def test_plan_prunes_and_pushes(spark):
    plan = catalog.pair_counts(spark, SF)._jdf.queryExecution().toString().split("== Physical Plan ==")[-1]
    scans = [x for x in plan.split("FileScan parquet")[1:] if "l_returnflag" in x.split("ReadSchema")[0]]
    assert len(scans) == 1 and "In(l_returnflag, [A,R])" in scans[0].split("ReadSchema")[0].replace("'", "")
    assert "l_extendedprice" not in plan


def test_quarters_with_other_column_orders_and_names(spark, tmp_path):
    texts = {"demo25q3.TXT": "PRIMARYID$AGE$SEX\n1$40$F\n", "DEMO25Q4.txt": "sex$primaryid$age$wt\nM$2$30$70.5\n", "DRUG25Q3.txt": "primaryid$role_cod$drugname\n1$PS$asp\n", "DRUG25Q4.txt": "drugname$primaryid$role_cod\nmet$2$SS\nasp$2$C\n", "REAC25Q3.txt": "primaryid$pt\n1$ha\n", "REAC25Q4.txt": "pt$primaryid\nha$2\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows = sorted((r.case_id, r.drug, r.role_code, r.age_years, r.sex, r.weight_kg) for r in faers.ingest(spark, f"file://{tmp_path}").collect())
    assert rows == [(1, "ASP", "PS", 40.0, "F", None), (2, "MET", "SS", 30.0, "M", 70.5)]


def test_command_line(spark, tmp_path, capsys):
    files = {"DEMO": "primaryid$age\n" + "".join(f"{k}$1\n" for k in range(1, 5)), "DRUG": "primaryid$role_cod$drugname\n" + "".join(f"{k}$PS$asp\n" for k in range(1, 5)), "REAC": "primaryid$pt\n" + "".join(f"{k}$ha\n" for k in range(1, 5))}
    for kind, text in files.items():
        (tmp_path / f"{kind}25Q4.txt").write_text(text)
    out = ["--faers-dir", str(tmp_path), "--counts-out", f"{tmp_path}/c", "--signals-out", f"{tmp_path}/s"]
    assert pipeline.main(["--faers-dir", str(tmp_path / "none")]) == 1
    assert pipeline.main([*out, "--dry-run"]) == 0 and not (tmp_path / "c").exists()
    assert pipeline.main([*out, "--once", "-v"]) == 0 and (tmp_path / "c").exists() and not (tmp_path / "s").exists()
    assert "1 pairs" in capsys.readouterr().err
    assert pipeline.main([*out, "--min-cases", "1"]) == 0
    assert [(r.drug, r.n) for r in spark.read.json(f"{tmp_path}/s").collect()] == [("ASP", 4)]


def test_sinks_keep_what_is_there_for_no_rows(spark, tmp_path):
    assert sinks.write_parquet(spark.range(3), str(tmp_path / "x")) == 3 and sinks.write_parquet(spark.range(0), str(tmp_path / "x")) == 0
    assert spark.read.parquet(str(tmp_path / "x")).count() == 3 and sinks.write_parquet(spark.range(5), str(tmp_path / "x")) == 5
    assert spark.read.parquet(str(tmp_path / "x")).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["x"]


def test_first_of_new_reports_stays(spark, tmp_path):
    s = store.SignalStore(spark, str(tmp_path / "db"))
    rows = spark.createDataFrame([("1", k, f"2024010{k}", "US") for k in range(1, 8)], "primary_id string, case_version int, receipt_date string, country string")
    s.insert_reports(rows)
    s.insert_reports(rows.orderBy(F.desc("case_version")))
    assert [r.case_version for r in s.table("reports").collect()] == [1]


@pytest.mark.parametrize("said, least, most", [("7", 7, 7), (None, 60, 60), ("soon", 60, 60), ("Wed, 21 Oct 2015 07:28:00 GMT", 0, 0), ("in 90 s", 80, 91)])
def test_retry_after(said, least, most):
    if said == "in 90 s":
        said = format_datetime(datetime.now(timezone.utc) + timedelta(seconds=90))
    assert least <= openfda._seconds(said) <= most
