"""What larger tables bring: keys of more digits, many pages, groups that grow."""

import gzip
import json
import os
import re

import duckdb
import pyarrow as pa
import pytest

from siglane import catalog, roundtrips
from siglane.operators import contingency
from siglane.sources import pages, store
from tests.conftest import SF
from tests.test_engine import _rows


@pytest.mark.parametrize("name", ["ndc_by_code", "ndc_directory_file", "ndc_directory_size", "ndc_exact", "ndc_fuzzy"])
def test_codes_of_keys_beyond_six_digits(spark, tmp_path, name):
    part = spark.read.parquet(f"{SF}/part.parquet").limit(40).selectExpr("if(p_partkey < 9, 1234560 + p_partkey, p_partkey * 500009) as p_partkey", "p_name", "p_brand", "p_type", "if(p_partkey < 9, 7, p_size * 61) as p_size")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.sql(f"create view part as select * from read_parquet('{tmp_path}/part.parquet/*.parquet')")
    theirs = con.sql(catalog.ORACLES[name]).df()
    assert len(theirs) and _rows(catalog.QUERIES[name](spark, str(tmp_path)).toPandas()) == _rows(theirs)


def test_files_hold_many_pages(spark, tmp_path):
    folder = roundtrips.write_pages(spark, SF)
    files = pages.page_files(spark, folder)
    lines = [json.loads(line) for f in files for line in open(f.removeprefix("file:"), encoding="utf-8")]
    reports = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    # The same pages, in files whose number doesn't follow theirs.
    assert sum(len(x["results"]) for x in lines) == reports and len(lines) > reports / roundtrips.PAGE / 2 and len(files) <= 4 < len(lines)
    assert pages.read_pages(spark, folder).count() == reports
    some = lambda *ids: {"results": [{"safetyreportid": i, "serious": "1"} for i in ids]}
    texts = {"one.json": json.dumps(some("a", "b"), indent=1), "two.json": json.dumps(some("c")) + "\n\n" + json.dumps(some("d", "\u2028")) + "\n", "none.json": "{}"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    assert sorted(r[0] for r in pages.read_pages(spark, str(tmp_path)).select("safetyreportid").collect()) == ["a", "b", "c", "d", "\u2028"]


@pytest.mark.parametrize("name", ["rest_pages", "rest_pages_filtered"])
def test_pages_are_on_disk_once_and_packed(spark, monkeypatch, name):
    plain = roundtrips.write_pages(spark, SF)
    size = sum(os.path.getsize(f.removeprefix("file:")) for f in pages.page_files(spark, plain))
    written, write = [], roundtrips.write_pages
    monkeypatch.setattr(roundtrips, "write_pages", lambda *a: written.append(write(*a)) or written[-1])
    rows = _rows(catalog.QUERIES[name](spark, SF).toPandas())
    (folder,) = written
    files = pages.page_files(spark, folder)
    assert files and all(f.endswith(".gz") for f in files) and sum(os.path.getsize(f.removeprefix("file:")) for f in files) * 8 < size
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert rows == _rows(con.sql(catalog.ORACLES[name]).df())


def test_files_without_pages(spark, tmp_path):
    for name, text in {"none.json": b"", "blank.txt": b"\n \n", "none.txt.gz": gzip.compress(b""), "later.json": b'\n{"results":[{"safetyreportid":"a"}]}\n'}.items():
        (tmp_path / name).write_bytes(text)
    assert [r.safetyreportid for r in pages.read_pages(spark, str(tmp_path)).collect()] == ["a"]


def test_reports_go_into_pages_as_they_come():
    batch = lambda *ids: pa.RecordBatch.from_arrays([pa.array([f'{{"id":{i}}}' for i in ids], pa.string())], names=["report"])
    found = [x for b in roundtrips.in_pages([batch(*range(150)), batch(), batch(*range(150, 450)), batch(450)]) for x in b.column(0).to_pylist()]
    ids = [[r["id"] for r in json.loads(x)["results"]] for x in found]
    assert [len(x) for x in ids] == [roundtrips.PAGE, roundtrips.PAGE, 51] and sum(ids, []) == list(range(451))
    assert list(roundtrips.in_pages([])) == [] == list(roundtrips.in_pages([batch()]))


@pytest.mark.parametrize("roles", [("PS",), ("PS", "SS")])
def test_cases_are_told_apart_before_the_join(spark, roles):
    drugs = spark.createDataFrame([(1, "A", "PS"), (1, "A", "PS"), (1, "A", "SS"), (2, "A", "PS"), (2, "B", "SS"), (None, "A", "PS"), (3, None, "PS")], "case_id int, drug string, role string")
    events = spark.createDataFrame([(1, "X"), (1, "X"), (1, "Y"), (2, "X"), (None, "X"), (3, "X"), (2, None)], "case_id int, event string")
    some = drugs.filter(drugs.role.isin(*roles))
    got, want = contingency.count_cases(some, events), contingency.count_pairs(some.join(events, "case_id"), distinct_cases=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.schema == want.schema
    # No table that the shuffles make has a drug, an event and a case at once.
    plan = store.pairs(drugs, events, "case_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "distinct case_id" not in plan.lower() and "count(1)" in plan


def test_similar_reports_come_in_rows_that_grow_with_them(spark, tmp_path):
    spark.range(600).selectExpr("id * 3000 as o_orderkey", "id % 7 as o_custkey", "'F' as o_orderstatus", "timestamp'1994-01-05 00:00:00' as o_orderdate", "'1-URGENT' as o_orderpriority").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(7).selectExpr("id as c_custkey", "concat('S', id % 2) as c_mktsegment").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = catalog.QUERIES["similarity_pairs"](spark, str(tmp_path)).collect()
    assert len(rows) < 2 * 600 and sum(r.kind == "report" for r in rows) == 600 and {r.number for r in rows if r.kind == "report"} == {0}
    # Ages 0 to 4 and 5 to 6 of two countries: four classes, of which each is one field apart from two.
    assert sorted((r.a, r.b, r.distance) for r in rows if r.kind == "classes") == [(0, 3000, 0.1), (0, 18000, 0.1), (3000, 15000, 0.1), (15000, 18000, 0.1)]


@pytest.mark.parametrize("name", ["pair_counts_distinct_ps", "pair_counts_distinct_cases", "pair_counts"])
def test_tasks_of_cases_follow_the_lines(spark, monkeypatch, name):
    monkeypatch.setattr(contingency, "TASK_ROWS", 600)
    got = catalog.QUERIES[name](spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    tasks = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 600)
    # Both sides once by case, before anything is summed up, and what meets then isn't shuffled again.
    assert tasks > 4 and len(re.findall(rf"Exchange hashpartitioning\(case_id#\d+L, {tasks}\), REPARTITION_BY_NUM", plan)) == 2
    assert len(re.findall(r"Exchange hashpartitioning\(case_id", plan)) == 2
    con = duckdb.connect()
    for t in ("lineitem", "part", "orders", "customer", "nation"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert _rows(got.toPandas()) == _rows(con.sql(catalog.ORACLES[name]).df())


def test_tasks_of_a_store_follow_its_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(contingency, "TASK_ROWS", 50)
    s = store.SignalStore(spark, str(tmp_path / "store"))
    rows = spark.range(900).selectExpr("cast(id % 300 as string) as primary_id", "cast(id as int) as case_version", "'20240101' as receipt_date", "'US' as country", "-id as place")
    s.insert_reports(rows, "place")
    # A file of each task, of which there are 18; of three rows of an id the one with the least place stays.
    assert len(s.table("reports").inputFiles()) == 18
    assert sorted((int(r.primary_id), r.case_version) for r in s.table("reports").collect()) == [(i, i + 600) for i in range(300)]
    s.insert_reports(rows)
    assert s.table("reports").count() == 300
    one = spark.range(400).selectExpr("cast(id as string) as primary_id", "'a' as drug", "'PS' as role", "1 as seq", "'x' as event")
    s.insert_drugs(one)
    s.insert_reactions(one)
    asked = []
    monkeypatch.setattr(store, "count_cases", lambda *a: asked.append(a[3]) or contingency.count_cases(*a))
    s.build_pairs()
    assert asked == [400] and [tuple(r) for r in s.table("drug_event_pairs").collect()] == [("A", "X", 400)]
