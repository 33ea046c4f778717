"""Faulty lines, commits of the store and what its lookups read."""

import re

import pytest

from siglane.sources import faers, store
from siglane.plans import pipeline

REPORTS = "primary_id string, case_version int, receipt_date string, country string"


def test_faults_of_lines(spark, tmp_path):
    texts = {
        "DEMO25Q3.txt": "primaryid$age\n1$40\nx2$30\n$20\n3\n4$50$more\n", "DEMO25Q4.txt": "age$primaryid\n60$5\n", "DRUG25Q4.txt": "primaryid$role_cod$drugname\n1$PS$asp\n1$PS$\n5$PS\n4$PS$met\n3$SS$met\n", "REAC25Q4.txt": "primaryid$pt\n1$ha\n3$\n4$ha\n5$ha\nx2$ha\n3$ha\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows, faults = faers.ingest_with_errors(spark, str(tmp_path))
    assert sorted((r.case_id, r.drug, r.event, r.age_years) for r in rows.collect()) == [(1, "ASP", "HA", 40.0), (3, "MET", "HA", None), (4, "MET", "HA", 50.0)]
    got = sorted((r.file, r.reason, r.primaryid or "", r.line or "") for r in faults.collect())
    assert got == [
        ("DEMO25Q3.txt", "fields", "3", "3"), ("DEMO25Q3.txt", "fields", "4", "4$50$more"), ("DEMO25Q3.txt", "id", "", ""), ("DEMO25Q3.txt", "id", "x2", ""),
        ("DRUG25Q4.txt", "fields", "5", "5$PS"), ("DRUG25Q4.txt", "name", "1", ""), ("DRUG25Q4.txt", "name", "5", "5$PS"), ("REAC25Q4.txt", "name", "3", ""),
    ]
    assert all(r.path.endswith(r.file) for r in faults.collect())
    assert faers.errors(spark, str(tmp_path / "none")).count() == 0


def _ids(s):
    return sorted(r.primary_id for r in s.table("reports").collect())


def test_commits_are_whole_or_not_at_all(spark, tmp_path):
    s, reader = store.SignalStore(spark, str(tmp_path / "db")), store.SignalStore(spark, str(tmp_path / "db"))
    row = lambda i: spark.createDataFrame([(i, 1, "20240101", "US")], REPORTS)
    drug = spark.createDataFrame([("1", "asp", "PS", 1)], store.SCHEMAS["drugs"])
    s.insert_reports(row("1"))
    before = reader.table("reports")
    with pytest.raises(ZeroDivisionError):
        with s.transaction():
            s.insert_reports(row("2"))
            s.insert_drugs(drug)
            assert _ids(s) == ["1", "2"] and _ids(reader) == ["1"]
            raise ZeroDivisionError
    assert _ids(s) == ["1"] and s.table("drugs").count() == 0 and len(list((tmp_path / "db" / "data").iterdir())) == 1
    s.begin()
    s.insert_reports(row("3"))
    s.insert_drugs(drug)
    assert _ids(reader) == ["1"]
    s.commit()
    assert _ids(reader) == ["1", "3"] and reader.table("drugs").count() == 1 and before.count() == 1
    with pytest.raises(RuntimeError):
        s.commit()


def test_the_slower_of_two_writers_fails(spark, tmp_path):
    one, two = store.SignalStore(spark, str(tmp_path / "db")), store.SignalStore(spark, str(tmp_path / "db"))
    row = lambda i: spark.createDataFrame([(i, 1, "20240101", "US")], REPORTS)
    one.begin()
    one.insert_reports(row("1"))
    two.insert_reports(row("2"))
    with pytest.raises(RuntimeError):
        one.commit()
    assert _ids(one) == ["2"]
    one.insert_reports(row("1"))
    assert _ids(two) == ["1", "2"] and [p.name for p in sorted((tmp_path / "db" / "commits").iterdir()) if p.suffix == ".json"] == ["000000000001.json", "000000000002.json"]


def test_lookups_read_few_rows(spark, tmp_path):
    s = store.SignalStore(spark, str(tmp_path / "db"))
    names = spark.range(40_000).selectExpr("cast(id as string) primary_id", "concat('D', lpad(id % 2000, 5, '0')) name", "concat('E', id) event")
    s.insert_drugs(names.selectExpr("primary_id", "name drug", "'PS' role", "1 seq"))
    s.insert_reactions(names.select("primary_id", "event"))
    s.build_pairs()
    one = s.table("drug_event_pairs").filter("drug = 'D00007' and event = 'E7'")
    assert [r.n for r in one.collect()] == [1]
    scans, nodes = [], [one._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kids = node.children()
        nodes += [kids.apply(k) for k in range(kids.size())]
        if "AdaptiveSparkPlan" in node.nodeName():
            nodes.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            scans.append(node.metrics().apply("numOutputRows").value())
    assert len(scans) == 1 and 0 < scans[0] < 20_000
    asked = spark.createDataFrame([("d00007", "e7"), ("D00007", "none")], "drug string, event string")
    assert sorted(tuple(r) for r in s.counts(asked).collect()) == [("D00007", "E7", 1), ("D00007", "NONE", 0)]
    assert sorted(tuple(r) for r in s.contingencies(asked).collect()) == [("D00007", "E7", 1, 19, 0, 39980), ("D00007", "NONE", 0, 20, 0, 39980)]


def test_default_folder_and_summary(spark, tmp_path, monkeypatch, capsys):
    ids = range(1, 5)
    files = {"DEMO": "primaryid$age\n" + "".join(f"{k}$1\n" for k in ids), "DRUG": "primaryid$role_cod$drugname\n" + "".join(f"{k}$PS$asp\n" for k in ids), "REAC": "primaryid$pt\n" + "".join(f"{k}$ha\n" for k in ids)}
    for kind, text in files.items():
        (tmp_path / f"{kind}25Q4.txt").write_text(text)
    monkeypatch.setenv(faers.DATA_DIR, str(tmp_path))
    assert faers.ingest(spark).count() == 4
    assert pipeline.main(["--counts-out", f"{tmp_path}/c", "--signals-out", f"{tmp_path}/s"]) == 0
    said = capsys.readouterr().out
    assert re.search(r"\|\s*pairs\s*\|", said) and re.search(r"ebgm_signals", said) and "ASP" in said and "HA" in said
    monkeypatch.delenv(faers.DATA_DIR)
    assert str(faers.data_dir()) == "data/faers"
