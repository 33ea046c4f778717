"""Reports that are linked as their files arrive."""

import gzip

from siglane.sources import faers
from siglane.streaming import linking

FILES = [
    {"REAC25Q3.txt": "primaryid$pt\n1$ha\n2$nausea\nx3$ha\n", "THER25Q3.txt": "dsg_drug_seq$primaryid$end_dt$start_dt\n2$1$$2024\n1$1$2025$2024\n$2$$\n"},
    {"DRUG25Q3.txt": "primaryid$role_cod$drugname\n1$PS$asp\n1$C$met\n2$SS$\nx3$PS$asp\n", "OUTC25Q3.txt": "primaryid$outc_cod\n1$HO\n1$DE\n"},
    {"DEMO25Q3.txt": "PRIMARYID$AGE$sex$wt\n1$45$F$x\n2$ 30 $$70.5\nx3$1$M$1\n"},
    {"DRUG25Q4.txt": "drugname$primaryid$role_cod\nmet$2$PS\nibu$1$SS\n", "RPSR25Q4.txt": "primaryid$rpsr_cod\n1$CR\n"},
    {"REAC25Q4.txt": "pt$primaryid\nRash$1\n"},
]


def test_any_arrival_ends_at_the_ingested_rows(spark, tmp_path):
    arrived, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()
    mark_of = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    for run, files in enumerate(FILES):
        for name, text in files.items():
            (tmp_path / "in" / name).write_text(text)
        linking.link_arrived(spark, arrived, out, mark, run, buckets=2).awaitTermination()
        if run == 2:
            assert {(r.case_id, r.drug, r.event) for r in linking.current(spark, out).collect()} == {(1, "ASP", "HA")}
    whole = faers.ingest(spark, arrived)
    assert mark_of(linking.current(spark, out)) == mark_of(whole) and whole.count() == 5
    # What an earlier run has said of report 1 is still there, and no longer holds.
    rows = spark.read.schema(linking.LINKED).parquet(out)
    assert {r.generation for r in rows.filter("primaryid = '1'").collect()} == {2, 3, 4}
    assert [r.therapy_summary for r in whole.filter("case_id = 1").limit(1).collect()] == ["2024|2025|1||2024||2"]


def test_a_batch_reads_files_by_kind_and_header(spark, tmp_path):
    (tmp_path / "REAC25Q3.txt").mkdir()
    texts = {"DRUG25Q3.txt": "primaryid$role_cod$drugname$role_cod\n1$PS$asp$C\n2$C$met\n\n3$SS\n$PS$ibu\n", "DRUG25Q4.txt": "\nDRUGNAME$ primaryid \nmet$4\n", "REAC25Q3.txt/part-0": "primaryid$pt\n1$ha\n", "REAC25Q3.txt/part-1": "primaryid$pt\n2$rash$more\n", "RPSR25Q4.txt": "", "OTHER.txt": "primaryid\n1\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    with gzip.open(tmp_path / "REAC25Q3.txt" / "part-2.gz", "wt") as f:
        f.write("pt$primaryid\nflu$3\n")
    found = linking.fragments(spark, [f"file:{tmp_path}/{n}" for n in [*texts, "REAC25Q3.txt/part-2.gz"]], all_roles=True)
    rows = {k: sorted(map(tuple, df.collect()), key=str) for k, df in found.items()}
    assert rows == {"DRUG": [("1", "PS", "asp"), ("2", "C", "met"), ("3", "SS", None), ("4", None, "met")], "REAC": [("1", "ha"), ("2", "rash"), ("3", "flu")]}
    # Two files of one header are one reading.
    assert found["REAC"]._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert [r.primaryid for r in linking.fragments(spark, [f"file:{tmp_path}/DRUG25Q3.txt"])["DRUG"].collect()] == ["1", "3"]


def test_reports_are_kept_as_rows_that_grow_with_them(spark, tmp_path):
    arrived, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    (tmp_path / "in").mkdir()
    for run, reports in enumerate((range(3), range(2, 4))):
        lines = [(r, k) for r in reports for k in range(20)]
        (tmp_path / "in" / f"DEMO{run}.txt").write_text("primaryid\n" + "".join(f"{r}\n" for r in reports if not (run and r == 2)))
        (tmp_path / "in" / f"DRUG{run}.txt").write_text("primaryid$role_cod$drugname\n" + "".join(f"{r}$PS$d{run}{k}\n" for r, k in lines))
        (tmp_path / "in" / f"REAC{run}.txt").write_text("primaryid$pt\n" + "".join(f"{r}$e{run}{k}\n" for r, k in lines))
        linking.link_arrived(spark, arrived, out, mark, run, buckets=2).awaitTermination()
    # 3 and then 2 reports, not a row for each of their drugs and reactions; report 2 holds as the second run says.
    assert spark.read.schema(linking.LINKED).parquet(out).count() == 3 + 2
    assert {r.case_id: r["count"] for r in linking.current(spark, out).groupBy("case_id").count().collect()} == {0: 400, 1: 400, 2: 1600, 3: 400}
