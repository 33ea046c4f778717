"""Registered queries that go through files, streams and the store: written from the tables to the shared folder, and read back."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siglane import sinks, views
from siglane.catalog import _EB, _counts, _frequentist, _kept, _r, query, rounded
from siglane.functions.text import coded
from siglane.operators import contingency, dedup, ndc
from siglane.plans import pipeline
from siglane.schema import CHARACTERIZATIONS, DRUG_ROLES, INGEST_COLUMNS, SIGNAL_COLUMNS, DedupConfig
from siglane.session import file_system, prepare, shared_dir
from siglane.sources import faers, openfda, pages, store
from siglane.sources.ndc import read_directory
from siglane.streaming import linking, quarters


#: Folders that queries have made, for release().
_made: list[str] = []


def _place(spark, name: str) -> str:
    _made.append(f"{shared_dir(prepare(spark))}/siglane/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def release(spark) -> None:
    """Deletes what the queries of this process have written; their results can't be read afterwards."""
    while _made:
        files, where = file_system(spark, _made.pop())
        # A template's fields are filled in its path.
        for status in files.globStatus(file_system(spark, str(where).replace("%Y", "*"))[1]) or []:
            files.delete(status.getPath(), True)


def write_quarters(spark, d) -> str:
    """A folder with the files of two quarters, orders by the parity of their keys; the second has other column orders."""
    folder, text = _place(spark, "quarters"), "string"
    o = views.table(spark, d, "orders").join(views.table(spark, d, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    date = F.date_format("o_orderdate", "yyyyMMdd")
    demo = o.select(key.alias("primaryid"), (F.col("o_custkey") % 90).alias("age"), F.lit("A").alias("age_grp"), F.col("o_orderstatus").alias("sex"), F.round(F.col("o_custkey") % 50 + 40.5, 1).alias("wt"), F.col("c_mktsegment").alias("reporter_country"), F.col("c_mktsegment").alias("occr_country"), F.lit("sender").alias("mfr_sndr"), F.substring("o_orderpriority", 1, 1).alias("occp_cod"), F.when(key % 3 == 0, F.concat(F.lit("mfr-"), key.cast(text))).alias("mfr_num"), date.alias("fda_dt"), date.alias("event_dt"))
    lines = views.table(spark, d, "lineitem").join(views.table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    # Joined once: ten of the twelve files are written from these lines.
    joined = _place(spark, "lines")
    lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate", "p_brand", "p_type", "p_name").write.parquet(joined)
    lines = spark.read.parquet(joined)
    case = F.col("l_orderkey").alias("primaryid")
    role = coded(F.col("l_returnflag"), views.ROLES, "C")
    files = {
        "DEMO": demo,
        "DRUG": lines.select(case, F.col("l_linenumber").alias("drug_seq"), role.alias("role_cod"), F.lower(F.concat_ws(" ", "p_brand", "p_type")).alias("drugname")),
        "REAC": lines.select(case, F.col("p_name").alias("pt")).distinct(),
        "OUTC": lines.filter("l_linenumber > 1").select(case, F.concat(F.lit("O"), F.col("l_linenumber").cast(text)).alias("outc_cod")),
        "RPSR": lines.filter("l_linenumber = 2").select(case, F.col("l_linestatus").alias("rpsr_cod")),
        "THER": lines.select(case, F.col("l_linenumber").alias("dsg_drug_seq"), F.date_format("l_shipdate", "yyyyMMdd").alias("start_dt"), F.when(F.col("l_returnflag") != "N", F.date_format("l_shipdate", "yyyyMM")).alias("end_dt")),
    }
    for kind, rows in files.items():
        for odd, quarter in ((0, "25Q3"), (1, "25Q4")):
            own = rows.filter(F.col("primaryid") % 2 == odd)
            names = own.columns[::-1] if odd else own.columns
            own.select(*(F.col(n).alias(n.upper() if odd else n) for n in names)).write.csv(f"{folder}/{kind}{quarter}.txt", sep="$", header=True, quote="", emptyValue="")
    return folder


_INGEST = """, demo AS (SELECT o_orderkey AS case_id, CAST(o_custkey % 90 AS DOUBLE) AS age_years, 'A' AS age_group, o_orderstatus AS sex, CAST(o_custkey % 50 + 40.5 AS DOUBLE) AS weight_kg, c_mktsegment AS reporter_country, c_mktsegment AS occr_country, 'sender' AS mfr_sndr, substr(o_orderpriority, 1, 1) AS occp_cod, CASE WHEN o_orderkey % 3 = 0 THEN 'mfr-' || o_orderkey END AS mfr_num, strftime(o_orderdate, '%Y%m%d') AS fda_dt, strftime(o_orderdate, '%Y%m%d') AS event_dt FROM orders JOIN customer ON o_custkey = c_custkey),
rpsr AS (SELECT l_orderkey AS case_id, string_agg(l_linestatus, '|' ORDER BY l_linestatus) AS report_sources FROM lineitem WHERE l_linenumber = 2 GROUP BY 1),
outc AS (SELECT l_orderkey AS case_id, string_agg('O' || l_linenumber, '|' ORDER BY l_linenumber) AS outcomes FROM lineitem WHERE l_linenumber > 1 GROUP BY 1),
ther AS (SELECT l_orderkey AS case_id, string_agg(s || '|' || e || '|' || l_linenumber, '||' ORDER BY l_linenumber, s, e) AS therapy_summary FROM (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS s, CASE WHEN l_returnflag = 'N' THEN '' ELSE strftime(l_shipdate, '%Y%m') END AS e FROM lineitem) GROUP BY 1)
SELECT r.case_id, r.drug, r.event, age_years, age_group, sex, weight_kg, reporter_country, occr_country, mfr_sndr, occp_cod, mfr_num, fda_dt, event_dt, r.role AS role_code, report_sources, outcomes, therapy_summary
FROM {rows} r JOIN demo ON r.case_id = demo.case_id LEFT JOIN rpsr ON r.case_id = rpsr.case_id LEFT JOIN outc ON r.case_id = outc.case_id LEFT JOIN ther ON r.case_id = ther.case_id"""


@query(_INGEST.format(rows="sus"))
def ingest_quarters(spark, d):
    return faers.ingest(spark, write_quarters(spark, d)).select(*INGEST_COLUMNS)


@query(_INGEST.format(rows="all_rows"))
def ingest_quarters_all_roles(spark, d):
    return faers.ingest(spark, write_quarters(spark, d), all_roles=True)


def write_broken_quarter(spark, d) -> str:
    """A folder of a quarter with faulty lines: ids with a letter, lines that lack a field or have one more, no names."""
    folder = _place(spark, "broken")
    text = lambda *columns: F.concat_ws("$", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    key, line = F.col("o_orderkey"), F.col("l_linenumber")
    demo = views.table(spark, d, "orders").select(text(F.when(key % 7 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string")), F.col("o_custkey") % 90).alias("line"))
    lines = views.table(spark, d, "lineitem").join(views.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    case = F.col("l_orderkey")
    drug = F.when(line == 7, text(case, line, F.lit("PS"))).when(line == 6, text(case, line, F.lit("PS"), F.col("p_brand"), F.lit("more"))).otherwise(text(case, line, F.lit("PS"), F.when(line != 5, F.col("p_brand"))))
    reac = text(case, F.when(line != 4, F.col("p_name")))
    for kind, header, rows in (("DEMO", "primaryid$age", demo), ("DRUG", "primaryid$drug_seq$role_cod$drugname", lines.select(drug.alias("line"))), ("REAC", "primaryid$pt", lines.select(reac.alias("line")))):
        rows.select(F.col("line").alias(header)).write.csv(f"{folder}/{kind}25Q4.txt", sep="\x01", header=True, quote="", escape="")
    return folder


@query("""SELECT kind || '25Q4.txt' AS file, kind, reason, count(*) AS lines, count(line) AS texts FROM (
SELECT 'DEMO' AS kind, 'id' AS reason, NULL AS line FROM orders WHERE o_orderkey % 7 = 0 UNION ALL SELECT 'DRUG', 'fields', 'x' FROM lineitem WHERE l_linenumber IN (6, 7)
UNION ALL SELECT 'DRUG', 'name', CASE WHEN l_linenumber = 7 THEN 'x' END FROM lineitem WHERE l_linenumber IN (5, 7) UNION ALL SELECT 'REAC', 'name', NULL FROM lineitem WHERE l_linenumber = 4) GROUP BY ALL""", with_views=False)
def ingest_errors(spark, d):
    """Faults by file and reason, with how many have their line's text."""
    _, found = faers.ingest_with_errors(spark, write_broken_quarter(spark, d))
    return found.groupBy("file", "kind", "reason").agg(F.count("*").alias("lines"), F.count("line").alias("texts"))


@query("""WITH d AS (SELECT l_orderkey AS k, upper(p_brand) AS drug FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber NOT IN (5, 7)), e AS (SELECT l_orderkey AS k, upper(p_name) AS event FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber <> 4)
SELECT drug, event, count(*) AS n FROM d JOIN e ON d.k = e.k WHERE d.k % 7 <> 0 GROUP BY ALL""", with_views=False)
def ingest_despite_errors(spark, d):
    """The pairs of the same folder: faulty lines are left out, or taken for what they have."""
    return contingency.count_pairs(faers.ingest(spark, write_broken_quarter(spark, d)))


@query("SELECT * FROM kept")
def command_line_counts(spark, d):
    out = _place(spark, "counts")
    if pipeline.main(["--faers-dir", write_quarters(spark, d), "--once", "--output", out]):
        raise RuntimeError("the command line failed")
    return spark.read.schema("drug string, event string, n long").json(out)


@query(f"{_EB} SELECT drug, event, n, prr_signal, ror_signal, ic_signal, {_r('ebgm', 'eb05')}, ebgm_signal FROM found")
def command_line_signals(spark, d):
    folder, out = write_quarters(spark, d), _place(spark, "signals")
    if pipeline.main(["--faers-dir", folder, "--counts-out", _place(spark, "counts-%Y"), "--signals-out", out, "--no-summary"]):
        raise RuntimeError("the command line failed")
    found = spark.read.schema(store.SCHEMAS["signals"]).json(out)
    if tuple(found.columns) != SIGNAL_COLUMNS:
        raise RuntimeError("the file lacks columns")
    return rounded(found.select("drug", "event", "n", "prr_signal", "ror_signal", "ic_signal", "ebgm", "eb05", "ebgm_signal"))


@query(f"{_EB} SELECT drug, event, n, {_r('prr', 'ic025', 'ebgm', 'eb05')}, ebgm_signal FROM found")
def run_pipeline_pairs(spark, d):
    return rounded(pipeline.run_pipeline(views.rows(spark, d)).select("drug", "event", "n", "prr", "ic025", "ebgm", "eb05", "ebgm_signal"))


@query("SELECT drug, event, n, n AS n_normal FROM counts")
def normalize_rows(spark, d):
    rows = views.rows(spark, d)
    one, two = contingency.count_pairs(rows), contingency.count_pairs(contingency.normalize_names(rows))
    return one.join(two.withColumnRenamed("n", "n_normal"), ["drug", "event"])


@query("SELECT * FROM counts")
def sink_json_round_trip(spark, d):
    out = _place(spark, "json")
    sinks.write_json(_counts(spark, d), out)
    return spark.read.schema("drug string, event string, n long").json(out)


@query("SELECT drug, event, n, (SELECT count(*) FROM counts) AS written FROM counts")
def sink_template_round_trip(spark, d):
    out = _place(spark, "counts")
    n = sinks.sink_output(_counts(spark, d), out + "-%Y")
    return spark.read.schema("drug string, event string, n long").json(out + "-[0-9]*").withColumn("written", F.lit(n).cast("long"))


@query(f"SELECT drug, event, n, {_r('prr', 'ic025')}, ror_signal FROM freq")
def sink_signals_round_trip(spark, d):
    out = _place(spark, "signals")
    sinks.sink_signals(_frequentist(spark, d), out)
    return rounded(spark.read.schema(store.SCHEMAS["signals"]).json(out).select("drug", "event", "n", "prr", "ic025", "ror_signal"))


@query("SELECT * FROM kept")
def sink_parquet_round_trip(spark, d):
    out = _place(spark, "parquet")
    sinks.write_parquet(_kept(spark, d), out)
    sinks.write_parquet(_kept(spark, d).limit(0), out)
    return spark.read.parquet(out)


def _filled(spark, d) -> store.SignalStore:
    """A store of the orders: reports come twice, the second time with another version and country, which is ignored."""
    s = store.SignalStore(spark, _place(spark, "store"))
    reports = views.reports(spark, d).select(F.col("safety_report_id").alias("primary_id"), "case_version", "receipt_date", F.col("occur_country").alias("country"))
    later = reports.withColumns({"case_version": F.col("case_version") + 7, "country": F.lit("XX")})
    both = reports.withColumn("place", F.lit(0)).unionByName(later.withColumn("place", F.lit(1)))
    s.insert_reports(both.filter("cast(primary_id as bigint) % 4 > 0"), "place")
    s.insert_reports(reports)
    s.insert_reports(later)
    case = F.col("case_id").cast("string").alias("primary_id")
    s.insert_drugs(views.drugs(spark, d).select(case, F.lower("drug").alias("drug"), "role", F.lit(1).alias("seq")))
    s.insert_reactions(views.reactions(spark, d).select(case, F.lower("event").alias("event")))
    s.build_pairs()
    return s


@query("SELECT CAST(ord AS VARCHAR) AS primary_id, CAST(version AS INTEGER) AS case_version, strftime(o_orderdate, '%Y%m%d') AS receipt_date, country FROM reports JOIN orders ON ord = o_orderkey")
def store_insert_or_ignore(spark, d):
    return _filled(spark, d).table("reports")


_DISTINCT = "pairs AS (SELECT drug, event, count(DISTINCT case_id) AS n FROM all_rows WHERE role = 'PS' GROUP BY drug, event)"


@query(f", {_DISTINCT} SELECT * FROM pairs WHERE n >= 3")
def store_frequent_pairs(spark, d):
    return _filled(spark, d).frequent(3)


@query(f", {_DISTINCT} SELECT drug, event, n, (SELECT count(*) FROM pairs) AS exported FROM pairs")
def store_export(spark, d):
    s, out = _filled(spark, d), _place(spark, "export")
    n = s.export("drug_event_pairs", out)
    s.export("signals", out)
    return spark.read.parquet(out).withColumn("exported", F.lit(n).cast("long"))


@query(f", {_DISTINCT} SELECT drug, event, n FROM pairs UNION ALL SELECT drug, 'NONE', 0 FROM (SELECT DISTINCT drug FROM pairs)")
def store_point_lookups(spark, d):
    """Every pair, and every drug with an unknown event, looked up at once."""
    s = _filled(spark, d)
    known = s.table("drug_event_pairs")
    return s.counts(known.select(F.lower("drug").alias("drug"), F.lower("event").alias("event")).unionByName(known.select("drug", F.lit("none").alias("event")).distinct()))


@query(f", {_DISTINCT} SELECT drug, event, n AS a, CAST(sum(n) OVER (PARTITION BY drug) - n AS BIGINT) AS b, CAST(sum(n) OVER (PARTITION BY event) - n AS BIGINT) AS c, CAST(sum(n) OVER () - sum(n) OVER (PARTITION BY drug) - sum(n) OVER (PARTITION BY event) + n AS BIGINT) AS d FROM pairs")
def store_contingency(spark, d):
    """The 2x2 tables of every pair of a store."""
    s = _filled(spark, d)
    return s.contingencies(s.table("drug_event_pairs"))


@query(f", {_DISTINCT} SELECT drug, event, n FROM pairs WHERE n >= 2")
def store_transactions(spark, d):
    """A commit of pairs and signals at once; what failed or was rolled back after it leaves no trace."""
    s = _filled(spark, d)
    with s.transaction():
        s.insert_signals(_as_signals(s.table("drug_event_pairs").filter("n >= 2")))
        s.append("metadata", spark.createDataFrame([("run", "1")], store.SCHEMAS["metadata"]))
    s.begin()
    s.insert_signals(_as_signals(s.table("drug_event_pairs")))
    s.rollback()
    other = store.SignalStore(spark, s.path)
    if other.table("metadata").count() != 1:
        raise RuntimeError("a commit is missing")
    return other.table("signals").select("drug", "event", "n")


def _as_signals(pairs: DataFrame) -> DataFrame:
    kinds = dict(f.split() for f in store.SCHEMAS["signals"].split(", "))
    return pairs.select("drug", "event", "n", *(F.lit(None).cast(t).alias(c) for c, t in kinds.items() if c not in ("drug", "event", "n")))


@query(f", {_DISTINCT} SELECT (SELECT count(*) FROM reports) AS reports, (SELECT count(*) FROM drugs) AS drugs, (SELECT count(DISTINCT drug) FROM drugs) AS unique_drugs, (SELECT count(*) FROM reactions) AS reactions, (SELECT count(DISTINCT event) FROM reactions) AS unique_events, (SELECT count(*) FROM pairs) AS pairs, 0::BIGINT AS signals")
def store_of_files_stats(spark, d):
    return _filled(spark, d).stats()


@query(f", {_DISTINCT} SELECT event, CAST(sum(n) AS BIGINT) AS n FROM pairs GROUP BY event")
def store_sql(spark, d):
    return _filled(spark, d).sql("select event, cast(sum(n) as bigint) n from {drug_event_pairs} group by event")


@query("SELECT count(*) AS n FROM reports")
def store_tables_of_a_new_folder(spark, d):
    """Reports that a new store doesn't have yet: all."""
    s = store.SignalStore(spark, _place(spark, "none"))
    rows = views.reports(spark, d).select(F.col("safety_report_id").alias("primary_id"))
    return rows.join(s.table("reports"), "primary_id", "left_anti").agg(F.count("*").alias("n"))


def _reports(spark, d) -> DataFrame:
    """Nested reports, one for each line, as the service would return them."""
    line = views.table(spark, d, "lineitem").join(views.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    names = F.struct(F.array("p_brand").alias("brand_name"), F.array("p_type").alias("generic_name"))
    drug = F.struct(F.lit("1").alias("drugcharacterization"), F.col("p_name").alias("medicinalproduct"), names.alias("openfda"))
    event = F.struct(F.lower("p_name").alias("reactionmeddrapt"), F.lit("1").alias("reactionoutcome"))
    return line.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("safetyreportid"), F.when(F.col("l_returnflag") == "A", "1").otherwise("2").alias("serious"), F.date_format("l_shipdate", "yyyyMMdd").alias("receiptdate"), F.struct(F.array(drug).alias("drug"), F.array(event).alias("reaction")).alias("patient"))


@query("SELECT l_orderkey || '-' || l_linenumber AS id FROM lineitem JOIN part ON l_partkey = p_partkey WHERE upper(p_brand) = 'BRAND#11' AND l_returnflag = 'A' AND l_shipdate BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'", with_views=False)
def rest_filters(spark, d):
    q = openfda.EventQuery(drug="brand#11", serious_only=True, date_from="19940101", date_to="19961231")
    return openfda.filter_reports(_reports(spark, d), q).select(F.col("safetyreportid").alias("id"))


@query("SELECT l_orderkey || '-' || l_linenumber AS id FROM lineitem JOIN part ON l_partkey = p_partkey WHERE upper(p_name) = (SELECT min(upper(p_name)) FROM part)", with_views=False)
def rest_event_filter(spark, d):
    first = views.table(spark, d, "part").agg(F.min(F.upper("p_name"))).first()[0]
    return openfda.filter_reports(_reports(spark, d), openfda.EventQuery(event=first.lower())).select(F.col("safetyreportid").alias("id"))


@query(_INGEST.format(rows="sus"))
def stream_linked_quarters(spark, d):
    """The files of two quarters, which arrive kind by kind, reports last, and are linked as they come."""
    folder = write_quarters(spark, d)
    arrived, out, mark = (_place(spark, x) for x in ("arrived", "linked", "mark"))
    files, where = file_system(spark, arrived)
    files.mkdirs(where)
    for run, kinds in enumerate((("THER", "REAC"), ("OUTC", "RPSR", "DRUG"), ("DEMO",))):
        for status in files.listStatus(file_system(spark, folder)[1]):
            name = status.getPath().getName()
            if name.startswith(kinds) and not files.rename(status.getPath(), file_system(spark, f"{arrived}/{name}")[1]):
                raise OSError(f"{name} can't be moved")
        linking.link_arrived(spark, arrived, out, mark, run).awaitTermination()
    return linking.current(spark, out)


PAGE = 200
#: Pages of a file, a line each: files grow in number with the pages, but not as fast as the pages.
PAGES_OF_A_FILE = 200


def in_pages(batches):
    """Texts of reports as texts of pages: PAGE of them each, and in the last page of a task what is left."""
    rest = pa.array([], pa.string())

    def pages_of(reports: pa.Array, ends: list[int]) -> pa.RecordBatch:
        bodies = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), reports), ",")
        return pa.RecordBatch.from_arrays([pc.binary_join_element_wise('{"results":[', bodies, "]}", "")], names=["value"])

    for batch in batches:
        rest = pa.concat_arrays([rest, batch.column(0).cast(pa.string())])
        if whole := len(rest) // PAGE * PAGE:
            yield pages_of(rest[:whole], list(range(PAGE, whole + 1, PAGE)))
            rest = rest[whole:]
    if len(rest):
        yield pages_of(rest, [len(rest)])


def write_pages(spark, d, compression: str = "none") -> str:
    """Files of pages of PAGE reports, as the service would send them.

    Each task puts its own reports into pages, as many as they fill and one with the rest, so that their texts are never
    shuffled: on disk they are once, and a tenth of their size where ``compression`` is gzip.
    """
    out = _place(spark, "pages")
    rows = _reports(spark, d)
    texts = rows.select(F.to_json(F.struct(*rows.columns)).alias("report"))
    texts.mapInArrow(in_pages, "value string").write.options(maxRecordsPerFile=PAGES_OF_A_FILE, compression=compression).text(out)
    return out


@query("SELECT upper(p_name) AS drug, upper(p_name) AS event, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL", with_views=False)
def rest_pages(spark, d):
    """The pairs of all pages, each page a partition of the source."""
    return openfda.pair_counts(pages.reports(pages.read_pages(spark, write_pages(spark, d, "gzip"))))


@query("SELECT l_orderkey || '-' || l_linenumber AS id FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A' AND l_shipdate BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'", with_views=False)
def rest_pages_filtered(spark, d):
    """Serious reports of three years: the source is told, and hands out no others."""
    rows = pages.read_pages(spark, write_pages(spark, d, "gzip")).filter("serious = '1' and receiptdate >= '19940101' and receiptdate <= '19961231'")
    return rows.select(F.col("safetyreportid").alias("id"))


@query("SELECT drug, event, n FROM counts")
def stream_counts(spark, d):
    """Two halves of the rows arrive one after the other."""
    folder, out, mark = (_place(spark, x) for x in ("arrived", "batches", "mark"))
    rows = views.rows(spark, d).select(F.col("case_id").cast("long").alias("case_id"), "drug", "event")
    for odd in (0, 1):
        rows.filter(F.col("case_id") % 2 == odd).write.mode("append").parquet(folder)
        quarters.write_batches(quarters.read_rows(spark, folder), out, mark).awaitTermination()
    return quarters.total_counts(spark, out)


@query("SELECT printf('%06d-%03d', p_partkey, p_size) AS product_ndc, p_name AS brand_name, p_type AS generic_name, p_brand AS labeler_name, p_brand AS ingredient FROM part", with_views=False)
def ndc_directory_file(spark, d):
    """The directory as JSON arrays in files."""
    out = _place(spark, "directory")
    p = views.products(spark, d)
    # Files of a thousand products, each one array.
    part = F.floor(F.col("ord") / 1000).cast("int")
    p.groupBy(part.alias("part")).agg(F.to_json(F.collect_list(F.struct(*(c for c in p.columns if c != "ord")))).alias("value")).repartition("part").write.partitionBy("part").text(out)
    return read_directory(spark, out).select("product_ndc", "brand_name", "generic_name", "labeler_name", F.col("active_ingredients")[0].alias("ingredient"))


@query("SELECT DISTINCT 'brand' AS kind, lower(p_name) AS name FROM part UNION ALL SELECT DISTINCT 'generic', lower(p_type) FROM part", with_views=False)
def ndc_name_lists(spark, d):
    p = ndc.directory(views.products(spark, d), "ord")
    if ndc.is_empty(p) or not ndc.is_empty(p.limit(0)):
        raise RuntimeError("a directory with products isn't empty")
    return ndc.names(p, "brand").withColumn("kind", F.lit("brand")).unionByName(ndc.names(p, "generic").withColumn("kind", F.lit("generic"))).select("kind", "name")


@query("SELECT role, CASE role WHEN 'PS' THEN 'Primary suspect' WHEN 'SS' THEN 'Secondary suspect' ELSE 'Concomitant' END AS label, CASE role WHEN 'PS' THEN 'Suspect' WHEN 'SS' THEN 'Concomitant' ELSE 'Interacting' END AS characterization, count(*) AS n FROM drugs GROUP BY ALL")
def role_labels(spark, d):
    code = coded(F.col("role"), {"PS": "1", "SS": "2", "C": "3"})
    rows = views.drugs(spark, d).select("role", coded(F.col("role"), DRUG_ROLES).alias("label"), coded(code, CHARACTERIZATIONS).alias("characterization"))
    return rows.groupBy("role", "label", "characterization").agg(F.count("*").alias("n"))


@query("SELECT drug, event, n FROM freq WHERE drug LIKE 'BRAND#_1%' AND NOT isnan(prr)")
def like_and_nan_filters(spark, d):
    return _frequentist(spark, d).filter(F.col("drug").like("BRAND#_1%") & ~F.isnan("prr")).select("drug", "event", "n")


@query("SELECT CAST(ord AS VARCHAR) AS safety_report_id, row_number() OVER (PARTITION BY cluster ORDER BY ord) = 1 AS is_primary FROM clusters")
def dedup_by_order_only(spark, d):
    """Neither the latest nor the most complete report is preferred, so the first in order is primary."""
    config = DedupConfig(prefer_latest=False, prefer_complete=False)
    return dedup.deduplicate(views.reports(spark, d), "ord", config).select("safety_report_id", "is_primary")


@query("SELECT drug, event, n, row_number() OVER (PARTITION BY drug ORDER BY n DESC, event) AS place FROM counts QUALIFY place <= 3")
def top_events_of_each_drug(spark, d):
    place = F.row_number().over(Window.partitionBy("drug").orderBy(F.desc("n"), "event"))
    return _counts(spark, d).withColumn("place", place.cast("long")).filter("place <= 3")
