"""Quarterly report files: dollar-separated text, linked by primaryid."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglane.functions.text import joined, therapy_summary
from siglane.schema import INGEST_COLUMNS, INGEST_SCHEMA, SUSPECT_ROLES
from siglane.session import file_system

DATA_DIR = "FAERS_DATA_DIR"


def data_dir() -> Path:
    return Path(os.environ.get(DATA_DIR, "./data/faers"))


KINDS = ("DEMO", "DRUG", "REAC", "OUTC", "RPSR", "THER")
#: What can be wrong with a line: its number of fields, a report's id that is no whole number, a drug or reaction
#: without a name. The last two leave the line out; a line of too few fields lacks the last ones, one of too many ends
#: with the header's last.
FIELDS, ID, NAME = "fields", "id", "name"
ERRORS = "kind string, file string, path string, reason string, primaryid string, line string"
#: Extra columns of read_file(): the file as it is listed, the part of it that Spark has read, and the line if it has
#: another number of fields than the header.
FILE, PATH, BROKEN = "file of the line", "path of the line", "line with other fields"


def _files(spark: SparkSession, folder: str, kind: str) -> list[tuple[str, str]]:
    files, where = file_system(spark, folder)
    if not files.exists(where):
        return []
    found = ((f.getPath().getName(), str(f.getPath())) for f in files.listStatus(where))
    return sorted((name, path) for name, path in found if name.upper().startswith(kind) and name.lower().endswith(".txt"))


def read_file(spark: SparkSession, folder: str, kind: str, checked: bool = False) -> DataFrame | None:
    """All files of one kind (DEMO, DRUG, ...) of a folder, as strings with lower-case names; None if there is none.

    Each file has its own header: columns meet by name, whatever their order, and are null where a file lacks them. The
    folder can be in any file system that Spark reads. Columns FILE, PATH and BROKEN say where a line is from and, if
    ``checked``, what it was if its fields don't fit the header: for that all of a line is parsed, whatever is read of it.
    """
    out = None
    for name, path in _files(spark, folder, kind):
        options = {"sep": "$", "header": True, "mode": "PERMISSIVE", "quote": ""}
        header = spark.read.csv(path, **options).columns
        schema = ", ".join(f"`c{k}` string" for k in range(len(header)))
        rows = spark.read.option("columnPruning", str(not checked).lower()).csv(path, schema=f"{schema}, `broken` string", columnNameOfCorruptRecord="broken", **options)
        rows = rows.select(*(F.col(f"c{k}").alias(c.strip().lower()) for k, c in enumerate(header)), F.lit(name).alias(FILE), F.col("_metadata.file_path").alias(PATH), F.col("broken").alias(BROKEN))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _column(df: DataFrame, name: str, kind: str = "string"):
    return F.expr(f"try_cast(trim(`{name}`) as {kind})" if kind != "string" else f"nullif(`{name}`, '')") if name in df.columns else F.lit(None).cast(kind)


#: A report's id: a whole number.
_IS_ID = r"^\+?[0-9]+$"


def errors(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """kind, file, path, reason, primaryid, line: the lines that ingest() leaves out or takes with other fields.

    A line with more than one fault has a row for each. ``line`` is the text of a line with other fields, else null.
    """
    folder, out = str(folder or data_dir()), None
    for kind in KINDS:
        rows = read_file(spark, folder, kind, checked=True)
        if rows is None:
            continue
        faults = [F.when(F.col(BROKEN).isNotNull(), FIELDS)]
        if kind == "DEMO":
            faults.append(F.when(~F.coalesce(F.col("primaryid").rlike(_IS_ID), F.lit(False)), ID))
        named = {"DRUG": "drugname", "REAC": "pt"}.get(kind)
        if named:
            faults.append(F.when(_column(rows, named).isNull(), NAME))
        rows = rows.select(F.lit(kind).alias("kind"), F.col(FILE).alias("file"), F.col(PATH).alias("path"), F.explode(F.array_compact(F.array(*faults))).alias("reason"), "primaryid", F.col(BROKEN).alias("line"))
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], ERRORS) if out is None else out


def ingest_with_errors(spark: SparkSession, folder: str | None = None, all_roles: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ingest(), errors()): what could be read of a folder and what couldn't."""
    return ingest(spark, folder, all_roles), errors(spark, folder)


def ingest(spark: SparkSession, folder: str | None = None, all_roles: bool = False) -> DataFrame:
    """Drug-event rows of a quarter's folder in the 18 ingest columns; none of them if there are no files.

    Reports whose id isn't a whole number are skipped; errors() lists them. Drugs are filtered by role before they meet
    the reactions.
    """
    folder = str(folder or data_dir())
    files = {k: read_file(spark, folder, k) for k in KINDS}
    if any(files[k] is None for k in ("DEMO", "DRUG", "REAC")):
        return spark.createDataFrame([], INGEST_SCHEMA)
    return linked(files, all_roles)


def linked(files: dict[str, DataFrame | None], all_roles: bool = False) -> DataFrame:
    """Ingest rows of the files by kind, as read_file() gives them."""
    return linked_reports(files, all_roles).select(*INGEST_COLUMNS)


#: The columns of ingest rows that a report has once, and its lists in listed_reports().
ONCE = tuple(c for c in INGEST_COLUMNS if c not in ("drug", "role_code", "event"))
LISTS = "drugs array<struct<drug: string, role_code: string>>, events array<string>"


def listed_reports(files: dict[str, DataFrame | None]) -> DataFrame:
    """A row for each report with drugs and reactions: primaryid, drugs, events and the columns that it has once.

    These are the rows of linked_reports() for all roles, before drugs meet reactions: with_pairs() gives them.
    """
    return _linked(files, True, lists=True)


def with_pairs(reports: DataFrame) -> DataFrame:
    """The ingest rows of listed_reports()."""
    return reports.select(*ONCE, "events", F.inline("drugs")).select("*", F.explode("events").alias("event")).select(*INGEST_COLUMNS)


def linked_reports(files: dict[str, DataFrame | None], all_roles: bool = False) -> DataFrame:
    """linked() with the reports' primaryid."""
    return _linked(files, all_roles)


def _linked(files: dict[str, DataFrame | None], all_roles: bool, lists: bool = False) -> DataFrame:
    demo, drug, reac = files["DEMO"], files["DRUG"], files["REAC"]
    fields = {"age_years": ("age", "double"), "age_group": ("age_grp", "string"), "sex": ("sex", "string"), "weight_kg": ("wt", "double"), "reporter_country": ("reporter_country", "string"), "occr_country": ("occr_country", "string"), "mfr_sndr": ("mfr_sndr", "string"), "occp_cod": ("occp_cod", "string"), "mfr_num": ("mfr_num", "string"), "fda_dt": ("fda_dt", "string"), "event_dt": ("event_dt", "string")}
    case = F.expr("try_cast(primaryid as bigint)")
    demo = demo.filter(F.col("primaryid").rlike(_IS_ID)).select("primaryid", case.alias("case_id"), *(_column(demo, c, t).alias(k) for k, (c, t) in fields.items()))
    drugs = drug if all_roles else drug.filter(F.col("role_cod").isin(*SUSPECT_ROLES))
    drugs = drugs.filter("drugname is not null").select("primaryid", F.upper("drugname").alias("drug"), F.col("role_cod").alias("role_code"))
    events = reac.filter("pt is not null").select("primaryid", F.upper("pt").alias("event"))
    if lists:
        drugs = drugs.groupBy("primaryid").agg(F.collect_list(F.struct("drug", "role_code")).alias("drugs"))
        events = events.groupBy("primaryid").agg(F.collect_list("event").alias("events"))
    out = drugs.join(events, "primaryid").join(demo, "primaryid")
    for kind, column, name in (("RPSR", "rpsr_cod", "report_sources"), ("OUTC", "outc_cod", "outcomes")):
        if files[kind] is None:
            out = out.withColumn(name, F.lit(None).cast("string"))
        else:
            codes = files[kind].groupBy("primaryid").agg(F.sort_array(F.collect_list(column)).alias("x")).select("primaryid", joined(F.col("x")).alias(name))
            out = out.join(codes, "primaryid", "left")
    if files["THER"] is None:
        out = out.withColumn("therapy_summary", F.lit(None).cast("string"))
    else:
        t = files["THER"]
        entry = F.struct(F.expr("try_cast(dsg_drug_seq as int)").alias("seq"), _column(t, "start_dt").alias("start"), _column(t, "end_dt").alias("end"))
        therapies = t.groupBy("primaryid").agg(F.sort_array(F.collect_list(entry)).alias("x")).select("primaryid", therapy_summary(F.col("x")).alias("therapy_summary"))
        out = out.join(therapies, "primaryid", "left")
    return out.select("primaryid", *(("drugs", "events", *ONCE) if lists else INGEST_COLUMNS))
