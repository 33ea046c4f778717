"""Incremental linking of quarterly files: reports are linked as their lines arrive, in whatever order.

A stream says which files are new; a batch reads those of one kind and header at once, and keeps their fragments, which
are the fields that count of each line, as Parquet files by kind, below the stream's checkpoint. It joins the reports of
which new ones came with all fragments that are there: their drug-event rows come anew under the number of the run, its
generation. The rows of a report's latest generation are what holds: they retract all earlier ones. So a DRUG file that
comes before or after its DEMO file ends at the same rows. They are written as a row a report, with lists of its drugs
and its reactions, and meet where they are read.

A line is read once, a run reads the kept fragments once. What a batch writes has the batch's folder, which a batch that
is done again replaces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siglane.schema import INGEST_SCHEMA, SUSPECT_ROLES
from siglane.session import file_system, prepare
from siglane.sources import faers

#: What each kind of file says, by the names of its columns.
WANTED = {
    "DEMO": ("age", "age_grp", "sex", "wt", "reporter_country", "occr_country", "mfr_sndr", "occp_cod", "mfr_num", "fda_dt", "event_dt"), "DRUG": ("role_cod", "drugname"), "REAC": ("pt",), "OUTC": ("outc_cod",), "RPSR": ("rpsr_cod",), "THER": ("dsg_drug_seq", "start_dt", "end_dt"),
}
LINKED = f"primaryid string, generation long, {faers.LISTS}, " + ", ".join(x for x in INGEST_SCHEMA.split(", ") if x.split()[0] in faers.ONCE)
FRAGMENTS = "primaryid string, " + ", ".join(f"{n} string" for names in WANTED.values() for n in names)


ARRIVED = "path string, modificationTime timestamp, length long, content binary"
_NAME = re.compile(r"/(DEMO|DRUG|REAC|OUTC|RPSR|THER)[^/]*\.txt(/[^/]*)?$", re.IGNORECASE)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The names in a file's first line that isn't empty; none if it has no such line."""
    jvm = spark.sparkContext._jvm
    files, where = file_system(spark, path)
    packed = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(where)
    stream = files.open(where)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(packed.createInputStream(stream) if packed else stream, "UTF-8"))
    try:
        while (line := lines.readLine()) is not None:
            if line.strip():
                return tuple(c.strip().lower() for c in line.split("$"))
        return ()
    finally:
        lines.close()


def fragments(spark: SparkSession, paths: list[str], all_roles: bool = False) -> dict[str, DataFrame]:
    """By kind, primaryid and the fields that count of each line of these files, each read by its own header."""
    alike: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for path in sorted(paths):
        if (found := _NAME.search(path)) and (names := _header(spark, path)):
            alike.setdefault((found[1].upper(), names), []).append(path)
    out: dict[str, DataFrame] = {}
    for (kind, names), some in alike.items():
        # Columns by their place: a header may have a name twice, of which the first counts.
        rows = spark.read.csv(some, schema=", ".join(f"c{k} string" for k in range(len(names))), sep="$", header=True, mode="PERMISSIVE", quote="")
        at = lambda n: F.col(f"c{names.index(n)}") if n in names else F.lit(None).cast("string")  # noqa: B023, E731
        rows = rows.select(*(F.nullif(at(n), F.lit("")).alias(n) for n in ("primaryid", *WANTED[kind]))).filter("primaryid is not null")
        if kind == "DRUG" and not all_roles:
            rows = rows.filter(F.col("role_cod").isin(*SUSPECT_ROLES))
        out[kind] = out[kind].unionByName(rows) if kind in out else rows
    return out


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """The batches of which there are folders, in their order."""
    files, where = file_system(spark, f"{folder}/batch=*")
    return sorted(int(f.getPath().getName().removeprefix("batch=")) for f in files.globStatus(where))


def _link(new: DataFrame, batch: int, out: str, kept: str, generation: int, all_roles: bool, buckets: int | None) -> None:
    """Keeps the fragments of a batch's files and writes the reports that they belong to."""
    spark = new.sparkSession
    if buckets:
        # The session is the stream's own.
        spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
    # A row a file, as a listing has.
    for kind, rows in fragments(spark, [r.path for r in new.collect()], all_roles).items():
        rows.write.mode("overwrite").parquet(f"{kept}/batch={batch}/kind={kind}")
    files, where = file_system(spark, f"{kept}/batch=*/kind=*")
    if not {"DEMO", "DRUG", "REAC"} <= {f.getPath().getName().removeprefix("kind=") for f in files.globStatus(where)}:
        return
    known = spark.read.schema(f"{FRAGMENTS}, batch long, kind string").parquet(kept)
    kinds = {k: known.filter(F.col("kind") == k).select("primaryid", *names) for k, names in WANTED.items()}
    # The first batch that writes has brought the last of these three kinds, and with it a line of each report that has rows.
    if any(b < batch for b in _batches(spark, out)):
        changed = known.filter(F.col("batch") == batch).select("primaryid").distinct()
        kinds["DEMO"] = kinds["DEMO"].join(changed, "primaryid", "left_semi")
    reports = faers.listed_reports(kinds)
    reports.withColumn("generation", F.lit(generation).cast("long")).write.mode("overwrite").parquet(f"{out}/batch={batch}")


def link_arrived(spark: SparkSession, folder: str, out: str, checkpoint: str, generation: int, all_roles: bool = False, buckets: int | None = None) -> StreamingQuery:
    """Starts the stream over what has arrived below ``folder`` since the last run; it ends when all of it is linked.

    ``generation`` has to grow from run to run. ``buckets``: partitions of its shuffles, else the session's.
    """
    prepare(spark)
    files, where = file_system(spark, out)
    files.mkdirs(where)
    # Of the files only their paths: a batch reads their lines itself.
    arrived = spark.readStream.format("binaryFile").schema(ARRIVED).option("recursiveFileLookup", "true").load(folder).select("path")
    write = lambda new, batch: _link(new, batch, out, f"{checkpoint}/fragments", generation, all_roles, buckets)
    return arrived.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str) -> DataFrame:
    """The ingest rows that hold: those of each report's latest generation, and of its last batch there."""
    rows = spark.read.schema(f"{LINKED}, batch long").parquet(out).withColumn("run", F.struct("generation", "batch"))
    batches = _batches(spark, out)
    # Nothing retracts what the last batch says.
    last = rows.filter(F.col("batch") == batches[-1]) if batches else rows
    if len(batches) > 1:
        latest = rows.groupBy(F.col("primaryid").alias("of")).agg(F.max("run").alias("last"))
        earlier = rows.filter(F.col("batch") < batches[-1])
        last = last.unionByName(earlier.join(latest, (F.col("primaryid") == F.col("of")) & (F.col("run") == F.col("last"))).select(*rows.columns))
    return faers.with_pairs(last)
