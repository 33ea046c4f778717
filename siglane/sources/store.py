"""A store of reports, drugs, reactions, pair counts and signals as Parquet tables in one folder."""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglane import sinks
from siglane.operators.contingency import count_cases, dealt, totals
from siglane.session import file_system

SCHEMAS = {
    "reports": "primary_id string, case_version int, receipt_date string, country string",
    "drugs": "primary_id string, drug string, role string, seq int",
    "reactions": "primary_id string, event string",
    "drug_event_pairs": "drug string, event string, n long",
    "signals": "drug string, event string, n long, prr double, prr_lower_ci double, prr_upper_ci double, prr_signal boolean, ror double, ror_lower_ci double, ror_signal boolean, ic double, ic025 double, ic_signal boolean, ebgm double, eb05 double, ebgm_signal boolean",
    "metadata": "key string, value string",
}


#: Settings of the pairs' Parquet files.
PAIR_INDEX = {"parquet.bloom.filter.enabled#drug": "true", "parquet.bloom.filter.enabled#event": "true", "parquet.page.row.count.limit": "4096"}


class SignalStore:
    """Tables of Parquet folders. A commit is one small file, which lists the folders of every table.

    Writers put their rows into new folders and then place the next commit's file, of which there can be one only:
    renaming fails where another writer was faster, and nobody sees half of what a writer has done. Readers take the
    latest commit first and then its folders, which no later commit changes.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._open: dict[str, list[str]] | None = None
        self._base, self._made = 0, []

    def _at(self, name: str):
        return file_system(self.spark, f"{self.path}/{name}")

    def _latest(self) -> tuple[int, dict[str, list[str]]]:
        """(number of the latest commit, folders of each table); 0 for a new store."""
        files, where = self._at("commits")
        if not files.exists(where):
            return 0, {}
        names = [f.getPath().getName() for f in files.listStatus(where)]
        numbers = [int(n.split(".")[0]) for n in names if n.endswith(".json") and n.split(".")[0].isdigit()]
        if not numbers:
            return 0, {}
        files, where = self._at(f"commits/{max(numbers):012}.json")
        stream = files.open(where)
        try:
            return max(numbers), json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _tables(self) -> dict[str, list[str]]:
        return self._latest()[1] if self._open is None else self._open

    def begin(self) -> None:
        """What is written from now on is seen by this store only, until commit()."""
        if self._open is not None:
            raise RuntimeError("there is an open transaction")
        self._base, self._open = self._latest()
        self._open = {k: list(v) for k, v in self._open.items()}
        self._made = []

    def commit(self) -> int:
        """Makes all that was written since begin() visible at once; returns the commit's number.

        Fails, and leaves everything as it was, if another writer has committed since begin().
        """
        if self._open is None:
            raise RuntimeError("there is no open transaction")
        jvm, number = self.spark.sparkContext._jvm, self._base + 1
        files, new = self._at(f"commits/{uuid.uuid4().hex}.new")
        stream = files.create(new)
        stream.write(bytearray(json.dumps(self._open).encode()))
        stream.close()
        _, where = self._at(f"commits/{number:012}.json")
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        try:
            # Unlike a file system's own rename, this one never replaces what is there.
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(files.makeQualified(new), files.makeQualified(where), self.spark.sparkContext._gateway.new_array(rename, 0))
        except Exception as e:
            files.delete(new, False)
            self.rollback()
            raise RuntimeError(f"commit {number} was made by another writer") from e
        self._open, self._made = None, []
        return number

    def rollback(self) -> None:
        """Drops the folders written since begin()."""
        made, self._open, self._made = self._made, None, []
        for name in made:
            files, where = self._at(name)
            files.delete(where, True)

    @contextmanager
    def transaction(self):
        """begin() and commit(), or rollback() if what is done in between fails; within another one, part of that."""
        if self._open is not None:
            yield self
            return
        self.begin()
        try:
            yield self
        except BaseException:
            self.rollback()
            raise
        self.commit()

    def table(self, name: str) -> DataFrame:
        folders = self._tables().get(name)
        if not folders:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(*(f"{self.path}/{f}" for f in folders))

    def _write(self, name: str, rows: DataFrame, replace: bool = False, **options) -> None:
        with self.transaction():
            folder = f"data/{name}-{uuid.uuid4().hex}"
            self._made.append(folder)
            names = [f.split()[0] for f in SCHEMAS[name].split(", ")]
            rows.select(*names).write.options(**options).parquet(f"{self.path}/{folder}")
            self._open[name] = [folder] if replace else [*self._open.get(name, []), folder]

    def append(self, name: str, rows: DataFrame) -> None:
        self._write(name, rows)

    def insert_reports(self, rows: DataFrame, order: str | None = None) -> None:
        """Reports with ids not yet there; of several new ones with one id, the first by ``order``, a column.

        Without ``order`` the place in ``rows`` counts, which is that of the files only while nothing was shuffled.
        ``rows`` are counted first: they are dealt by id to tasks whose number follows theirs.
        """
        place = F.col(order) if order else F.monotonically_increasing_id()
        names = [f.split()[0] for f in SCHEMAS["reports"].split(", ")]
        placed = dealt(rows.select(*names, place.alias("place_")), "primary_id", rows.count())
        first = placed.groupBy("primary_id").agg(F.min_by(F.struct(*names[1:]), "place_").alias("r")).select("primary_id", "r.*")
        self.append("reports", first.join(self.table("reports").select("primary_id"), "primary_id", "left_anti"))

    def insert_drugs(self, rows: DataFrame) -> None:
        self.append("drugs", rows.withColumn("drug", F.upper("drug")))

    def insert_reactions(self, rows: DataFrame) -> None:
        self.append("reactions", rows.withColumn("event", F.upper("event")))

    def insert_signals(self, rows: DataFrame) -> None:
        self.append("signals", rows)

    def build_pairs(self) -> None:
        """Counts distinct reports of each primary suspect drug and event anew.

        Pairs are dealt by ranges of (drug, event) and sorted, with Bloom filters of both names in each row group: a
        lookup reads the row groups and pages that can hold its names, and no others.
        """
        drugs, reactions = self.table("drugs"), self.table("reactions")
        # From the files' footers.
        size = max(drugs.count(), reactions.count())
        found = pairs(drugs, reactions, size=size).repartitionByRange("drug", "event").sortWithinPartitions("drug", "event")
        self._write("drug_event_pairs", found, replace=True, **PAIR_INDEX)

    def count(self, drug: str, event: str) -> int:
        row = self.table("drug_event_pairs").filter((F.col("drug") == drug.upper()) & (F.col("event") == event.upper())).agg(F.sum("n")).first()
        return row[0] or 0

    def counts(self, wanted: DataFrame) -> DataFrame:
        """drug, event, n of every row of ``wanted`` (drug, event in any case), 0 for unknown pairs: all in one join."""
        asked = wanted.select(F.upper("drug").alias("drug"), F.upper("event").alias("event"))
        return asked.join(self.table("drug_event_pairs"), ["drug", "event"], "left").select("drug", "event", F.coalesce("n", F.lit(0)).alias("n"))

    def top_events(self, drug: str, k: int) -> DataFrame:
        return top_events(self.table("drug_event_pairs"), drug, k)

    def contingency(self, drug: str, event: str) -> tuple[int, int, int, int]:
        return tuple(pair_cells(self.table("drug_event_pairs"), drug, event).first())

    def contingencies(self, wanted: DataFrame) -> DataFrame:
        """drug, event, a, b, c, d of every row of ``wanted``, as contingency() has them, from one pass of totals."""
        known = self.table("drug_event_pairs")
        sums = totals(known)
        of = lambda kind, name, alias: sums.filter(F.col("kind") == kind).select(F.col("name").alias(name), F.col("total").alias(alias))
        out = self.counts(wanted).join(of(1, "drug", "dt"), "drug", "left").join(of(2, "event", "et"), "event", "left")
        # One row.
        out = out.crossJoin(F.broadcast(sums.agg(F.coalesce(F.max(F.when(F.col("kind") == 3, F.col("total"))), F.lit(0)).alias("total"))))
        a, dt, et, zero = F.col("n"), F.coalesce("dt", F.lit(0)), F.coalesce("et", F.lit(0)), F.lit(0).cast("long")
        return out.select("drug", "event", a.alias("a"), F.greatest(dt - a, zero).alias("b"), F.greatest(et - a, zero).alias("c"), F.greatest(F.col("total") - dt - et + a, zero).alias("d"))

    def frequent(self, least: int) -> DataFrame:
        return self.table("drug_event_pairs").filter(F.col("n") >= least).orderBy(F.desc("n"), "drug", "event")

    def stats(self) -> DataFrame:
        return stats(*(self.table(t) for t in ("reports", "drugs", "reactions", "drug_event_pairs", "signals")))

    def export(self, name: str, path: str) -> int:
        """Snappy Parquet of a table; none for an empty one."""
        return sinks.write_parquet(self.table(name), path)

    def sql(self, query: str) -> DataFrame:
        """SQL over the tables, by their names in braces."""
        return self.spark.sql(query, **{n: self.table(n) for n in SCHEMAS if f"{{{n}}}" in query})


def pairs(drugs: DataFrame, reactions: DataFrame, key: str = "primary_id", size: int | None = None) -> DataFrame:
    """drug, event, n: distinct reports with the drug as primary suspect; size: as count_cases() has it."""
    return count_cases(drugs.filter("role = 'PS'"), reactions, key, size)


def top_events(counts: DataFrame, drug: str, k: int) -> DataFrame:
    return counts.filter(F.col("drug") == drug.upper()).orderBy(F.desc("n"), "event").limit(k)


def pair_cells(counts: DataFrame, drug: str, event: str) -> DataFrame:
    """One row: a, b, c, d of one pair, all in one pass."""
    d, e, n = F.col("drug") == drug.upper(), F.col("event") == event.upper(), F.col("n")
    sums = counts.agg(*(F.coalesce(F.sum(F.when(c, n)), F.lit(0)).alias(k) for k, c in (("a", d & e), ("dt", d), ("et", e), ("total", F.lit(True)))))
    zero = F.lit(0).cast("long")
    return sums.select("a", F.greatest(F.col("dt") - F.col("a"), zero).alias("b"), F.greatest(F.col("et") - F.col("a"), zero).alias("c"), F.greatest(F.col("total") - F.col("dt") - F.col("et") + F.col("a"), zero).alias("d"))


def stats(reports: DataFrame, drugs: DataFrame, reactions: DataFrame, counts: DataFrame, signals: DataFrame) -> DataFrame:
    one = reports.agg(F.count("*").alias("reports"))
    for df, column, a, b in ((drugs, "drug", "drugs", "unique_drugs"), (reactions, "event", "reactions", "unique_events")):
        one = one.crossJoin(df.agg(F.count("*").alias(a), F.countDistinct(column).alias(b)))
    return one.crossJoin(counts.agg(F.count("*").alias("pairs"))).crossJoin(signals.agg(F.count("*").alias("signals")))
