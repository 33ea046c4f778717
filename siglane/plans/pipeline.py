"""From report rows to signals, and the command line."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglane import sinks
from siglane.operators import contingency, signals
from siglane.schema import SignalConfig
from siglane.session import file_system
from siglane.sources import faers


def run_pipeline(rows: DataFrame, min_cases: int = 3, config: SignalConfig = SignalConfig()) -> DataFrame:
    """Signals of ingested rows (drug, event): normalise, count, filter, 2x2 tables, metrics; one lazy plan."""
    counts = contingency.filter_minimum(contingency.count_pairs(contingency.normalize_names(rows)), min_cases)
    return signals.from_counts(counts, config)


def print_summary(counts: DataFrame, found: DataFrame) -> None:
    contingency.count_summary(counts).show(truncate=False)
    signals.signal_summary(found).show(truncate=False)
    contingency.top(counts, "drug").show(truncate=False)
    contingency.top(counts, "event").show(truncate=False)
    counts.orderBy(F.desc("n"), "drug", "event").limit(15).show(truncate=False)


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Counts drug-event pairs of a quarter and detects signals.")
    p.add_argument("--faers-dir", default=str(faers.data_dir()))
    p.add_argument("--counts-out", default=sinks.DEFAULT_TEMPLATE)
    p.add_argument("--signals-out", default="output/signals.json")
    p.add_argument("--min-cases", type=int, default=3)
    p.add_argument("--include-all-roles", action="store_true")
    p.add_argument("--counts-only", action="store_true")
    p.add_argument("--dry-run", action="store_true", help="only check that the folder is there")
    p.add_argument("--no-summary", action="store_true")
    p.add_argument("--once", action="store_true", help="counts only, no signals and no summary: the plain ETL run")
    p.add_argument("--output", dest="counts_out", help="the same as --counts-out")
    p.add_argument("-v", "--verbose", action="store_true", help="say what is read and written")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("siglane").getOrCreate()
    files, where = file_system(spark, a.faers_dir)
    if not files.exists(where) or not files.getFileStatus(where).isDirectory():
        print(f"no such folder: {a.faers_dir}", file=sys.stderr)
        return 1
    if a.dry_run:
        return 0
    if a.verbose:
        print(f"reading {a.faers_dir}", file=sys.stderr)
    rows = faers.ingest(spark, a.faers_dir, a.include_all_roles)
    counts, found = contingency.filter_minimum(contingency.count_pairs(rows), a.min_cases).cache(), None
    try:
        n = sinks.sink_output(counts, a.counts_out)
        if a.verbose:
            print(f"{n} pairs", file=sys.stderr)
        if not a.counts_only and not a.once:
            found = signals.from_counts(counts).cache()
            sinks.sink_signals(found, a.signals_out)
            if not a.no_summary:
                print_summary(counts, found)
    finally:
        for df in (found, counts):
            if df is not None:
                df.unpersist()
    return 0


if __name__ == "__main__":
    sys.exit(main())
