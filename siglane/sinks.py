"""JSON and Parquet outputs. Nothing is written for no rows."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siglane.session import file_system

DEFAULT_TEMPLATE = "output/counts-%Y%m%d.json"


def _write(df: DataFrame, path: str, kind: str, **options) -> int:
    """Writes beside ``path``, counting rows in the same pass, and puts the result in its place if it has any."""
    spark, seen, new = df.sparkSession, Observation(), f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.options(**options).format(kind).save(new)
    files, made = file_system(spark, new)
    _, where = file_system(spark, path)
    n = seen.get["n"]
    if not n:
        files.delete(made, True)
        return 0
    # The old result stands aside until the new one is in its place: at no time is there neither.
    _, aside = file_system(spark, f"{new}.old")
    old = files.exists(where)
    if old and not files.rename(where, aside):
        raise OSError(f"{path} can't be moved aside")
    if not files.rename(made, where):
        if old:
            files.rename(aside, where)
        raise OSError(f"{new} can't be renamed to {path}")
    if old:
        files.delete(aside, True)
    return n


def write_json(df: DataFrame, path: str) -> int:
    """Rows as JSON lines, in a folder of part files; returns their number."""
    return _write(df, path, "json")


def sink_output(df: DataFrame, template: str = DEFAULT_TEMPLATE) -> int:
    """write_json() to a path whose % fields are filled with the present time."""
    return write_json(df, time.strftime(template))


def sink_signals(df: DataFrame, path: str) -> int:
    return write_json(df, path)


def write_parquet(df: DataFrame, path: str) -> int:
    """Snappy Parquet."""
    return _write(df, path, "parquet", compression="snappy")
