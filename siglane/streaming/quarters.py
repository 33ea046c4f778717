"""Incremental pair counts over arriving Parquet files of drug-event rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F


def read_rows(spark: SparkSession, folder: str, schema: str = "case_id long, drug string, event string") -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def write_batches(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's pair counts under its number and ends when all files are read; a batch that is run again
    replaces what it wrote, so each row counts once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.groupBy(F.upper("drug").alias("drug"), F.upper("event").alias("event")).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def total_counts(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("drug", "event").agg(F.sum("n").alias("n"))
