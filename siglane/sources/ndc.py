"""Drug-code directory files: a JSON array of products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siglane.schema import NDC_SCHEMA


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True, schema=NDC_SCHEMA)
