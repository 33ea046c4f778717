"""What Python workers need of a session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a batch that Spark hands to a Python worker; by default 64 MB, of which a worker and Spark hold several.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it lies outside their path, and bounds what they are handed at once.

    A size of batches that the session has been given is left as it is.
    """
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, root) if x)
    return spark


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir; a local one is made only for a local master."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        where = f"file://{tempfile.mkdtemp(prefix='siglane-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system of a path, the path in it)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where
