"""Reading tables and cutting lineage: the few things every plan needs from a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _one_machine(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, else the one already
    set on the context.  Where neither is, a session of one machine gets a new one; on a cluster this raises."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not _one_machine(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="peakloom-")
        context.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Later steps start from files, so a lost executor costs a reread and not a
    recomputation, and rows whose making is not repeatable stay the same.  The tables of a session lie in
    one folder, ``staged-<application>``, which goes when the driver ends, or earlier by ``clear_staged``.
    """
    spark = df.sparkSession
    path = f"{_staging(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def _staging(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/staged-{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> bool:
    """Removes the session's staged tables; DataFrames that read them can no longer be used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def bounded(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` marked for broadcast if a count shows at most ``rows`` rows; otherwise as it is, so that the join
    shuffles and AQE splits skewed keys."""
    return F.broadcast(small) if is_small(small, rows) else small
