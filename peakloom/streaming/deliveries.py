"""Nested deliveries flattened as their files arrive: each file is read once, its rows are appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from peakloom.operators.nested import Flat, flatten

PAYLOADS = "batch_id bigint, run string, received_at timestamp_ntz, payload string"


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Delivery records as a stream of the folder's Parquet files."""
    return spark.readStream.schema(PAYLOADS).parquet(folder)


def flatten_into(stream: DataFrame, spec: Flat, out: str, name: str) -> StreamingQuery:
    """Appends one flat table of all files that are there to ``out``; a later call goes on with new ones.

    The parser is a map, so no state is kept and late records need no watermark.  What has been read
    is noted beside the rows themselves, so a restart goes on where the last run ended.
    """
    rows = flatten(stream, "batch_id", {"payload": ("", ())}, spec)
    progress = f"{out}/_progress-{name}"
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start()
