"""Points in intervals: an equi-join on keys and bins instead of a nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BINS = 64


def in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, low: str, high: str, width: float) -> DataFrame:
    """Columns of both sides for every point with low <= at <= high and equal keys.

    A point lies in one bin and an interval in all bins it touches, so every pair meets
    once.  An interval of more than ``MOST_BINS`` bins goes to bins of a coarser grid
    (``MOST_BINS`` times as wide at each level), which the points join as well.
    """
    span = (F.col(high) - F.col(low)) / (width * MOST_BINS)
    levelled = intervals.where(F.col(low) <= F.col(high)).withColumn("_level", F.when(span <= 1, 0).otherwise(F.ceil(F.log(span) / F.log(F.lit(float(MOST_BINS))))).cast("int"))
    levels = sorted(levelled.agg(F.collect_set("_level")).first()[0]) or [0]  # few: a double's exponent is bounded
    size = width * F.pow(F.lit(float(MOST_BINS)), F.col("_level"))
    binned = levelled.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))))
    single = points.where(F.col(at).isNotNull()).withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn("_bin", F.floor(F.col(at) / size))
    return single.join(binned, [*keys, "_level", "_bin"]).where((F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))).drop("_level", "_bin")
