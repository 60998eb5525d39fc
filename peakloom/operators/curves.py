"""Survival curves over trace lengths, and where one overtakes another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def survival(traces: DataFrame, length: str, area: str, categories: dict[str, Column], upto: int) -> DataFrame:
    """(index, variable, count, area, mean) for index 0 .. upto - 1: the traces of each
    category at least that long, their summed and their mean area.

    Traces are first summed by length, so what is accumulated has ``upto`` rows a category.
    """
    bucket = F.least(F.col(length), F.lit(upto - 1))
    pick = F.array(*[F.when(c, F.lit(name)) for name, c in categories.items()])
    each = traces.withColumn("variable", F.explode(F.filter(pick, lambda v: v.isNotNull())))
    sums = each.groupBy("variable", bucket.alias("index")).agg(F.count("*").alias("n"), F.sum(area).alias("s"))
    spine = _spine(traces.sparkSession, list(categories), upto)
    longer = Window.partitionBy("variable").orderBy(F.desc("index")).rowsBetween(Window.unboundedPreceding, 0)
    full = spine.join(sums, ["variable", "index"], "left")
    full = full.withColumn("count", F.coalesce(F.sum("n").over(longer), F.lit(0))).withColumn("area", F.coalesce(F.sum("s").over(longer), F.lit(0.0)))
    return full.select("index", "variable", "count", "area", F.try_divide("area", "count").alias("mean"))


def _spine(spark: SparkSession, names: list[str], upto: int) -> DataFrame:
    return spark.range(upto).select(F.col("id").cast("int").alias("index"), F.explode(F.array(*map(F.lit, names))).alias("variable"))


def tradeoff(curve: DataFrame, value: str, over: str, under: str) -> DataFrame:
    """(tradeoff): first index at which ``over`` exceeds ``under``; null for none or for the very first."""
    pick = lambda name: F.max(F.when(F.col("variable") == name, F.col(value)))
    wide = curve.groupBy("index").agg(pick(over).alias("a"), pick(under).alias("b"))
    return wide.agg(F.nullif(F.min(F.when(F.col("a") > F.col("b"), F.col("index"))), F.lit(0)).alias("tradeoff"))
