"""Exact quantiles per group, linear between neighbouring ranks; no task sorts a group (``ranks``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.operators.ranks import LEAF, at_ranks


def quantiles(df: DataFrame, group: str, value: str, qs: list[float], leaf: int = LEAF) -> DataFrame:
    """(group, q, value); nulls, NaN and infinite values do not count."""
    x = F.col(value).cast("double")
    rows = df.select(F.col(group).alias("g"), x.alias("x")).where(F.col("g").isNotNull() & (F.abs("x") < float("inf")))

    def asked(totals: DataFrame) -> DataFrame:
        each = totals.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))).withColumn("at", F.col("q") * (F.col("total") - 1))
        low, high = F.floor("at"), F.ceil("at")
        return each.select("g", F.explode(F.array_distinct(F.array(low, high))).alias("rank"), F.struct("q", "at", low.alias("low"), high.alias("high")).alias("tag"))

    found = at_ranks(rows, asked, leaf).groupBy("g", "tag")
    at = lambda n: F.max(F.when(F.col("rank") == F.col(f"tag.{n}"), F.col("value"))).alias(n)
    both = found.agg(at("low"), at("high"))
    return both.select(F.col("g").alias(group), "tag.q", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("tag.at") - F.col("tag.low"))).alias("value"))
