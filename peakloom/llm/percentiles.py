"""Percentiles per group of very large columns (problem 4).

``percentiles`` is exact: for every group and target rank it holds a value interval,
counts in one pass the rows in each of ``cells`` equal parts of it, and goes on with the
part that holds the rank, shrunk to the least and largest value seen in it, until both
are equal.  A pass reads the group and value columns only, counts before it shuffles, and
moves at most ``cells`` counts per open interval; the number of passes depends on the
spread of the values and not on the number of rows.

``summary`` and ``combined`` do the first pass against a fixed grid of parts whose
borders grow by ``error``: the counts of any two days, partitions or groups can be added,
and a percentile read from them is within ``error`` (relative) of the exact one.

Defined cases: null groups and values that are null, NaN, infinite or negative do not
count; repeated rows count each time; ties share their value; a group without counted
values has no row; percentiles lie between 0 and 100, with linear interpolation between
neighbouring ranks; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.operators.fill import usable
from peakloom.session import bounded, staged

CELLS = 1024
ERROR = 0.01


def _ranks(groups: DataFrame, pcts: list[int]) -> DataFrame:
    """(group, pct, low, high, part): the two ranks, from 0, around each percentile and the share of the second."""
    at = F.col("pct") / 100.0 * (F.col("n") - 1)
    return (
        groups.withColumn("pct", F.explode(F.array(*map(F.lit, pcts))))
        .withColumn("low", F.floor(at))
        .withColumn("high", F.ceil(at))
        .withColumn("part", at - F.floor(at))
    )


def _between(ranks: DataFrame, values: DataFrame) -> DataFrame:
    """(group, pct, value) from (group, rank, value)."""
    first = values.select("group", F.col("rank").alias("low"), F.col("value").alias("v0"))
    second = values.select("group", F.col("rank").alias("high"), F.col("value").alias("v1"))
    return ranks.join(first, ["group", "low"]).join(second, ["group", "high"]).select("group", "pct", (F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("part")).alias("value"))


def percentiles(df: DataFrame, group: Column, value: Column, pcts: list[int], cells: int = CELLS) -> DataFrame:
    """(group, pct, value), exact."""
    rows = df.select(group.alias("group"), value.cast("double").alias("x")).where(F.col("group").isNotNull() & usable(F.col("x")))
    groups = staged(rows.groupBy("group").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    ranks = _ranks(groups, pcts)
    both = ranks.select("group", "lo", "hi", F.explode(F.array("low", "high")).alias("rank")).distinct()
    state = both.select("group", "rank", F.lit(0).cast("long").alias("below"), "lo", "hi")
    done = None
    while True:
        state = staged(state)
        solved = state.where("lo = hi").select("group", "rank", F.col("lo").alias("value"))
        done = solved if done is None else done.unionByName(solved)
        state = state.where("lo < hi")
        if state.isEmpty():
            return _between(ranks, done)
        open_ = state.groupBy("group").agg(F.collect_set(F.struct("lo", "hi")).alias("open"))  # at most two for each percentile
        inside = rows.join(bounded(open_), "group").select("group", "x", F.explode(F.filter("open", lambda i: (F.col("x") >= i.lo) & (F.col("x") <= i.hi))).alias("i"))
        cell = F.least(F.lit(cells - 1), F.floor((F.col("x") - F.col("i.lo")) / (F.col("i.hi") - F.col("i.lo")) * cells))
        counts = inside.groupBy("group", "i.lo", "i.hi", cell.alias("cell")).agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))
        up = Window.partitionBy("group", "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        counts = counts.withColumn("through", F.sum("n").over(up))
        held = (F.col("rank") >= F.col("below") + F.col("through") - F.col("n")) & (F.col("rank") < F.col("below") + F.col("through"))
        state = (
            counts.join(state, ["group", "lo", "hi"])
            .where(held)
            .select("group", "rank", (F.col("below") + F.col("through") - F.col("n")).alias("below"), F.col("least").alias("lo"), F.col("most").alias("hi"))
        )


def summary(df: DataFrame, keys: list[Column], value: Column, error: float = ERROR) -> DataFrame:
    """(*keys, part, n): counts in grid parts, to be added up over whatever keys are later left out."""
    x = value.cast("double")
    part = F.when(x > 0, F.floor(F.log(x) / F.log(F.lit(1 + error))).cast("int"))
    return df.where(usable(x)).groupBy(*keys, part.alias("part")).agg(F.count("*").alias("n"))


def combined(summaries: DataFrame, group: str, pcts: list[int], error: float = ERROR) -> DataFrame:
    """(group, pct, value) from summaries of any number of days, within ``error``; zeros have no part and stay exact."""
    counts = summaries.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("group"), "part").agg(F.sum("n").alias("n"))
    up = Window.partitionBy("group").orderBy(F.asc_nulls_first("part"))
    middle = F.when(F.col("part").isNull(), 0.0).otherwise(F.pow(F.lit(1 + error), F.col("part") + 0.5))
    counts = counts.withColumn("through", F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, 0))).withColumn("middle", middle)
    ranks = _ranks(counts.groupBy("group").agg(F.sum("n").alias("n")), pcts)
    each = ranks.select("group", F.explode(F.array("low", "high")).alias("rank")).distinct()
    held = (F.col("rank") >= F.col("through") - F.col("n")) & (F.col("rank") < F.col("through"))
    values = each.join(counts, "group").where(held).select("group", "rank", F.col("middle").alias("value"))
    return _between(ranks, values)
