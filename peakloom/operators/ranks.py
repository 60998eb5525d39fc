"""Exact values at ranks of groups, without sorting a group in one task.

Rows are counted in order-preserving cells (256 per power of two), so the ranks that end
every cell are known from a small table.  A cell that holds a wanted rank and more than
``leaf`` rows of different values is counted again in ``PARTS`` parts between its least and
largest value, and again, until it is small; only then are its values sorted, equal values
counted first.  So what a task sorts is bounded, however close together a group's values
lie, and each further pass reads two columns and moves counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.session import bounded, staged

PARTS = 1024
LEAF = 200_000


def score_cell(x: Column) -> Column:
    """Integer that never falls as a finite x rises; 1,100 exceeds the exponent of the least double."""
    size = F.floor((F.log2(F.abs(x)) + 1100) * 256)
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0)).cast("int")


def _placed(cells: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Asked ranks (keys, rank, tag) with the cell (keys, path, start, n, lo, hi) that each falls into: both laid along the ranks."""
    along = Window.partitionBy(*keys).orderBy("pos", F.col("rank").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    cell = F.struct("path", "start", "n", "lo", "hi")
    both = cells.select(*keys, F.lit(None).cast("long").alias("rank"), F.lit(None).cast(asked.schema["tag"].dataType).alias("tag"), F.col("start").alias("pos"), cell.alias("cell"))
    both = both.unionByName(asked.select(*keys, "rank", "tag", F.col("rank").alias("pos"), F.lit(None).cast(both.schema["cell"].dataType).alias("cell")))
    return both.withColumn("cell", F.last("cell", ignorenulls=True).over(along)).where("rank IS NOT NULL").select("g", "rank", "tag", "cell.*")


def _starts(cells: DataFrame, keys: list[str], first: Column) -> DataFrame:
    up = Window.partitionBy(*keys).orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumn("start", first + F.sum("n").over(up) - F.col("n"))


def at_ranks(rows: DataFrame, asked: Callable[[DataFrame], DataFrame], leaf: int = LEAF) -> DataFrame:
    """(g, rank, tag, value, below, through): the value at each asked rank, counted from 0, of rows (g, x) with finite x and no nulls,
    and how many rows of the group are less, and are not greater.

    asked: from the groups' sizes (g, total) to the wanted (g, rank, tag), ranks within the size; what is asked for comes with its tag.
    """
    rows = rows.select("g", "x", F.array(score_cell(F.col("x"))).alias("path"))
    count = [F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")]
    cells = _starts(rows.groupBy("g", "path").agg(*count), ["g"], F.lit(0))
    ranks = asked(cells.groupBy("g").agg(F.sum("n").alias("total"))).select("g", F.col("rank").cast("long").alias("rank"), "tag")
    targets = staged(_placed(cells, ranks, ["g"]))
    while True:
        hot = targets.where((F.col("n") > leaf) & (F.col("lo") < F.col("hi")))
        if hot.isEmpty():
            break
        parents = hot.select("g", "path", "lo", "hi").distinct()
        part = F.least(F.lit(PARTS - 1), F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PARTS)).cast("int")
        rows = rows.join(bounded(parents), ["g", "path"], "left")
        rows = rows.select("g", "x", F.when(F.col("lo").isNull(), F.col("path")).otherwise(F.concat("path", F.array(part))).alias("path"))
        above = hot.select("g", F.col("path").alias("parent"), F.col("start").alias("first")).distinct()
        cells = rows.withColumn("parent", F.slice("path", 1, F.size("path") - 1)).groupBy("g", "parent", "path").agg(*count)
        cells = _starts(cells.join(bounded(above), ["g", "parent"]), ["g", "parent"], F.col("first"))
        inner = _placed(cells, hot.select("g", F.col("path").alias("parent"), "rank", "tag"), ["g", "parent"])
        targets = staged(targets.where((F.col("n") <= leaf) | (F.col("lo") >= F.col("hi"))).unionByName(inner))
    wanted = targets.select("g", "path", "start").distinct()
    values = rows.join(bounded(wanted), ["g", "path"]).groupBy("g", "path", "start", "x").agg(F.count("*").alias("n"))
    up = Window.partitionBy("g", "path").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("through", F.col("start") + F.sum("n").over(up)).withColumn("below", F.col("through") - F.col("n")).drop("start", "n")
    hit = values.join(targets.select("g", "path", "rank", "tag"), ["g", "path"]).where("rank >= below AND rank < through")
    return hit.select("g", "rank", "tag", F.col("x").alias("value"), "below", "through")
