"""Retention times of runs brought onto one run's scale: monotone, piecewise linear between anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakloom.operators.intervals import in_intervals
from peakloom.session import bounded, staged


def segments(anchors: DataFrame) -> DataFrame:
    """(run, x, y, x2, y2): pieces between neighbouring anchors (run, x, y), x2 and y2 null at a run's last.

    Anchors of one time count as their mean; the mapped times are made monotone by a running maximum.
    """
    one = anchors.where("x IS NOT NULL AND y IS NOT NULL").groupBy("run", "x").agg(F.avg("y").alias("y"))
    along = Window.partitionBy("run").orderBy("x")
    mono = one.withColumn("y", F.max("y").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return mono.select("run", "x", "y", F.lead("x").over(along).alias("x2"), F.lead("y").over(along).alias("y2"))


def aligned(rows: DataFrame, at: str, anchors: DataFrame, width: float = 60.0) -> DataFrame:
    """Rows (run, ...) with ``aligned``, their time ``at`` on the scale of the anchors' y: linear between two anchors, shifted before a
    run's first and after its last, unchanged in a run without any, null where the time is.

    Times meet the pieces in bins of ``width``, so a run that holds a third of all rows is spread over the tasks.
    """
    pieces = staged(segments(anchors))
    ends = pieces.groupBy("run").agg(F.min("x").alias("_x0"), F.min_by("y", "x").alias("_y0"), F.max("x").alias("_x1"), F.max_by("y", "x").alias("_y1"))
    known = rows.join(bounded(ends), "run", "left")
    t = F.nanvl(F.col(at).cast("double"), F.lit(None).cast("double"))
    outside = F.when(F.col("_x0").isNull(), t).when(t <= F.col("_x0"), F.col("_y0") + (t - F.col("_x0"))).when(t >= F.col("_x1"), F.col("_y1") + (t - F.col("_x1")))
    inner = F.coalesce((t > F.col("_x0")) & (t < F.col("_x1")), F.lit(False))
    out = known.where(~inner).select(*rows.columns, outside.alias("aligned"))
    spans = pieces.where("x2 IS NOT NULL").select("run", *[F.col(c).alias(f"_{c}") for c in ("x", "y", "x2", "y2")])
    met = in_intervals(known.where(inner), spans, ["run"], at, "_x", "_x2", width).where(F.col(at) < F.col("_x2"))
    slope = (F.col("_y2") - F.col("_y")) / (F.col("_x2") - F.col("_x"))
    return out.unionByName(met.select(*rows.columns, (F.col("_y") + (F.col(at) - F.col("_x")) * slope).alias("aligned")))
