"""Identifications onto features: scans in windows, scan lists, first-wins lists, leftovers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakloom.functions.expr import ppm
from peakloom.operators.intervals import in_intervals

HULL_PPM = 5.0  # half width of a hull, independent of the scans' tolerance


def boxes(features: DataFrame, enlarge: float, hull_ppm: float = HULL_PPM) -> DataFrame:
    """Features (run, feat_id, charge, mz, a, b in seconds) with the enlarged window and m/z bounds."""
    a, b = F.least("a", "b"), F.greatest("a", "b")
    grow = (b - a) * enlarge
    return features.withColumn("rt_low", a - grow).withColumn("rt_high", b + grow).withColumn("mz_low", F.col("mz") - ppm(F.col("mz"), hull_ppm)).withColumn("mz_high", F.col("mz") + ppm(F.col("mz"), hull_ppm))


def scans_in_boxes(scans: DataFrame, features: DataFrame, tolerance_ppm: float, width: float = 30.0) -> DataFrame:
    """(run, feat_id, ordinal, scan): every scan (run, charge, rt, scan_mz, ordinal, scan) in a
    box of its charge, one row for each box it lies in; all bounds belong to the box."""
    hit = in_intervals(scans, features, ["run", "charge"], "rt", "rt_low", "rt_high", width)
    tol = ppm(F.col("scan_mz"), tolerance_ppm)
    hit = hit.where((F.col("mz_high") >= F.col("scan_mz") - tol) & (F.col("scan_mz") + tol >= F.col("mz_low")))
    return hit.select("run", "feat_id", "ordinal", "scan")


def scan_lists(features: DataFrame, hits: DataFrame) -> DataFrame:
    """Every feature with its scans in order of their ordinals; an empty list where there are none."""
    lists = hits.groupBy("run", "feat_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "scan"))).alias("s"))
    return features.select("run", "feat_id").join(lists, ["run", "feat_id"], "left").select("run", "feat_id", F.coalesce(F.transform("s", lambda x: x.scan), F.array()).alias("ms2_scans"))


def attached(features: DataFrame, psms: DataFrame) -> DataFrame:
    """PSMs (run, fdr, scan, ...) of each feature (run, fdr, rec_id, ms2_scans): a scan counts once however often it is listed."""
    each = features.select("run", "fdr", "rec_id", F.explode(F.array_distinct("ms2_scans")).alias("scan"))
    return each.join(psms, ["run", "fdr", "scan"])


def first_wins(rows: DataFrame, group: list[str], key: str, order: list[str]) -> DataFrame:
    """First row of each key within a group."""
    w = Window.partitionBy(*group, key).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def run_groups(rows: DataFrame, part: str, order: str, value: str, chunk: int = 1_000_000) -> DataFrame:
    """Rows numbered by stretches of equal neighbouring values, in the order of an integer column.

    Stretches are counted within chunks of the order and carried on from one chunk to the
    next by a table of one row a chunk, so that no task holds a whole part.
    """
    rows = rows.withColumn("_chunk", F.floor(F.col(order) / chunk))
    keys = [part, "_chunk"]
    inside = Window.partitionBy(*keys).orderBy(order)
    # the first row of a chunk starts no stretch here; whether it does depends on the chunk before
    starts = F.when(F.row_number().over(inside) == 1, 0).otherwise((~F.lag(value).over(inside).eqNullSafe(F.col(value))).cast("int"))
    marked = rows.withColumn("_start", starts)
    ends = marked.groupBy(*keys).agg(F.min_by(F.struct(value), order).alias("first"), F.max_by(F.struct(value), order).alias("last"), F.sum("_start").alias("inner"))
    chunks = Window.partitionBy(part).orderBy("_chunk")
    begins = F.when(F.lag("last").over(chunks).eqNullSafe(F.col("first")), 0).otherwise(1)
    ends = ends.withColumn("begins", begins).withColumn("before", F.sum(F.col("begins") + F.col("inner")).over(chunks.rowsBetween(Window.unboundedPreceding, 0)) - F.col("inner"))
    counted = marked.withColumn("_in", F.sum("_start").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    joined = counted.join(ends.select(*(F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)), "before"), F.col(part).eqNullSafe(F.col("_k0")) & F.col("_chunk").eqNullSafe(F.col("_k1")))
    return joined.withColumn("stretch", F.col("before") + F.col("_in")).drop("_chunk", "_start", "_in", "before", "_k0", "_k1")
