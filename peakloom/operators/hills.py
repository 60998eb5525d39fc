"""Features with their hills: a lookup that must match, regrouped in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.functions import expr


def with_hills(features: DataFrame, hills: DataFrame, keys: list[str], hull_ppm: float = 5.0) -> DataFrame:
    """(keys, mz, hulls): features (keys, run, hills: list of ids, the monoisotopic one first) with a box for each hill of hills
    (run, hill_idx, rt_start, rt_end in minutes, mz_values): its times in seconds, its median m/z less and plus the tolerance.  The
    feature's m/z is its first hill's.  A hill that is not there raises."""
    each = features.select(*keys, "run", F.posexplode("hills").alias("pos", "hill_idx"))
    mid = expr.array_median(F.col("mz_values"))
    known = hills.select("run", "hill_idx", (F.col("rt_start") * 60).alias("rt_start"), (F.col("rt_end") * 60).alias("rt_end"), mid.alias("mid"), F.lit(True).alias("there"))
    met = each.join(known, ["run", "hill_idx"], "left")
    missing = F.raise_error(F.concat(F.lit("no hill "), F.coalesce(F.col("hill_idx").cast("string"), F.lit("null")), F.lit(" in run "), F.col("run")))
    half = expr.ppm(F.col("mid"), hull_ppm)
    hull = F.when(F.col("there"), F.struct("pos", "hill_idx", "rt_start", "rt_end", (F.col("mid") - half).alias("mz_start"), (F.col("mid") + half).alias("mz_end"), "mid")).otherwise(missing)
    one = met.groupBy(*keys).agg(F.sort_array(F.collect_list(hull)).alias("h"))
    return one.select(*keys, F.get("h", F.lit(0))["mid"].alias("mz"), F.transform("h", lambda x: x.dropFields("mid")).alias("hulls"))
