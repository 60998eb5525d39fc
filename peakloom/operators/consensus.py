"""Consensus elements: lookup, coverage, bounds, the wide table, and linking across runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.functions.expr import SEPARATOR
from peakloom.operators.rounds import REACH
from peakloom.operators.rounds import linked as linked_strip
from peakloom.session import bounded, staged

# The columns per run of the full wide table; the reduced one has the first seven, the minimal one four.
FULL = (
    "intensity", "l_pep_ident", "l_raw_pep_ident", "l_prot_ident", "openms_fid", "charge", "l_ms2_scans",
    "l_mz_start", "l_mz_end", "l_rt_start", "l_rt_end", "l_retention_times", "l_mass_to_charges", "l_intensities",
)
REDUCED = FULL[:7]
MINIMAL = ("intensity", "openms_fid", "charge", "l_ms2_scans")

ROUNDS = 8  # rounds of linking in a pass
STRIP_ROWS = 50_000  # features a task links at a time


def winners(edges: DataFrame, features: DataFrame) -> DataFrame:
    """(ceid, run, feature_id, rec_id): one feature (run, feature_id, rec_id) per element and run, the one with the smallest id."""
    joined = edges.select("ceid", "run", "feature_id").distinct().join(features.select("run", "feature_id", "rec_id"), ["run", "feature_id"])
    return joined.groupBy("ceid", "run").agg(F.min(F.struct("feature_id", "rec_id")).alias("f")).select("ceid", "run", "f.feature_id", "f.rec_id")


def looked_up(edges: DataFrame, features: DataFrame) -> DataFrame:
    """(ceid, feature columns) of every winner; ``rec_id`` identifies a feature, and only ids are compared before the columns are joined."""
    return winners(edges, features).select("ceid", "rec_id").join(features, "rec_id")


def dangling(edges: DataFrame, features: DataFrame) -> DataFrame:
    """(ceid, run, feature_id): edges to features that are not there."""
    return edges.select("ceid", "run", "feature_id").distinct().join(features.select("run", "feature_id"), ["run", "feature_id"], "left_anti").select("ceid", "run", "feature_id")


def uncovered(features: DataFrame, edges: DataFrame) -> DataFrame:
    """Features that no element refers to."""
    return features.join(edges.select("run", "feature_id").distinct(), ["run", "feature_id"], "left_anti")


def wide(long: DataFrame, key: str, runs: list[str], headers: list[str], more: tuple[Column, ...] = ()) -> DataFrame:
    """One row per key; columns ``run_____header``, by header and then run; nulls where a run lacks the element.
    ``long`` has one row per key and run, as ``looked_up`` gives.  more: aggregates taken along.

    The width is runs x headers, so ``runs`` must be a list that fits a schema; the long
    table is the form for more.
    """
    one = long.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("run", F.struct(*headers)))).alias("by_run"), *more)  # at most one row a run
    return one.select(key, *[F.col("by_run")[r][h].alias(f"{r}{SEPARATOR}{h}") for h in headers for r in sorted(runs)], *[c for c in one.columns if c not in (key, "by_run")])


def bound_columns() -> tuple[Column, ...]:
    """Aggregates of an element: outer m/z and retention-time bounds of first isotopes and of all."""
    low, high = lambda c: F.min(F.get(c, F.lit(0))), lambda c: F.max(F.get(c, F.lit(0)))
    return (
        low("mz_starts").alias("first_iso_global_min_mz"), high("mz_ends").alias("first_iso_global_max_mz"),
        low("rt_starts").alias("first_iso_global_min_rt"), high("rt_ends").alias("first_iso_global_max_rt"),
        F.min(F.array_min("mz_starts")).alias("feature_global_min_mz"), F.max(F.array_max("mz_ends")).alias("feature_global_max_mz"),
        F.min(F.array_min("rt_starts")).alias("feature_global_min_rt"), F.max(F.array_max("rt_ends")).alias("feature_global_max_rt"),
    )


def bounds(long: DataFrame) -> DataFrame:
    return long.groupBy("ceid").agg(*bound_columns())


def linked(features: DataFrame, reference: DataFrame, ppm: float, rt_window: float) -> DataFrame:
    """(feat_id, ref_id, run): features linked to a reference feature of the same charge when
    each is the other's nearest within the m/z tolerance and the time window.

    Both are (feat_id, run, charge, mz, rt).  Candidates meet in bins of time and of the
    logarithm of m/z, in which a relative tolerance has one width.
    """
    width = 2e-6 * ppm
    cell = lambda df: df.withColumn("_t", F.floor(F.col("rt") / rt_window)).withColumn("_m", F.floor(F.log("mz") / width))
    near = lambda c: F.explode(F.array(*[F.col(c) + k for k in (-1, 0, 1)]))
    right = cell(reference.select(F.col("feat_id").alias("ref_id"), "charge", F.col("mz").alias("ref_mz"), F.col("rt").alias("ref_rt"), "mz", "rt"))
    right = right.withColumn("_t", near("_t")).withColumn("_m", near("_m")).drop("mz", "rt")
    pairs = cell(features).join(right, ["charge", "_t", "_m"]).where((F.abs(F.col("mz") - F.col("ref_mz")) <= F.col("ref_mz") * (ppm * 1e-6)) & (F.abs(F.col("rt") - F.col("ref_rt")) <= rt_window))
    gap = F.abs(F.col("mz") - F.col("ref_mz")) / F.col("ref_mz") / (ppm * 1e-6) + F.abs(F.col("rt") - F.col("ref_rt")) / rt_window
    pairs = pairs.withColumn("gap", gap)
    mine = Window.partitionBy("run", "feat_id").orderBy("gap", "ref_id")
    theirs = Window.partitionBy("ref_id", "run").orderBy("gap", "feat_id")
    ranked = pairs.withColumn("_a", F.row_number().over(mine)).withColumn("_b", F.row_number().over(theirs))
    return ranked.where("_a = 1 AND _b = 1").select("feat_id", "ref_id", "run")


def _stripped(left: DataFrame, halo: int, rows: int) -> DataFrame:
    """``left`` by ``strip``: stretches of the m/z cells of a charge, each of some ``rows`` features of its ``own`` and with all others that lie
    within ``halo`` cells of them.  A strip is made of whole blocks of two halos, so a feature goes into two strips at most."""
    block = 2 * halo
    left = left.withColumn("_b", F.expr(f"_m - pmod(_m, {block})"))
    along = Window.partitionBy("charge").orderBy("_b")  # the blocks of a charge: as many as its m/z range has
    blocks = left.groupBy("charge", "_b").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(along) - F.col("n")).withColumn("strip", F.expr(f"before div {rows}"))
    beside = lambda c, d: F.when(c("_b").over(along) == F.col("_b") + d, c("strip").over(along))
    blocks = blocks.select("charge", "_b", "strip", beside(F.lag, -block).alias("low"), beside(F.lead, block).alias("high"))
    other = F.when(F.expr(f"pmod(_m, {block})") < halo, F.col("low")).otherwise(F.col("high"))
    own, lent = F.struct(F.col("strip"), F.lit(True).alias("own")), F.struct(other.alias("strip"), F.lit(False).alias("own"))
    copies = F.explode(F.when(other != F.col("strip"), F.array(own, lent)).otherwise(F.array(own)))
    return left.join(bounded(blocks), ["charge", "_b"]).select(*[c for c in left.columns if c != "_b"], copies.alias("_s")).select("*", "_s.*").drop("_s")


def elements(features: DataFrame, ppm: float, rt_window: float, rounds: int = ROUNDS, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """(run, feat_id, seed_run, seed_id): every feature (feat_id, run, nth: place of the run in order, charge, mz, rt) in one consensus
    element, named by its seed, with at most one feature of a run.

    In each round the seeds are the features of the earliest run that has any left around them (in the cells of time and of
    the logarithm of m/z next to theirs), so all regions go on at once; features of other runs join the seed when each is the other's
    nearest within the tolerances.  The rest goes to the next round, at most as many as there are runs.

    A round looks no further than ``rounds.REACH`` cells, so a strip of m/z that also has the features around it goes through ``rounds`` rounds
    by itself, in one task.  What is then left goes to the next pass; each pass is one shuffle and is written down.
    """
    width = 2e-6 * ppm
    names = ["run", "feat_id", "nth", "charge", "mz", "rt"]
    left = staged(features.select(*names, F.floor(F.col("rt") / rt_window).alias("_t"), F.floor(F.log("mz") / width).alias("_m")))
    ids = {f.name: f.dataType for f in left.schema}
    schema = T.StructType([*left.schema, T.StructField("seed_run", ids["run"]), T.StructField("seed_id", ids["feat_id"]), T.StructField("found", T.BooleanType())])
    done = None
    while done is None or not left.isEmpty():
        strips = _stripped(left, REACH * rounds, strip_rows).groupBy("charge", "strip")
        passed = staged(strips.applyInArrow(lambda strip: linked_strip(strip, ppm, rt_window, rounds), schema))
        members = passed.where("found").select("run", "feat_id", "seed_run", "seed_id")
        done = members if done is None else done.unionByName(members)
        left = passed.where("NOT found").select(*left.columns)
    return done
