"""Extracted ion chromatograms: queries from features, points in their boxes, and the quantified row made of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.functions import expr
from peakloom.operators.intervals import in_intervals

# The columns of a query and of a quantified feature, in the order of their files.
QUERY = ("identifier", "mz_start", "mz_end", "rt_start", "rt_end", "mz", "ppm", "ms_level", "charge", "pep_idents", "raw_pep_idents", "prot_idents", "ms2_scans")
QUANTIFIED = (
    "openms_fid", "intensity", "charge", "l_pep_ident", "l_raw_pep_ident", "l_prot_ident", "l_mz_start", "l_mz_end",
    "l_rt_start", "l_rt_end", "l_retention_times", "l_mass_to_charges", "l_intensities", "l_ms2_scans",
)


def ident_lists(psms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pep_idents, raw_pep_idents, prot_idents): parallel lists in order of ``psm_id``, of psms (keys, psm_id, plain_peptide,
    raw_peptide, proteins) that name each peptide once."""
    one = psms.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("psm_id", "plain_peptide", "raw_peptide", "proteins"))).alias("p"))
    return one.select(*keys, F.col("p.plain_peptide").alias("pep_idents"), F.col("p.raw_peptide").alias("raw_pep_idents"), F.col("p.proteins").alias("prot_idents"))


def queries(features: DataFrame, idents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, iso_pos, *QUERY): one query for each window of features (keys, identifier, charge, ms2_scans, windows: list of (iso_pos,
    mz_start, mz_end, rt_start, rt_end in seconds)); times come out in minutes, m/z and tolerance stay empty as the box gives them."""
    each = features.select(*keys, "identifier", "charge", "ms2_scans", F.explode("windows").alias("w")).join(idents, keys, "left")
    lists = [F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("pep_idents", "raw_pep_idents", "prot_idents")]
    none = lambda c: F.lit(None).cast("double").alias(c)
    rows = each.select(
        *keys, "w.iso_pos", "identifier", "w.mz_start", "w.mz_end", (F.col("w.rt_start") / 60).alias("rt_start"), (F.col("w.rt_end") / 60).alias("rt_end"),
        none("mz"), none("ppm"), F.lit("ms").alias("ms_level"), "charge", *lists, "ms2_scans",
    )
    return rows.select(*keys, "iso_pos", *QUERY)


def extracted(peaks: DataFrame, boxes: DataFrame, keys: list[str], how: str = "sum", bin_ppm: float = 10.0) -> DataFrame:
    """(keys, retention_times, mass_to_charge, intensities): for each box (keys, run, mz_start, mz_end, rt_start, rt_end) the
    points of its run inside it, in order of time; points of one time become one, their intensities summed (or the largest
    taken), at the m/z of the most intense.  Peaks are (run, rt, mz, intensity); a box without points has empty lists.

    Peaks and boxes meet in bins of the logarithm of m/z, in which a relative tolerance has one width.
    """
    if how not in ("sum", "max"):
        raise ValueError(f"points of a scan are added or the largest is taken: {how}")
    log_mz = lambda c: F.log(c) * 1e6
    box = boxes.select(*keys, "run", "mz_start", "mz_end", "rt_start", "rt_end", (log_mz(F.col("mz_start")) - 1e-3).alias("_low"), (log_mz(F.col("mz_end")) + 1e-3).alias("_high"))
    points = peaks.where("mz > 0").select("run", "rt", "mz", "intensity", log_mz(F.col("mz")).alias("_at"))
    hit = in_intervals(points, box, ["run"], "_at", "_low", "_high", bin_ppm)
    hit = hit.where("mz BETWEEN mz_start AND mz_end AND rt BETWEEN rt_start AND rt_end")
    scans = hit.groupBy(*keys, "rt").agg((F.sum if how == "sum" else F.max)("intensity").alias("intensity"), F.max_by("mz", F.struct("intensity", "mz")).alias("mz"))
    lists = scans.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rt", "mz", "intensity"))).alias("p"))
    some = lambda c: F.coalesce(F.col(f"p.{c}"), F.array().cast("array<double>"))
    return boxes.select(*keys).join(lists, keys, "left").select(*keys, some("rt").alias("retention_times"), some("mz").alias("mass_to_charge"), some("intensity").alias("intensities"))


def quantified(queries: DataFrame, arrays: DataFrame, keys: list[str], method: str) -> DataFrame:
    """(keys, *QUANTIFIED): one row per feature from its queries and their arrays (keys, iso_pos, retention_times, mass_to_charge,
    intensities), isotopes in order; its intensity is the roll-up of the traces' areas.  Times come out in seconds."""
    both = queries.join(arrays, [*keys, "iso_pos"], "left")
    empty = lambda c: F.coalesce(c, F.array().cast("array<double>")).alias(c)
    heads = ("identifier", "charge", "pep_idents", "raw_pep_idents", "prot_idents", "ms2_scans")
    windows = ("mz_start", "mz_end", "rt_start", "rt_end")
    iso = F.struct("iso_pos", *windows, *(empty(c) for c in ("retention_times", "mass_to_charge", "intensities")), F.struct(*heads).alias("head"))
    one = both.select(*keys, iso.alias("iso")).groupBy(*keys).agg(F.sort_array(F.collect_list("iso")).alias("iso"))  # a feature has a few isotopes

    def area(i: Column) -> Column:
        return expr.trapezoid(F.arrays_zip(i["retention_times"].alias("x"), i["intensities"].alias("y")), "x", "y")

    head = F.get("iso", F.lit(0))["head"]
    seconds = lambda c: F.transform(F.col(f"iso.{c}"), lambda x: x * 60)
    text = lambda c: F.col(f"iso.{c}").cast("array<string>")
    columns = (
        head["identifier"], expr.rollup(F.transform("iso", area), method), head["charge"], head["pep_idents"], head["raw_pep_idents"], head["prot_idents"], text("mz_start"), text("mz_end"),
        seconds("rt_start"), seconds("rt_end"), F.col("iso.retention_times"), F.col("iso.mass_to_charge"), F.col("iso.intensities"), head["ms2_scans"],
    )
    return one.select(*keys, *[c.alias(name) for c, name in zip(columns, QUANTIFIED)])
