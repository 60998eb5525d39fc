"""The quantification workflow's steps as queries over the test tables, each with its SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peakloom.functions import expr
from peakloom.operators import consensus, curves, idents
from peakloom.operators.fill import usable
from peakloom.operators.nested import flatten
from peakloom.operators.intervals import in_intervals
from peakloom.operators.quantiles import quantiles
from peakloom.plans.quant_sql import SQL  # noqa: F401
from peakloom.plans.records import POINTS, TRACES
from peakloom.session import bounded, table

QS = [k / 100 for k in range(101)]
CURVE_QS = np.linspace(0, 1, 1000).tolist()  # the points of the workflow's own cutoff plot
UPTO = 100
SHOWN = 100


def exported_points(spark: SparkSession, sf: str, nested: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    cells = {c: (f"features[].{c}", (0,)) for c in TRACES}
    return flatten(table(spark, sf, "feature_tsv"), "rec_id", cells, POINTS, nested, carry=carry)


def traces(spark: SparkSession, sf: str) -> DataFrame:
    """(rec_id, iso_pos, retention_time, mass_to_charge, intensity) with lists in order of position."""
    return exported_points(spark, sf, nested=1)


def areas(spark: SparkSession, sf: str) -> DataFrame:
    return traces(spark, sf).select("rec_id", "iso_pos", F.size("intensity").alias("n"), _area("retention_time", "intensity").alias("auc"))


def _area(x: str | Column, y: str | Column) -> Column:
    return expr.trapezoid(F.arrays_zip(F.col(x).alias("x") if isinstance(x, str) else x.alias("x"), F.col(y).alias("y") if isinstance(y, str) else y.alias("y")), "x", "y")


def record_areas(spark: SparkSession, sf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(rec_id, traces (n, auc) of its isotopes in order, carried columns): a record's isotopes lie in its own row."""
    rows = exported_points(spark, sf, nested=2, carry=carry)
    each = F.transform(F.arrays_zip("retention_time", "intensity"), lambda t: F.struct(F.size(t.intensity).alias("n"), _area(t.retention_time, t.intensity).alias("auc")))
    return rows.select("rec_id", each.alias("traces"), *carry)


def trapz_auc_hof(spark, sf):
    """Area of every isotope trace, folded over its array."""
    return areas(spark, sf).select("rec_id", "iso_pos", F.col("n").cast("long").alias("n"), F.round("auc", 6).alias("auc"))


def trapz_auc_window(spark, sf):
    """The same from neighbouring rows, for traces too long for an array."""
    w = Window.partitionBy("rec_id", "iso_pos").orderBy("point_pos")
    lag = lambda c: F.lag(c).over(w)
    part = (F.col("retention_time") - lag("retention_time")) * (F.col("intensity") + lag("intensity")) / 2
    rows = exported_points(spark, sf).withColumn("part", F.coalesce(part, F.lit(0.0)))
    return rows.groupBy("rec_id", "iso_pos").agg(F.count("*").alias("n"), F.round(F.sum("part"), 6).alias("auc"))


def intensity_rollup(spark, sf):
    """One intensity per feature from its traces' areas, by each method."""
    return record_areas(spark, sf).select("rec_id", *[F.round(expr.rollup(F.col("traces.auc"), m), 6).alias(m) for m in expr.METHODS])


def hull_boxes(spark, sf):
    """Bounds and median m/z of every trace, m/z widened by the hull's tolerance."""
    low, high = F.array_min, F.array_max
    mid = expr.array_median(F.col("mass_to_charge"))
    half = expr.ppm(mid, idents.HULL_PPM)
    r = lambda c, n: F.round(c, 5).alias(n)
    return traces(spark, sf).select("rec_id", "iso_pos", r(low("retention_time"), "rt_start"), r(high("retention_time"), "rt_end"), r(mid, "mz_median"), r(mid - half, "mz_start"), r(mid + half, "mz_end"))


def first_delivered(df: DataFrame, keys: list[str], at: str = "loaded_at") -> DataFrame:
    """Rows delivered more than once as they came first."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(F.col(at).isNull(), at)).alias("first")).select(*keys, "first.*")


def _features(spark, sf, *columns):
    """Detected features once each, with the columns wanted."""
    return first_delivered(table(spark, sf, "detected_features").select("run", "feat_id", *columns, "loaded_at"), ["run", "feat_id"]).drop("loaded_at")


def feature_hills(spark, sf):
    """Hills of every feature: its monoisotopic one at position 0, then its isotopes in order."""
    hills = F.concat(F.array("monoisotope_hill_idx"), F.coalesce(expr.hill_list(F.col("isotopes")), F.array().cast("array<bigint>")))
    return _features(spark, sf, "monoisotope_hill_idx", "isotopes").select("run", "feat_id", F.posexplode(hills).alias("pos", "hill_idx"))


def cutoff_filter_t(spark, sf):
    """Features at or above an absolute cutoff, with the share of their run at or below it."""
    kind, at = expr.cutoff_spec("t1000000")
    rows = _features(spark, sf, "intensitysum").where(usable(F.col("intensitysum")))
    return rows.groupBy("run").agg(F.count_if(F.col("intensitysum") >= at).alias("kept"), F.round(F.avg((F.col("intensitysum") <= at).cast("int")), 9).alias("q_cutoff"))


def cutoff_filter_q(spark, sf):
    """Features at or above a quantile of their run."""
    kind, q = expr.cutoff_spec("q0.05")
    rows = _features(spark, sf, "intensitysum").where(usable(F.col("intensitysum"))).select("run", "feat_id", "intensitysum")
    cut = quantiles(rows, "run", "intensitysum", [q]).select("run", F.col("value").alias("cutoff"))
    return rows.join(cut, "run").where("intensitysum >= cutoff").select("run", "feat_id")


def cutoff_curve(spark, sf):
    """Intensity at 101 quantiles of every run."""
    rows = _features(spark, sf, "intensitysum").where(usable(F.col("intensitysum")))
    return quantiles(rows, "run", "intensitysum", QS).select("run", "q", F.round("value", 6).alias("intensity"))


def cutoff_curve_1000(spark, sf):
    """Intensity at the 1,000 quantiles of every run that the workflow plots."""
    rows = _features(spark, sf, "intensitysum").where(usable(F.col("intensitysum")))
    return quantiles(rows, "run", "intensitysum", CURVE_QS).select("run", "q", F.round("value", 6).alias("intensity"))


def _psms(spark, sf):
    return first_delivered(table(spark, sf, "identifications"), ["psm_id"])


def _boxes(spark, sf):
    # where a run repeats an id, all its copies are equal but for their arrival
    f = _features(spark, sf, "charge", "mz", "rtstart", "rtend").where("rtstart IS NOT NULL AND rtend IS NOT NULL AND charge IS NOT NULL")
    return idents.boxes(f.select("run", "feat_id", "charge", "mz", (F.col("rtstart") * 60).alias("a"), (F.col("rtend") * 60).alias("b")), 0.5)


def _scans(spark, sf):
    p = _psms(spark, sf).where("retention_time IS NOT NULL")
    return p.select("run", "charge", F.col("retention_time").alias("rt"), F.col("exp_mass_to_charge").alias("scan_mz"), F.col("psm_id").alias("ordinal"), "scan")


def interval_join_ms2(spark, sf):
    """Scans in the enlarged box of a feature of their charge."""
    return idents.scans_in_boxes(_scans(spark, sf), _boxes(spark, sf), 5.0).select("run", "feat_id", "ordinal", "scan")


def feature_scan_lists(spark, sf):
    """Every feature that has a box, with its scans in order; none is an empty list."""
    boxes = _boxes(spark, sf)
    lists = idents.scan_lists(boxes, idents.scans_in_boxes(_scans(spark, sf), boxes, 5.0))
    return lists.select("run", "feat_id", F.concat_ws(",", F.col("ms2_scans").cast("array<string>")).alias("scans"))


def _exported(spark, sf):
    return table(spark, sf, "feature_tsv").withColumn("ms2_scans", expr.int_list(F.col("l_ms2_scans"))).withColumn("feature_id", F.col("openms_fid"))


def _attached(spark, sf):
    psms = _psms(spark, sf).withColumn("scan", F.col("scan").cast("long")).withColumn("raw_peptide", F.coalesce("peptide_seq", "modified_peptide")).withColumn("proteins", F.coalesce("fasta_acc", "fasta_desc"))
    return idents.attached(_exported(spark, sf), psms.select("run", "fdr", "scan", "psm_id", "plain_peptide", "raw_peptide", "proteins"))


def psm_in_scan_list(spark, sf):
    """PSMs of every exported feature by its scan list."""
    return _attached(spark, sf).select("rec_id", "psm_id")


def first_wins_peptides(spark, sf):
    """Per feature the first PSM of each peptide."""
    rows = idents.first_wins(_attached(spark, sf), ["rec_id"], "plain_peptide", ["psm_id"])
    return rows.select("rec_id", "psm_id", "plain_peptide", "raw_peptide", "proteins")


def unassigned_psms(spark, sf):
    """PSMs on no feature at or above the cutoff."""
    kept = _attached(spark, sf).join(_exported(spark, sf).where(usable(F.col("intensity")) & (F.col("intensity") >= 10000)).select("rec_id"), "rec_id", "left_semi")
    return _psms(spark, sf).join(kept, "psm_id", "left_anti").select("psm_id", "run", "fdr")


def run_length_groups(spark, sf):
    """Stretches of PSMs of one charge in file order within a run."""
    rows = idents.run_groups(_psms(spark, sf).select("run", "psm_id", "charge"), "run", "psm_id", "charge")
    return rows.groupBy("run", "stretch", "charge").agg(F.count("*").alias("n"), F.min("psm_id").alias("first_psm"))


WINDOW_LISTS = {"mz_starts": "l_mz_start", "mz_ends": "l_mz_end", "rt_starts": "l_rt_start", "rt_ends": "l_rt_end"}


def windows() -> Column:
    """List of (iso_pos, mz_start, mz_end, rt_start, rt_end) from a record's four window cells; null if one of them is no list."""
    names = ("mz_start", "mz_end", "rt_start", "rt_end")
    lists = [expr.number_list(F.col(c)).alias(n) for n, c in zip(names, WINDOW_LISTS.values())]
    return F.transform(F.arrays_zip(*lists), lambda w, k: F.struct(k.alias("iso_pos"), *[w[n].alias(n) for n in names]))


def _long(spark, sf, headers=()):
    """The feature of each element in each run: windows, whether it is identified, and the columns wanted."""
    f = table(spark, sf, "feature_tsv").withColumns({new: expr.number_list(F.col(old)) for new, old in WINDOW_LISTS.items()})
    f = f.withColumn("identified", expr.holds_any(expr.text_list(F.col("l_pep_ident"))).cast("int")).withColumn("intensity", F.when(usable(F.col("intensity")), F.col("intensity")))
    own = dict.fromkeys(["run", "rec_id", *WINDOW_LISTS, "identified", *headers])
    return consensus.looked_up(table(spark, sf, "consensus_edges"), f.select(*own, F.col("openms_fid").alias("feature_id")))


def consensus_lookup(spark, sf):
    """The feature of each element in each run."""
    features = table(spark, sf, "feature_tsv").select("run", F.col("openms_fid").alias("feature_id"), "rec_id")
    return consensus.winners(table(spark, sf, "consensus_edges"), features).select("ceid", "run", "rec_id")


def coverage_anti(spark, sf):
    """Exported features of no element."""
    return consensus.uncovered(_exported(spark, sf).select("run", "feature_id", "rec_id"), table(spark, sf, "consensus_edges")).select("run", "feature_id", "rec_id")


def global_bounds(spark, sf):
    """Outer bounds of every element."""
    return consensus.bounds(_long(spark, sf))


def _runs(spark, sf):
    # one row per acquisition: the manifest is the bounded list of columns
    return [r[0] for r in table(spark, sf, "run_manifest").select("run").distinct().orderBy("run").collect()]


def _pivot(spark, sf, headers):
    return consensus.wide(_long(spark, sf, headers), "ceid", _runs(spark, sf), list(headers), consensus.bound_columns())


def consensus_pivot_full(spark, sf):
    """Wide table with all columns of every run, and the elements' bounds."""
    return _pivot(spark, sf, consensus.FULL)


def consensus_pivot_reduced(spark, sf):
    """Wide table without windows and traces."""
    return _pivot(spark, sf, consensus.REDUCED)


def consensus_pivot_minimal(spark, sf):
    """Wide table of intensities, features, charges and scans."""
    return _pivot(spark, sf, consensus.MINIMAL)


def unpivot_intensities(spark, sf):
    """The wide table's intensities back in rows."""
    runs = _runs(spark, sf)
    w = consensus.wide(_long(spark, sf, ["intensity"]), "ceid", runs, ["intensity"])
    rows = w.unpivot(["ceid"], [F.col(f"`{c}`") for c in w.columns[1:]], "variable", "value").where("value IS NOT NULL")
    return rows.select("ceid", expr.run_key(F.col("variable")).alias("run"), "value")


def _states(spark, sf):
    n = table(spark, sf, "run_manifest").agg(F.count_distinct("run").alias("runs"))
    by = _long(spark, sf).groupBy("ceid").agg(F.count_distinct("run").alias("present"), F.sum("identified").alias("identified"))
    return by.crossJoin(F.broadcast(n)).withColumn("missing", F.col("runs") - F.col("present"))  # one row


def missing_histogram(spark, sf):
    """Elements by number of runs they lack."""
    return _states(spark, sf).groupBy("missing").agg(F.count("*").alias("count"))


def missing_by_ident(spark, sf):
    """The same for elements identified in exactly one run and the others, and in any."""
    one = F.when(F.col("identified") == 1, "Identified").otherwise("Unidentified")
    return _states(spark, sf).groupBy("missing", one.alias("exactly_one"), (F.col("identified") > 0).alias("any_run")).agg(F.count("*").alias("count"))


def _marked_areas(spark, sf):
    rows = record_areas(spark, sf, ("l_ms2_scans", "l_raw_pep_ident"))
    ms2 = F.coalesce(F.size(expr.int_list(F.col("l_ms2_scans"))) > 0, F.lit(False))
    ident = expr.holds_any(expr.text_list(F.col("l_raw_pep_ident")))
    return rows.select(ms2.alias("ms2"), ident.alias("ident"), F.inline("traces"))


def _curve(spark, sf):
    kinds = {"All Traces": F.lit(True), "Traces with MS2": F.col("ms2"), "Traces without MS2": ~F.col("ms2"), "Identified": F.col("ident"), "Unidentified": ~F.col("ident")}
    return curves.survival(_marked_areas(spark, sf), "n", "auc", kinds, UPTO)


def survival_curves(spark, sf):
    """Traces at least that long, their summed and mean area, by MS2 and identification."""
    c = _curve(spark, sf).where(F.col("index") < SHOWN)
    return c.select("index", "variable", "count", F.round("area", 0).alias("area"), F.round("mean", 6).alias("mean"))


def tradeoff_points(spark, sf):
    """Trace length from which identified traces outnumber the others, and outweigh them by mean area."""
    c = _curve(spark, sf)
    count = curves.tradeoff(c, "count", "Identified", "Unidentified").select(F.lit("count").alias("curve"), "tradeoff")
    return count.unionByName(curves.tradeoff(c, "mean", "Identified", "Unidentified").select(F.lit("mean").alias("curve"), "tradeoff"))


def file_keys(spark, sf):
    """Run, FDR and scan from file names and native ids made of the identifications."""
    p = _psms(spark, sf)
    name = F.concat(F.lit("idents/"), "run", F.lit("_____qvalue_no_decoys_fdr_"), "fdr", F.lit(".tsv"))
    native = F.concat(F.lit("controllerType=0 controllerNumber=1 scan="), F.col("scan").cast("string"), F.lit(" x"))
    base = expr.strip_extension(name)
    return p.select("psm_id", base.alias("base"), expr.run_key(base).alias("run_key"), expr.fdr_key(base).alias("fdr_key"), expr.scan_number(native).alias("scan_no"))


def channel_joins(spark, sf):
    """Per run and FDR: PSMs joined to exported features; runs without either vanish; every FDR is combined with every run."""
    ids = _psms(spark, sf).where("fdr IS NOT NULL").groupBy("run", "fdr").agg(F.count("*").alias("psms"))
    features = table(spark, sf, "feature_tsv").groupBy("run", "fdr").agg(F.count("*").alias("features"))
    fdrs = ids.select("fdr").distinct()  # a handful of levels named in file names
    combined = table(spark, sf, "run_manifest").select("run").distinct().crossJoin(bounded(fdrs, 1_000))
    return combined.join(ids, ["run", "fdr"]).join(features, ["run", "fdr"])


def group_tuple(spark, sf):
    """FDR levels with their runs."""
    rows = _psms(spark, sf).where("fdr IS NOT NULL").select("fdr", "run").distinct()
    return rows.groupBy("fdr").agg(F.concat_ws(",", F.sort_array(F.collect_list("run"))).alias("runs"))


def union_sources(spark, sf):
    """Exported and delivered features of a run in one list."""
    a = table(spark, sf, "feature_tsv").select("run", F.lit("exported").alias("kind"))
    b = table(spark, sf, "feature_batches").select("run", F.lit("delivered").alias("kind"))
    return a.unionByName(b).groupBy("run", "kind").agg(F.count("*").alias("n"))


def xic_extraction(spark, sf):
    """Trace points of a run inside each isotope's window of m/z and time, counted and summed:
    a run's peaks are its exported points, the queries the windows exported with the features."""
    log_mz = lambda c: F.log(c) * 1e6
    boxes = table(spark, sf, "feature_tsv").select("rec_id", "run", F.inline(windows()))
    boxes = boxes.withColumn("m_low", log_mz(F.col("mz_start")) - 1e-3).withColumn("m_high", log_mz(F.col("mz_end")) + 1e-3)
    points = exported_points(spark, sf, carry=("run",)).where("mass_to_charge > 0")
    points = points.select("run", "retention_time", "intensity", "mass_to_charge", log_mz(F.col("mass_to_charge")).alias("m"))
    hit = in_intervals(points, boxes, ["run"], "m", "m_low", "m_high", 10.0)  # 10 ppm
    inside = F.col("mass_to_charge").between(F.col("mz_start"), F.col("mz_end")) & F.col("retention_time").between(F.col("rt_start"), F.col("rt_end"))
    return hit.where(inside).groupBy("rec_id", "iso_pos").agg(F.count("*").alias("points"), F.round(F.sum("intensity"), 2).alias("intensity"))


def _linkable(spark, sf):
    f = _features(spark, sf, "charge", "mz", "rtapex").where("charge IS NOT NULL AND mz > 0 AND rtapex IS NOT NULL")
    return f.select("feat_id", "run", "charge", "mz", (F.col("rtapex") * 60).alias("rt"))


def _reference(spark, sf):
    return table(spark, sf, "run_manifest").agg(F.min_by("run", "acquired_at").alias("ref"))


def consensus_linking(spark, sf):
    """Features linked to the first acquired run's: each the other's nearest in m/z and time."""
    f = _linkable(spark, sf).crossJoin(F.broadcast(_reference(spark, sf)))  # one row
    return consensus.linked(f.where("run <> ref").drop("ref"), f.where("run = ref").drop("ref"), 5.0, 300.0)


def rt_alignment_points(spark, sf):
    """Pairs of retention times of a peptide and charge in a run and in the reference run, one anchor each: its first PSM."""
    p = _psms(spark, sf).where("retention_time > 0 AND plain_peptide IS NOT NULL AND charge IS NOT NULL")
    anchors = p.groupBy("run", "plain_peptide", "charge").agg(F.min_by("retention_time", "psm_id").alias("rt"))
    a = anchors.crossJoin(F.broadcast(_reference(spark, sf)))  # one row
    ref = a.where("run = ref").select("plain_peptide", "charge", F.col("rt").alias("transformed_rt"))
    return a.where("run <> ref").join(ref, ["plain_peptide", "charge"]).select("run", "plain_peptide", "charge", F.col("rt").alias("original_rt"), "transformed_rt")


_NAMES = """trapz_auc_hof trapz_auc_window intensity_rollup hull_boxes feature_hills cutoff_filter_t cutoff_filter_q cutoff_curve cutoff_curve_1000
interval_join_ms2 feature_scan_lists psm_in_scan_list first_wins_peptides unassigned_psms run_length_groups consensus_lookup coverage_anti
global_bounds consensus_pivot_full consensus_pivot_reduced consensus_pivot_minimal unpivot_intensities missing_histogram missing_by_ident survival_curves tradeoff_points file_keys channel_joins
group_tuple union_sources xic_extraction consensus_linking rt_alignment_points""".split()
QUERIES = {name: globals()[name] for name in _NAMES}
