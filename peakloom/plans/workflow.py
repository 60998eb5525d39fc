"""The workflow's own rows, from annotated features to elements on one time scale, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peakloom.config import QuantConfig
from peakloom.functions import expr
from peakloom.operators import align, consensus, idents, xic
from peakloom.operators.fill import usable
from peakloom.operators.quantiles import quantiles
from peakloom.plans import quant
from peakloom.plans.workflow_sql import SQL  # noqa: F401
from peakloom.session import bounded, table

CONFIG = QuantConfig(cutoff="q0.05")
KEEP = 10_000.0  # least intensity of an exported feature that is annotated


def _texts(values: Column, digits: int) -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast(f"decimal(24,{digits})").cast("string")), " ", "-")


def cutoff_report(spark: SparkSession, sf: str) -> DataFrame:
    """The workflow's cutoff plot as a table: intensity at 1,000 quantiles of every run, and the corner of what the cutoff removes."""
    rows = quant._features(spark, sf, "intensitysum").where(usable(F.col("intensitysum")))
    kind, at = expr.cutoff_spec(CONFIG.cutoff)
    curve = quantiles(rows, "run", "intensitysum", quant.CURVE_QS)
    if kind == "q":
        cut = quantiles(rows, "run", "intensitysum", [at]).select("run", F.col("q").alias("q_cutoff"), F.col("value").alias("i_cutoff"))
    else:
        cut = rows.groupBy("run").agg(F.avg((F.col("intensitysum") <= at).cast("int")).alias("q_cutoff")).withColumn("i_cutoff", F.lit(at))
    least = rows.groupBy("run").agg(F.min("intensitysum").alias("least"))
    corner = cut.join(least, "run")  # one row a run
    return curve.join(bounded(corner), "run").select("run", "q", F.round("value", 6).alias("intensity"), F.round("q_cutoff", 9).alias("q_cutoff"), F.round("i_cutoff", 6).alias("i_cutoff"), "least")


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    f = quant._exported(spark, sf).where(usable(F.col("intensity")) & (F.col("intensity") >= KEEP))
    return f.select("rec_id", "run", "fdr", "openms_fid", "charge", "intensity", "ms2_scans", *quant.WINDOW_LISTS.values())


def _psms(spark: SparkSession, sf: str) -> DataFrame:
    p = quant._psms(spark, sf).withColumn("scan", F.col("scan").cast("long")).withColumn("raw_peptide", F.coalesce("peptide_seq", "modified_peptide"))
    other = "fasta_acc" if CONFIG.graph_search else "fasta_desc"
    return p.select("run", "fdr", "scan", "psm_id", "plain_peptide", "raw_peptide", F.coalesce(CONFIG.protein_column, other).alias("proteins"), "qvalue")


def annotated_features(spark: SparkSession, sf: str) -> DataFrame:
    """Every kept feature with its PSMs in file order, rank 1 each; features without one and PSMs on no kept feature have nulls on the other side."""
    kept, psms = _kept(spark, sf), _psms(spark, sf)
    met = idents.attached(kept, psms).select("rec_id", "psm_id")
    own = kept.select("rec_id").join(met, "rec_id", "left")
    rest = psms.select("psm_id").join(met.select("psm_id").distinct(), "psm_id", "left_anti").select(F.lit(None).cast("long").alias("rec_id"), "psm_id")
    rows = own.unionByName(rest).join(psms.select("psm_id", "plain_peptide", "qvalue"), "psm_id", "left")
    has = F.col("psm_id").isNotNull()
    return rows.select("rec_id", "psm_id", "plain_peptide", "qvalue", F.when(has, "q-value").alias("score_type"), F.when(has, 1).alias("hit_rank"))


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    """XIC queries of the kept features: peptides once each, in file order."""
    kept = _kept(spark, sf)
    features = kept.select("rec_id", F.col("openms_fid").alias("identifier"), "charge", "ms2_scans", quant.windows().alias("windows"))
    first = idents.first_wins(idents.attached(kept, _psms(spark, sf)), ["rec_id"], "plain_peptide", ["psm_id"])
    return xic.queries(features, xic.ident_lists(first, ["rec_id"]), ["rec_id"])


def xic_queries(spark: SparkSession, sf: str) -> DataFrame:
    """The query table of the extractor, 13 columns, one row per isotope of a kept feature."""
    return _queries(spark, sf).withColumns({c: F.to_json(c) for c in ("pep_idents", "raw_pep_idents", "prot_idents", "ms2_scans")})


def _peaks(spark: SparkSession, sf: str) -> DataFrame:
    # a run's peaks are its exported points
    return quant.exported_points(spark, sf, carry=("run",)).select("run", F.col("retention_time").alias("rt"), F.col("mass_to_charge").alias("mz"), "intensity")


def xic_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Points of a run inside each query's box as lists in order of time, points of one time added."""
    runs = _kept(spark, sf).select("rec_id", "run")
    boxes = _queries(spark, sf).join(runs, "rec_id").select("rec_id", "iso_pos", "run", "mz_start", "mz_end", *[(F.col(c) * 60).alias(c) for c in ("rt_start", "rt_end")])
    found = xic.extracted(_peaks(spark, sf), boxes, ["rec_id", "iso_pos"], "sum")
    return found.select("rec_id", "iso_pos", _texts(F.col("retention_times"), 3).alias("retention_times"), _texts(F.col("mass_to_charge"), 5).alias("mass_to_charge"), _texts(F.col("intensities"), 2).alias("intensities"))


def quantified_features(spark: SparkSession, sf: str) -> DataFrame:
    """The exported row of every kept feature, 14 columns: its queries put together with its traces, intensity rolled up from their areas."""
    traces = quant.traces(spark, sf).select("rec_id", F.col("iso_pos").cast("int").alias("iso_pos"), F.col("retention_time").alias("retention_times"), F.col("mass_to_charge").alias("mass_to_charge"), F.col("intensity").alias("intensities"))
    rows = xic.quantified(_queries(spark, sf), traces, ["rec_id"], CONFIG.intensity_method)
    nested = lambda c, d: F.array_join(F.transform(c, lambda x: _texts(x, d)), "; ").alias(c)
    flat = lambda c, d: _texts(F.col(c).cast("array<double>"), d).alias(c)
    return rows.select(
        "rec_id", "openms_fid", F.round("intensity", 4).alias("intensity"), "charge", *[F.to_json(c).alias(c) for c in ("l_pep_ident", "l_raw_pep_ident", "l_prot_ident", "l_ms2_scans")],
        flat("l_mz_start", 5), flat("l_mz_end", 5), flat("l_rt_start", 3), flat("l_rt_end", 3), nested("l_retention_times", 4), nested("l_mass_to_charges", 5), nested("l_intensities", 4),
    )


def trace_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Per run and FDR: exported features, those with a trace, and traces."""
    traced = quant.exported_points(spark, sf, nested=2, carry=("run", "fdr")).groupBy("run", "fdr").agg(F.count("*").alias("traced"), F.sum(F.size("iso_pos")).alias("traces"))
    all_of = table(spark, sf, "feature_tsv").groupBy("run", "fdr").agg(F.count("*").alias("features"))
    same = F.col("a.run").eqNullSafe(F.col("t.run")) & F.col("a.fdr").eqNullSafe(F.col("t.fdr"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return all_of.alias("a").join(traced.alias("t"), same, "left").select("a.run", "a.fdr", "features", none("traced"), none("traces"))


def dangling_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of consensus elements to features that were never exported."""
    features = table(spark, sf, "feature_tsv").select("run", F.col("openms_fid").alias("feature_id"))
    return consensus.dangling(table(spark, sf, "consensus_edges"), features)


def _ordered(spark: SparkSession, sf: str) -> DataFrame:
    """(run, nth): runs by the time they were acquired."""
    runs = table(spark, sf, "run_manifest").groupBy("run").agg(F.min("acquired_at").alias("at"))
    return runs.select("run", F.row_number().over(Window.orderBy("at", "run")).alias("nth"))  # the manifest has a row a run


def consensus_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Every detected feature in its element: at most one feature of a run, within the tolerances of the element's seed."""
    features = quant._linkable(spark, sf).join(bounded(_ordered(spark, sf)), "run")
    return consensus.elements(features, CONFIG.ppm_tolerance, CONFIG.link_rt_window)


def rt_aligned(spark: SparkSession, sf: str) -> DataFrame:
    """Apex times of detected features on the reference run's scale."""
    anchors = quant.rt_alignment_points(spark, sf).select("run", F.col("original_rt").alias("x"), F.col("transformed_rt").alias("y"))
    f = quant._features(spark, sf, "rtapex").select("run", "feat_id", (F.col("rtapex") * 60).alias("rt"))
    return align.aligned(f, "rt", anchors).select("run", "feat_id", "rt", F.round("aligned", 6).alias("aligned"))


_NAMES = "cutoff_report annotated_features xic_queries xic_arrays quantified_features trace_counts dangling_edges consensus_elements rt_aligned".split()
QUERIES = {name: globals()[name] for name in _NAMES}
