"""Problem 1: feature records, exported or delivered nested, as related flat tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.operators.nested import Flat, flatten, rejected
from peakloom.plans.records_sql import SQL  # noqa: F401
from peakloom.session import table

WINDOWS = ("l_mz_start", "l_mz_end", "l_rt_start", "l_rt_end")
TRACES = ("l_retention_times", "l_mass_to_charges", "l_intensities")
_ISOTOPES = r"features\[\]\.isotopes(\[\]|\{\})"

POINTS = Flat(
    ancestor=rf"features\[\]\[\]\[\]|{_ISOTOPES}\.xic\[\]",
    keys=("feature_pos", "iso_pos", "point_pos"),
    fields=tuple(zip(("retention_time", "mass_to_charge", "intensity"), TRACES)),
    numeric=("retention_time", "mass_to_charge", "intensity"),
    complete=True,
)
ISOTOPES = Flat(
    ancestor=rf"features\[\]\[\]|{_ISOTOPES}(\.window|\.flags)?",
    keys=("feature_pos", "iso_pos"),
    fields=(("mz_start", "mz_start|l_mz_start"), ("mz_end", "mz_end|l_mz_end"), ("rt_start", "rt_start|l_rt_start"), ("rt_end", "rt_end|l_rt_end")),
    numeric=("mz_start", "mz_end", "rt_start", "rt_end"),
)
# also isotopes that have traces or anything else but no window
ALL_ISOTOPES = replace(ISOTOPES, present=rf"{_ISOTOPES}\.|features\[\]\.(?:{'|'.join(TRACES)})\[\]\[\]")
FEATURES = Flat(ancestor=r"features\[\]", keys=("feature_pos",), fields=(("openms_fid", "openms_fid"), ("charge", "charge")), numeric=("charge",))


def _cells(columns: tuple[str, ...]) -> dict[str, tuple[str, tuple[int, ...]]]:
    return {c: (f"features[].{c}", (0,)) for c in columns}


def _both(spark: SparkSession, sf: str, columns: tuple[str, ...], spec: Flat, apart: bool = False) -> DataFrame:
    exported = flatten(table(spark, sf, "feature_tsv"), "rec_id", _cells(columns), spec, apart=apart)
    delivered = flatten(table(spark, sf, "feature_batches").withColumnRenamed("batch_id", "rec_id"), "rec_id", {"payload": ("", ())}, spec)
    mark = lambda df, name: df.select(F.lit(name).alias("src_table"), "*")
    return mark(exported, "feature_tsv").unionByName(mark(delivered, "feature_batches"))


def _int(df: DataFrame) -> DataFrame:
    """Positions as int; the number of a keyed isotope above int's range, which the operator gives as bigint, is null."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in df.columns if c.endswith("_pos")})


def trace_points(spark: SparkSession, sf: str) -> DataFrame:
    """One row per trace point with its three values."""
    return _both(spark, sf, TRACES, POINTS)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _int(trace_points(spark, sf).select("src_table", "rec_id", "feature_pos", "iso_pos", "point_pos"))


def p1_isotopes(spark: SparkSession, sf: str) -> DataFrame:
    """Isotopes with their windows, null where absent; child of p1_features by (src_table, rec_id, feature_pos), parent of the points."""
    return _int(_both(spark, sf, (*WINDOWS, *TRACES), ALL_ISOTOPES, apart=True))


def p1_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features, parent of isotopes and points; an exported line is one feature at position 0."""
    delivered = flatten(table(spark, sf, "feature_batches").withColumnRenamed("batch_id", "rec_id"), "rec_id", {"payload": ("", ())}, FEATURES)
    exported = table(spark, sf, "feature_tsv").select("rec_id", F.lit(0).alias("feature_pos"), "openms_fid", F.col("charge").cast("double").alias("charge"))
    mark = lambda df, name: df.select(F.lit(name).alias("src_table"), "rec_id", "feature_pos", "openms_fid", F.col("charge").try_cast("int").alias("charge"))
    return _int(mark(exported, "feature_tsv").unionByName(mark(delivered, "feature_batches")))


def p1_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Cells and payloads that gave no rows, and why."""
    exported = rejected(table(spark, sf, "feature_tsv"), "rec_id", (*WINDOWS, *TRACES))
    delivered = rejected(table(spark, sf, "feature_batches").withColumnRenamed("batch_id", "rec_id"), "rec_id", ("payload",))
    return exported.select(F.lit("feature_tsv").alias("src_table"), "*").unionByName(delivered.select(F.lit("feature_batches").alias("src_table"), "*"))


def p1_trace_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Points re-nested per isotope: count and largest intensity."""
    keys = ["src_table", "rec_id", "feature_pos", "iso_pos"]
    return _int(trace_points(spark, sf)).groupBy(*keys).agg(F.count("*").alias("points"), F.max("intensity").alias("top_intensity"))


QUERIES = {"p1_found": p1_found, "p1_features": p1_features, "p1_isotopes": p1_isotopes, "p1_rejected": p1_rejected, "p1_trace_sums": p1_trace_sums}
