"""XML files of mass spectrometry, one row per repeated element, by the built-in XML source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.functions.expr import run_key, scan_number, strip_extension

_CV = "array<struct<_accession: string, _name: string, _value: string, _unitName: string>>"
_USER = "array<struct<_type: string, _name: string, _value: string>>"
# Accessions of the controlled vocabulary.
MS_LEVEL, SCAN_START, SELECTED_MZ, CHARGE = "MS:1000511", "MS:1000016", "MS:1000744", "MS:1000041"


def _read(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", "true").schema(schema).load(path)


def _file_run() -> Column:
    return run_key(strip_extension(F.col("_metadata.file_name")))


def _param(params: Column, accession: str, field: str = "_value") -> Column:
    return F.get(F.filter(params, lambda p: p["_accession"] == accession), F.lit(0))[field]


def ms2_scans(spark: SparkSession, path: str) -> DataFrame:
    """(run, scan, rt, mz, charge) of the MS2 spectra, by their first precursor; rt in seconds."""
    ion = f"struct<cvParam: {_CV}>"
    schema = f"_id string, cvParam {_CV}, scanList struct<scan: array<struct<cvParam: {_CV}>>>, precursorList struct<precursor: array<struct<selectedIonList: struct<selectedIon: array<{ion}>>>>>"
    first = lambda c: F.get(c, F.lit(0))
    scan = first(F.col("scanList.scan"))["cvParam"]
    picked = first(first(F.col("precursorList.precursor"))["selectedIonList"]["selectedIon"])["cvParam"]
    rt = _param(scan, SCAN_START).cast("double")
    rows = _read(spark, path, "spectrum", schema).where(_param(F.col("cvParam"), MS_LEVEL) == "2")
    return rows.select(
        _file_run().alias("run"), scan_number(F.col("_id")).alias("scan"), F.when(_param(scan, SCAN_START, "_unitName") == "minute", rt * 60).otherwise(rt).alias("rt"),
        _param(picked, SELECTED_MZ).cast("double").alias("mz"), _param(picked, CHARGE).cast("int").alias("charge"),
    )


_HIT = f"struct<_score: double, _sequence: string, _charge: int, UserParam: {_USER}>"
_IDENT = f"_score_type string, _RT double, _MZ double, PeptideHit array<{_HIT}>, UserParam {_USER}"
_INNER = f"struct<_score_type: string, _RT: double, _MZ: double, PeptideHit: array<{_HIT}>, UserParam: {_USER}>"


def _user(params: Column, name: str) -> Column:
    return F.get(F.filter(params, lambda p: p["_name"] == name), F.lit(0))["_value"]


def _ident(i: Column) -> Column:
    """(rt, mz, score_type, proteins, hits) of an identification."""
    hit = lambda h: F.struct(h["_score"].alias("score"), h["_sequence"].alias("sequence"), h["_charge"].alias("charge"), _user(h["UserParam"], "raw_peptide").alias("raw_peptide"))
    return F.struct(i["_RT"].alias("rt"), i["_MZ"].alias("mz"), i["_score_type"].alias("score_type"), _user(i["UserParam"], "proteins").alias("proteins"), F.transform(i["PeptideHit"], hit).alias("hits"))


def unassigned(spark: SparkSession, path: str) -> DataFrame:
    """(run, rt, mz, score_type, proteins, hits): identifications of featureXML that lie on no feature."""
    rows = _read(spark, path, "UnassignedPeptideIdentification", _IDENT)
    return rows.select(_file_run().alias("run"), _ident(F.struct(*rows.columns)).alias("i")).select("run", "i.*")


def features(spark: SparkSession, path: str) -> DataFrame:
    """(run, feature_id, rt, mz, intensity, charge, hulls, user, idents) of featureXML; hulls are bounding boxes in order."""
    schema = f"_id string, position array<struct<_dim: string, _VALUE: double>>, intensity double, charge int, convexhull array<struct<_nr: int, pt: array<struct<_x: double, _y: double>>>>, UserParam {_USER}, PeptideIdentification array<{_INNER}>"
    at = lambda d: F.get(F.filter(F.col("position"), lambda p: p["_dim"] == d), F.lit(0))["_VALUE"]

    def box(h: Column) -> Column:
        xs, ys = h["pt"]["_x"], h["pt"]["_y"]
        return F.struct(F.array_min(xs).alias("rt_start"), F.array_max(xs).alias("rt_end"), F.array_min(ys).alias("mz_start"), F.array_max(ys).alias("mz_end"))

    rows = _read(spark, path, "feature", schema)
    return rows.select(_file_run().alias("run"), F.col("_id").alias("feature_id"), at("0").alias("rt"), at("1").alias("mz"), "intensity", "charge", F.transform("convexhull", box).alias("hulls"), F.col("UserParam").alias("user"), F.transform("PeptideIdentification", _ident).alias("idents"))


def consensus_edges(spark: SparkSession, path: str) -> DataFrame:
    """(ceid, run, feature_id) of consensusXML."""
    runs = _read(spark, path, "map", "_id string, _name string").select(F.col("_id").alias("map"), strip_extension(F.col("_name")).alias("run"))
    schema = "_id string, groupedElementList struct<element: array<struct<_map: string, _id: string>>>"
    each = _read(spark, path, "consensusElement", schema).select(F.col("_id").alias("ceid"), F.explode("groupedElementList.element").alias("e"))
    edges = each.select("ceid", F.col("e._map").alias("map"), F.concat(F.lit("f_"), F.col("e._id")).alias("feature_id"))
    return edges.join(runs, "map").select("ceid", "run", "feature_id")


def transformations(spark: SparkSession, path: str) -> DataFrame:
    """(run, original_rt, transformed_rt) of trafoXML files."""
    rows = _read(spark, path, "Pair", "_from double, _to double")
    return rows.select(_file_run().alias("run"), F.col("_from").alias("original_rt"), F.col("_to").alias("transformed_rt"))
