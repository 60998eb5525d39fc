"""Problem 5: missing intensities and charges filled from the records of the same consensus element."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.operators.fill import fill_categories, fill_numbers, links, usable
from peakloom.session import table

_KEYS = [("run", "run"), ("openms_fid", "feature_id")]


def _members(spark: SparkSession, sf: str, value: str) -> DataFrame:
    # a run is acquired at one time, so it is the period whose level is shared
    return links(table(spark, sf, "feature_tsv"), table(spark, sf, "consensus_edges"), "rec_id", value, "run", _KEYS, "ceid")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return fill_numbers(_members(spark, sf, "intensity")).select(F.col("record").alias("rec_id"))


def p5_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Every record with its intensity, measured or filled, and the mask of what was filled."""
    records = table(spark, sf, "feature_tsv").select("rec_id", "run", "intensity")
    known = F.when(usable(F.col("intensity")), F.col("intensity"))
    fills = fill_numbers(_members(spark, sf, "intensity")).withColumnRenamed("record", "rec_id")
    return records.join(fills, "rec_id", "left").select("rec_id", "run", F.coalesce(known, "filled").alias("intensity"), (known.isNull() & F.col("filled").isNotNull()).alias("was_filled"))


def p5_charges(spark: SparkSession, sf: str) -> DataFrame:
    """Missing charges filled from the element's records."""
    return fill_categories(_members(spark, sf, "charge")).select(F.col("record").alias("rec_id"), F.col("filled").alias("charge"), F.round("share", 9).alias("share"))


def p5_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Every record with its measured intensity and its charge, measured or filled, and a mask for each of the two."""
    records = table(spark, sf, "feature_tsv").select("rec_id", "intensity", "charge")
    known = F.when(usable(F.col("intensity")), F.col("intensity"))
    numbers = fill_numbers(_members(spark, sf, "intensity")).select(F.col("record").alias("rec_id"), F.lit(True).alias("intensity_filled"))
    charges = fill_categories(_members(spark, sf, "charge")).select(F.col("record").alias("rec_id"), F.col("filled").alias("other"))
    all_of = records.join(numbers, "rec_id", "left").join(charges, "rec_id", "left")
    return all_of.select(
        "rec_id", known.alias("measured"), F.coalesce("intensity_filled", F.lit(False)).alias("intensity_filled"),
        F.coalesce("charge", "other").alias("charge"), (F.col("charge").isNull() & F.col("other").isNotNull()).alias("charge_filled"),
    )


QUERIES = {"p5_found": p5_found, "p5_filled": p5_filled, "p5_charges": p5_charges, "p5_mask": p5_mask}

_MEMBERS = """WITH m AS (SELECT DISTINCT e.ceid, f.rec_id, f.run, {0} AS value
  FROM consensus_edges e JOIN feature_tsv f ON e.run = f.run AND e.feature_id = f.openms_fid)
"""
_USABLE = "CASE WHEN f.intensity >= 0 AND NOT isnan(f.intensity) AND NOT isinf(f.intensity) THEN f.intensity END"
SQL = {
    "p5_found": _MEMBERS.format(_USABLE)
    + "SELECT DISTINCT a.rec_id FROM m a JOIN m b ON a.ceid = b.ceid AND b.value IS NOT NULL WHERE a.value IS NULL",
    "p5_charges": _MEMBERS.format("f.charge")
    + """, p AS (SELECT run, value, count(*) / sum(count(*)) OVER (PARTITION BY run) AS p FROM m WHERE value IS NOT NULL GROUP BY run, value),
g AS (SELECT ceid, value, count(*) AS n FROM m WHERE value IS NOT NULL GROUP BY ceid, value),
h AS (SELECT m.rec_id, m.run, g.value, sum(g.n) AS n FROM m JOIN g USING (ceid) WHERE m.value IS NULL GROUP BY ALL),
s AS (SELECT rec_id, h.value, (n + 2.0::DOUBLE * coalesce(p, 0)) / (sum(n) OVER (PARTITION BY rec_id) + 2.0::DOUBLE) AS share
  FROM h LEFT JOIN p ON h.run = p.run AND h.value = p.value)
SELECT rec_id, value AS charge, round(share::DOUBLE, 9) AS share FROM s
QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY share DESC, value) = 1""",
}
SQL["p5_mask"] = f"""WITH a AS ({SQL["p5_found"]}), c AS ({SQL["p5_charges"]})
SELECT f.rec_id, {_USABLE} AS measured, a.rec_id IS NOT NULL AS intensity_filled, coalesce(f.charge, c.charge) AS charge, f.charge IS NULL AND c.charge IS NOT NULL AS charge_filled
FROM feature_tsv f LEFT JOIN a ON f.rec_id = a.rec_id LEFT JOIN c ON f.rec_id = c.rec_id"""
