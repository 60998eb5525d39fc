"""Score cutoff per source that keeps a target fraction of its records (problem 2).

Records are counted once each and written down.  The exact cumulative position of every
score cell is known from counts; the cell that holds the target position is divided and counted
again until it is small, and only then sorted by score (``operators.ranks``).  Equal scores share one
position (that of the last of them, whatever their identifiers), so they are counted
before they are sorted, and no task sorts more than ``leaf`` different scores of a source, however large
the source and however close together its scores.

Defined cases: records with a null source or identifier, or whose score is null, NaN,
infinite or negative, are not counted and not kept; repeated rows of one identifier in
one source count once, with their largest score; all records that tie with the cutoff
are kept; a fraction of 0 or less keeps the largest score, one above 1 counts as 1; a
source without a fraction, or without counted records, has no row; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakloom.operators.fill import usable
from peakloom.operators.ranks import LEAF, at_ranks
from peakloom.session import bounded, staged


def counted(df: DataFrame, source: str, key: str, score: str) -> DataFrame:
    """(source, key, score): what counts, each record once."""
    own = df.select(F.col(source).alias("source"), F.col(key).alias("key"), F.col(score).cast("double").alias("score"))
    own = own.where(F.col("source").isNotNull() & F.col("key").isNotNull() & usable(F.col("score")))
    return own.groupBy("source", "key").agg(F.max("score").alias("score"))


def _fractions(fractions: DataFrame, source: str, fraction: str) -> DataFrame:
    wanted = F.least(F.greatest(F.col(fraction).cast("double"), F.lit(1e-300)), F.lit(1.0))
    own = fractions.where(F.col(source).isNotNull() & F.col(fraction).isNotNull() & ~F.isnan(fraction))
    return own.groupBy(F.col(source).alias("g")).agg(F.max(wanted).alias("fraction"))


def _cutoffs(one: DataFrame, fractions: DataFrame, leaf: int) -> DataFrame:
    def asked(totals: DataFrame) -> DataFrame:
        # the fewest records whose share reaches the fraction; the product may round to either side of it
        near = F.ceil(F.col("fraction") * F.col("total"))
        fewest = F.when((near - 1) / F.col("total") >= F.col("fraction"), near - 1).when(near / F.col("total") >= F.col("fraction"), near).otherwise(near + 1)
        rank = F.col("total") - F.least(F.greatest(fewest, F.lit(1)), F.col("total"))
        return totals.join(bounded(fractions), "g").select("g", rank.alias("rank"), F.struct("fraction", "total").alias("tag"))

    found = at_ranks(one.select(F.col("source").alias("g"), F.col("score").alias("x")), asked, leaf)
    return found.select(F.col("g").alias("source"), F.col("value").alias("cutoff"), F.col("tag.total").alias("counted"), (F.col("tag.total") - F.col("below")).alias("kept"), "tag.fraction")


def cutoffs(df: DataFrame, fractions: DataFrame, source: str, key: str, score: str, fraction: str, leaf: int = LEAF) -> DataFrame:
    """(source, cutoff, counted, kept, fraction), one row per source."""
    return _cutoffs(staged(counted(df, source, key, score)), _fractions(fractions, source, fraction), leaf).withColumnRenamed("source", source)


def kept(df: DataFrame, fractions: DataFrame, source: str, key: str, score: str, fraction: str, leaf: int = LEAF) -> DataFrame:
    """(source, key, score, cutoff) of every record at or above its source's cutoff."""
    one = staged(counted(df, source, key, score))
    cut = staged(_cutoffs(one, _fractions(fractions, source, fraction), leaf).select("source", "cutoff"))
    return one.join(bounded(cut), "source").where("score >= cutoff").withColumnsRenamed({"source": source, "key": key})
