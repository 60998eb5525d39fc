"""Pairing records with the nearest one in time of the same entity (problem 3).

Both sides are put into time buckets of the tolerance's width: a point into its own, a
span into every bucket it touches and the two adjacent ones, so that entity and bucket
bring together all that can lie within the tolerance.  The join on entity and bucket is
run as a merge: the rows of a bucket are sorted by time once in each direction, and the
running best of the spans that began before a point, and of those that begin after it,
are its only two candidates.  No pairs are emitted, so a bucket of an entity that holds
a third of all rows costs a sort and not a product.  A bucket of more than ``most`` rows is cut
into slices of time, at its approximate quantiles; a slice starts from the best spans of the
slices before and after it, which are one row a slice, so no task sorts a whole bucket.

Spans of many tolerances would touch many buckets; they are put into buckets 16, 256, ...
times as wide, and points are added to those widths only if such spans exist.

Defined cases: points with a null entity or key, or a time that is null or no finite
number, are not paired, nor spans with a null entity or key or without two finite
bounds; bounds may come in either order; repeated rows count once; of spans that hold
the point the one that ends last is taken, then the smaller key; of equally near ones
the smaller key; a point with none within the tolerance has no row; other columns are
ignored.  Keys are integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.session import bounded, staged

WIDER = 16
MOST = 1_000_000  # rows of a bucket that are sorted in one task
CUTS = 1024


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def nearest(
    points: DataFrame, spans: DataFrame, entity: list[str], point: tuple[str, Column], span: tuple[str, Column, Column], tolerance: float, most: int = MOST
) -> DataFrame:
    """(point key, span key, distance): for each point its nearest span within the tolerance.

    point: key column and time; span: key column and two bounds, in the unit of the tolerance.
    """
    known = [F.col(c).isNotNull() for c in entity]
    held = lambda df, *extra: df.where(all_of([*known, *extra]))
    names = [F.col(c).alias(f"e{k}") for k, c in enumerate(entity)]
    keys = [f"e{k}" for k in range(len(entity))]

    a, b = span[1].cast("double"), span[2].cast("double")
    right = held(spans, F.col(span[0]).isNotNull(), _finite(a), _finite(b)).select(
        *names, F.col(span[0]).cast("long").alias("id"), F.least(a, b).alias("at"), F.greatest(a, b).alias("until")
    )
    length = (F.col("until") - F.col("at")) / (WIDER * tolerance)
    right = right.withColumn("level", F.when(length <= 1, 0).otherwise(F.ceil(F.log(length) / F.log(F.lit(float(WIDER))))).cast("int"))
    # at most a few hundred levels exist, since a double's exponent is bounded
    levels = sorted(right.agg(F.collect_set("level")).first()[0]) or [0]

    width = tolerance * F.pow(F.lit(float(WIDER)), F.col("level"))
    bucket = lambda t: F.floor(t / width)
    right = right.withColumn("bucket", F.explode(F.sequence(bucket(F.col("at")) - 1, bucket(F.col("until")) + 1)))
    time = point[1].cast("double")
    left = held(points, F.col(point[0]).isNotNull(), _finite(time)).select(*names, F.col(point[0]).cast("long").alias("id"), time.alias("at"))
    left = left.withColumn("level", F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0]))
    left = left.withColumn("bucket", bucket(F.col("at")))

    shape = [*keys, "level", "bucket", "at", "id"]
    rows = right.select(*shape, "until").unionByName(left.select(*shape, F.lit(None).cast("double").alias("until")))
    cell = [*keys, "level", "bucket"]
    hot = staged(rows.groupBy(*cell).agg(F.count("*").alias("n")).where(F.col("n") > most))
    sliced = not hot.isEmpty()
    part = [*cell, "slice"] if sliced else cell
    if sliced:
        rows = _sliced(rows, hot, cell, most)
    rows = rows.repartition(*part).distinct().withColumn("is_span", F.col("until").isNotNull())
    before = Window.partitionBy(*part).orderBy(F.asc("at"), F.desc("is_span")).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*part).orderBy(F.desc("at"), F.asc("is_span")).rowsBetween(Window.unboundedPreceding, 0)
    late = F.max(F.when(F.col("is_span"), F.struct(F.col("until").alias("t"), (-F.col("id")).alias("k"))))
    early = F.min(F.when(F.col("is_span"), F.struct(F.col("at").alias("t"), F.col("id").alias("k"))))
    swept = rows.withColumn("begun", late.over(before)).withColumn("coming", early.over(after)).where(~F.col("is_span"))
    if sliced:
        each = rows.join(bounded(hot.select(*cell)), cell).groupBy(*part).agg(late.alias("late"), early.alias("early"))
        along = Window.partitionBy(*cell).orderBy("slice")
        past = F.max("late").over(along.rowsBetween(Window.unboundedPreceding, -1))
        ahead = F.min("early").over(along.rowsBetween(1, Window.unboundedFollowing))
        carried = staged(each.select(*part, past.alias("past"), ahead.alias("ahead")))
        swept = swept.join(bounded(carried), part, "left")
        swept = swept.withColumn("begun", F.greatest("begun", "past")).withColumn("coming", F.least("coming", "ahead"))
    option = lambda distance, end, key: F.when(distance <= tolerance, F.struct(distance.alias("distance"), end.alias("end"), key.alias("key")))
    within = F.col("at") <= F.col("begun.t")
    left_of = option(F.when(within, 0.0).otherwise(F.col("at") - F.col("begun.t")), F.when(within, -F.col("begun.t")).otherwise(0.0), -F.col("begun.k"))
    right_of = option(F.col("coming.t") - F.col("at"), F.lit(0.0), F.col("coming.k"))
    best = F.array_min(F.filter(F.array(left_of, right_of), lambda x: x.isNotNull()))
    found = swept.select("id", best.alias("best")).where("best IS NOT NULL")
    if len(levels) > 1:
        found = found.groupBy("id").agg(F.min("best").alias("best"))
    return found.select(F.col("id").alias(point[0]), F.col("best.key").alias(span[0]), F.col("best.distance").alias("distance"))


def _sliced(rows: DataFrame, hot: DataFrame, cell: list[str], most: int) -> DataFrame:
    """Rows with their slice: 0 except in ``hot`` buckets, which are cut at quantiles of their times into slices of about ``most`` rows."""
    shares = [k / CUTS for k in range(1, CUTS)]
    cuts = rows.join(bounded(hot), cell).groupBy(*cell).agg(F.percentile_approx("at", shares, 10 * CUTS).alias("cuts"), F.count("*").alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(CUTS * most) / F.col("n"))).cast("int")
    cuts = staged(cuts.select(*cell, F.array_distinct(F.filter("cuts", lambda x, k: k % step == 0)).alias("cuts")))
    behind = F.size(F.filter("cuts", lambda x: x < F.col("at")))
    return rows.join(bounded(cuts), cell, "left").withColumn("slice", F.when(F.col("cuts").isNull(), 0).otherwise(behind)).drop("cuts")


def all_of(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
