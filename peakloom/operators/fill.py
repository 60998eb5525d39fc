"""Filling missing values from records of the same group, marking what was filled (problem 5).

Numbers: a mixed-effects model of the logarithm, log(1 + y) = mean + group + period +
rest, with both effects shrunk towards 0 by the ratio of the rest's variance to theirs.
The variances come from the groups' own sums (method of moments), the effects from
rounds over the mixed-model equations until they come to rest, each round one aggregate by group and one by
period.  Categories: a multinomial per group whose shares are shrunk towards the shares
of the record's period by ``PRIOR`` pseudo-records; the likeliest one is filled in.

Records meet their groups by a join once; the result is written down and every round
reads it.  All sums are combined before they are shuffled, so a group that holds a third
of all rows costs no more than any other.

Defined cases: numbers that are null, NaN, infinite or negative are missing, as is a null
category; a record in several groups gets the mean of their predictions (categories: the
likeliest over the sum of their counts); repeated links count once; a record without a
link, or whose groups hold no value of another record, stays missing; measured values are
never changed; a missing period has effect 0; ties between categories go to the lesser;
other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakloom.session import bounded, staged

TOLERANCE = 1e-3  # largest change of an effect of the logarithm at which the rounds end
ROUNDS = 100
PRIOR = 2.0


def usable(c: Column) -> Column:
    """Not null, not NaN, not infinite, not negative."""
    return c.isNotNull() & ~F.isnan(c) & (c >= 0) & (c < float("inf"))


@dataclass(frozen=True)
class Fit:
    """A fitted model: mean and variances of the logarithm, effects as tables, and how the rounds ended."""

    rows: DataFrame  # (group, record, period, y)
    mean: float
    rest: float
    of_group: float
    of_period: float
    groups: DataFrame  # (group, g)
    periods: DataFrame  # (period, t)
    rounds: int
    change: float  # the largest change of a period's effect in the last round


def fit(members: DataFrame, tolerance: float = TOLERANCE, most: int = ROUNDS) -> Fit | None:
    """The model of members (group, record, period, value); none if no value is known.  Rounds end when no period's effect
    changes by more than ``tolerance``; a fit that has not come to rest after ``most`` rounds raises."""
    rows = staged(members.where("group IS NOT NULL").select("group", "record", "period", F.when(usable(F.col("value")), F.log1p("value")).alias("y")).distinct())
    known = rows.where("y IS NOT NULL")
    sums = known.groupBy("group").agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    t = sums.agg(
        F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"),
    ).first()
    if not t["n"]:
        return None
    mean = t["s"] / t["n"]
    rest = max(t["within"], 1e-12) / max(1, t["n"] - t["groups"])
    spread = t["n"] - t["nn"] / t["n"]
    of_group = max(t["between"] - t["s"] * mean - (t["groups"] - 1) * rest, 0.0) / spread if spread > 0 else 0.0

    # the periods' own variance, from their sums, in the same way
    p = known.where("period IS NOT NULL").groupBy("period").agg(F.count("*").alias("n"), F.sum(F.col("y") - mean).alias("s"))
    u = p.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between")).first()
    wide = (u["n"] - u["nn"] / u["n"]) if u["n"] else 0.0
    of_period = max(u["between"] - (u["k"] - 1) * (rest + of_group), 0.0) / wide if wide > 0 else 0.0
    shrink_group, shrink_period = rest / max(of_group, rest * 1e-6), rest / max(of_period, rest * 1e-6)

    periods = staged(p.select("period", (F.col("s") / (F.col("n") + shrink_period)).alias("t"), F.lit(None).cast("double").alias("d")))
    change = math.inf
    for k in range(1, most + 1):
        with_t = known.join(bounded(periods), "period", "left")
        groups = with_t.groupBy("group").agg((F.sum(F.col("y") - mean - F.coalesce("t", F.lit(0.0))) / (F.count("*") + shrink_group)).alias("g"))
        if change <= tolerance:
            return Fit(rows, mean, rest, of_group, of_period, groups, periods.select("period", "t"), k, change)
        left = known.where("period IS NOT NULL").join(groups, "group")
        new = left.groupBy("period").agg((F.sum(F.col("y") - mean - F.col("g")) / (F.count("*") + shrink_period)).alias("new"))
        new = staged(new.join(bounded(periods), "period").select("period", F.col("new").alias("t"), (F.col("new") - F.col("t")).alias("d"), F.col("d").alias("was")))
        c = new.agg(F.max(F.abs("d")).alias("change"), F.sum(F.col("d") * F.col("was")).alias("both"), F.sum(F.col("was") * F.col("was")).alias("was")).first()
        change = c["change"] or 0.0
        ratio = c["both"] / c["was"] if c["was"] else 0.0
        if k % 3 == 0 and 0 < ratio < 1 and change > tolerance:  # changes shrink by a steady ratio: go to where they lead
            new = new.withColumn("t", F.col("t") + F.col("d") * (ratio / (1 - ratio))).withColumn("d", F.lit(None).cast("double"))
        periods = new.select("period", "t", "d")
    raise RuntimeError(f"effects still change by {change:.3g} after {most} rounds")


def fill_numbers(members: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(record, filled) for members (group, record, period, value): one row per record that is missing and can be filled."""
    model = fit(members, tolerance)
    if model is None:
        return members.select("record", F.lit(None).cast("double").alias("filled")).where("false")
    missing = model.rows.where("y IS NULL").join(model.groups, "group").join(bounded(model.periods), "period", "left")
    level = F.lit(model.mean) + F.col("g") + F.coalesce("t", F.lit(0.0))
    return missing.groupBy("record").agg(F.greatest(F.lit(0.0), F.expm1(F.avg(level))).alias("filled"))


def fill_categories(members: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(record, filled, share) for members (group, record, period, value) with integer or text values."""
    rows = staged(members.where("group IS NOT NULL").select("group", "record", "period", "value").distinct())
    known = rows.where("value IS NOT NULL")
    in_group = known.groupBy("group", "value").agg(F.count("*").alias("n"))
    size = known.groupBy("period").agg(F.count("*").alias("of"))
    shares = known.groupBy("period", "value").agg(F.count("*").alias("m")).join(size, "period")
    shares = shares.select("period", "value", (F.col("m") / F.col("of")).alias("p"))
    hit = rows.where("value IS NULL").select("group", "record", "period").join(in_group, "group")
    hit = hit.groupBy("record", "period", "value").agg(F.sum("n").alias("n"))
    one = Window.partitionBy("record")
    scored = hit.withColumn("total", F.sum("n").over(one)).join(shares, ["period", "value"], "left")
    score = (F.col("n") + prior * F.coalesce("p", F.lit(0.0))) / (F.col("total") + prior)
    best = F.row_number().over(one.orderBy(F.desc("share"), F.asc("value")))
    return scored.withColumn("share", score).withColumn("nth", best).where("nth = 1").select("record", F.col("value").alias("filled"), "share")


def links(records: DataFrame, edges: DataFrame, record: str, value: str, period: str, keys: list[tuple[str, str]], group: str) -> DataFrame:
    """Members (group, record, period, value): records joined to their groups on (record column, edge column) pairs."""
    e = edges.select(F.col(group).alias("group"), *(F.col(b).alias(f"k{k}") for k, (_, b) in enumerate(keys))).distinct()
    r = records.select(F.col(record).alias("record"), F.col(period).alias("period"), F.col(value).alias("value"), *(F.col(a).alias(f"k{k}") for k, (a, _) in enumerate(keys)))
    return e.join(r, [f"k{k}" for k in range(len(keys))]).select("group", "record", "period", "value")
