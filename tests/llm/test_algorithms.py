import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.llm import cutoff, nearest, percentiles
from peakloom.operators import ranks


def brute_cutoffs(rows, fractions):
    best = {}
    for s, k, v in rows:
        if s is not None and k is not None and v is not None and math.isfinite(v) and v >= 0:
            best[s, k] = max(v, best.get((s, k), v))
    out, kept = {}, set()
    for s, f in fractions:
        vs = sorted((v for (t, _), v in best.items() if t == s), reverse=True)
        if f is None or not vs:
            continue
        cut = next(v for v in vs if sum(x >= v for x in vs) / len(vs) >= min(max(f, 1e-300), 1.0))
        out[s] = (cut, len(vs), sum(x >= cut for x in vs))
        kept |= {(s, k) for (t, k), v in best.items() if t == s and v >= cut}
    return out, kept


def test_cutoffs_match_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice("aaab"), rng.randrange(150), rng.choice([0.0, 1.0, 2.0, 2.0, 5e-324, 1e300, rng.lognormvariate(3, 4)])) for _ in range(600)]
    rows += [("a", 1, None), ("a", None, 5.0), (None, 3, 5.0), ("a", 500, math.nan), ("a", 501, math.inf), ("a", 502, -1.0), ("c", 1, 7.0), ("d", 1, 7.0), ("e", 1, None)]
    fractions = [("a", 0.7), ("b", 0.5), ("c", 0.0), ("d", 3.0), ("e", 0.5), ("f", 0.5), ("g", None)]
    kind = "src string, id bigint, s double"
    df = spark.createDataFrame(rows, kind).withColumn("source", F.lit("clash")).withColumn("score", F.lit(1))
    fr = spark.createDataFrame(fractions, "src string, share double")
    want, kept = brute_cutoffs(rows, fractions)
    got = {r.src: (r.cutoff, r.counted, r.kept) for r in cutoff.cutoffs(df, fr, "src", "id", "s", "share").collect()}
    assert got == want
    assert {(r.src, r.id) for r in cutoff.kept(df, fr, "src", "id", "s", "share").collect()} == kept
    assert cutoff.kept(df.where("false"), fr, "src", "id", "s", "share").count() == 0


def test_cutoffs_of_scores_close_together(spark):
    """A hot source whose scores lie in one cell: what is sorted stays small, the result exact."""
    rng = random.Random(1)
    rows = [("hot", k, 0.999 + rng.randrange(10**9) * 1e-12) for k in range(3000)] + [("tied", k, 0.5) for k in range(500)] + [("few", 1, 1.0)]
    fractions = [("hot", 0.37), ("tied", 0.1), ("few", 0.9)]
    df, fr = spark.createDataFrame(rows, "src string, id bigint, s double"), spark.createDataFrame(fractions, "src string, share double")
    want, kept = brute_cutoffs(rows, fractions)
    for leaf in (10, 400):
        assert {r.src: (r.cutoff, r.counted, r.kept) for r in cutoff.cutoffs(df, fr, "src", "id", "s", "share", leaf).collect()} == want
    assert {(r.src, r.id) for r in cutoff.kept(df, fr, "src", "id", "s", "share", 10).collect()} == kept


def test_score_cells_keep_order(spark):
    values = sorted([0.0, 5e-324, 1e-300, 0.1, 0.25, 1.0, 1.0000001, 2.0, 3.0, 1e308, *[random.Random(k).lognormvariate(0, 50) for k in range(200)]])
    cells = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(ranks.score_cell(F.col("v"))).collect()]
    assert cells == sorted(cells) and cells[0] == 0


@pytest.mark.parametrize("most", [nearest.MOST, 20])
@pytest.mark.parametrize("spread", [2.0, 5000.0])
def test_nearest_matches_brute_force(spark, spread, most):
    rng = random.Random(11)
    points = [(rng.choice("ab"), rng.choice([1, 1, 2]), k, round(rng.uniform(0, 600), 1)) for k in range(200)] + [("a", None, 900, 1.0), (None, 1, 901, 1.0), ("a", 1, None, 1.0), ("a", 1, 902, None), ("a", 1, 903, math.nan)]
    points += points[:20]
    spans = []
    for k in range(120):
        a = round(rng.uniform(0, 600), 1)
        b = round(a + rng.choice([0, 1, 4, spread]), 1)
        spans.append((rng.choice("ab"), rng.choice([1, 1, 2]), k, *((a, b) if rng.random() < 0.8 else (b, a))))
    spans += spans[:20] + [("a", 1, 500, None, 5.0), ("a", 1, 501, math.inf, 5.0), ("a", None, 502, 1.0, 2.0)]
    p = spark.createDataFrame(points, "run string, incl int, pid bigint, t double").withColumn("at", F.lit(0))
    s = spark.createDataFrame(spans, "run string, incl int, fid bigint, x double, y double").withColumn("bucket", F.lit("clash"))
    got = {r.pid: (r.fid, round(r.distance, 6)) for r in nearest.nearest(p, s, ["run", "incl"], ("pid", F.col("t")), ("fid", F.col("x"), F.col("y")), 10.0, most).collect()}
    want = {}
    for run, incl, pid, t in points:
        if None in (run, incl, pid, t) or math.isnan(t):
            continue
        best = []
        for r, i, fid, x, y in spans:
            if r == run and i == incl and x is not None and math.isfinite(x):
                lo, hi = min(x, y), max(x, y)
                d = max(0.0, lo - t, t - hi)
                if d <= 10.0:
                    best.append((round(d, 6), -hi if d == 0 else 0, fid))
        if best:
            want[pid] = (min(best)[2], min(best)[0])
    assert got == want
    assert nearest.nearest(p, s.where("false"), ["run", "incl"], ("pid", F.col("t")), ("fid", F.col("x"), F.col("y")), 10.0).count() == 0


def test_one_bucket_of_one_entity(spark):
    """All rows in one bucket, a third at one time."""
    rng = random.Random(3)
    points = [("a", k, rng.choice([5.0, rng.uniform(0, 10), rng.uniform(0, 10)])) for k in range(600)]
    spans = [("a", k, t := rng.choice([5.0, rng.uniform(0, 10)]), t + rng.choice([0.0, 0.01, 0.3])) for k in range(300)]
    p, s = spark.createDataFrame(points, "e string, pid bigint, t double"), spark.createDataFrame(spans, "e string, fid bigint, x double, y double")
    run = lambda most: sorted(tuple(r) for r in nearest.nearest(p, s, ["e"], ("pid", F.col("t")), ("fid", F.col("x"), F.col("y")), 100.0, most).collect())
    whole = run(nearest.MOST)
    assert len(whole) == 600 and run(50) == whole and run(7) == whole


def test_percentiles_are_exact(spark):
    rng = random.Random(2)
    data = {"a": [rng.lognormvariate(6, 3) for _ in range(4000)] + [42.0] * 2000, "b": [0.0, 0.0, 5.0], "c": [3.5], "d": [1e308, 1.0, 5e-324]}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), ("a", math.nan), ("a", -2.0), ("a", math.inf), (None, 1.0), ("z", None)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("group", F.lit("clash"))
    got = {(r.group, r.pct): r.value for r in percentiles.percentiles(df, F.col("k"), F.col("v"), [0, 10, 50, 90, 100], cells=16).collect()}
    assert len(got) == 20
    for (g, q), v in got.items():
        assert math.isclose(v, float(np.percentile(data[g], q)), rel_tol=1e-12, abs_tol=0)
    assert percentiles.percentiles(df.where("false"), F.col("k"), F.col("v"), [50]).count() == 0


def test_summaries_of_days_add_up(spark):
    rng = random.Random(4)
    values = [rng.lognormvariate(6, 3) for _ in range(3000)] + [0.0] * 5
    df = spark.createDataFrame([("a", k % 7, v) for k, v in enumerate(values)], "k string, day int, v double")
    apart = [percentiles.summary(df.where(f"day % 2 = {x}"), [F.col("k"), F.col("day")], F.col("v")) for x in (0, 1)]
    got = {r.pct: r.value for r in percentiles.combined(apart[0].unionByName(apart[1]), "k", [0, 10, 50, 90]).collect()}
    assert got[0] == 0.0
    for q in (10, 50, 90):
        assert abs(got[q] / float(np.percentile(values, q)) - 1) <= percentiles.ERROR
