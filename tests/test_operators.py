import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peakloom.functions import expr
from peakloom.operators import consensus, curves, fill, idents
from peakloom.operators.intervals import in_intervals
from peakloom.operators.quantiles import quantiles
from peakloom.operators.ranks import at_ranks


def one(spark, schema, row, *cols):
    return tuple(spark.createDataFrame([row], schema).select(*cols).first())


def test_expressions(spark):
    assert one(spark, "a array<double>, b array<double>, c array<double>", ([3.0, 1.0, 2.0], [4.0, 1.0, 3.0, 2.0], []), *[expr.array_median(F.col(c)) for c in "abc"]) == (2.0, 2.5, None)
    pts = [(1.0, 10.0), (1.5, 30.0), (2.25, 20.0), (4.0, 5.0)]
    kind = "array<struct<x: double, y: double>>"
    assert one(spark, f"a {kind}, b {kind}, c {kind}", (pts, [], pts[:1]), *[expr.trapezoid(F.col(c), "x", "y") for c in "abc"]) == (50.625, 0.0, 0.0)
    assert one(spark, "a array<double>", ([5.0, 1.0, 9.0, 7.0],), *[expr.rollup(F.col("a"), m) for m in expr.METHODS]) == (9.0, 22.0, 21.0, 7.0)
    assert one(spark, "a array<double>", ([4.0, 2.0],), expr.rollup(F.col("a"), "top3_sum"), expr.rollup(F.col("a"), "top3_mean")) == (6.0, 3.0)
    with pytest.raises(ValueError):
        expr.rollup(F.lit(1), "mode")
    name = ("x/a_b_____qvalue_no_decoys_fdr_0.01.tsv", "controllerType=0 controllerNumber=1 scan=123", "scan=x")
    got = one(spark, "f string, s string, t string", name, expr.run_key(expr.strip_extension(F.col("f"))), expr.fdr_key(F.col("f")), expr.scan_number(F.col("s")), expr.scan_number(F.col("t")))
    assert got == ("a_b", "0.01", 123, None)
    got = one(spark, "a string, b string, c string", ("[{'isotope_hill_idx': 5}, {\"isotope_hill_idx\": 6}]", "[]", None), *[expr.hill_list(F.col(c)) for c in "abc"])
    assert got == ([5, 6], [], None)
    assert one(spark, "a string", ("['PEP', \"TI'DE\"]",), expr.text_list(F.col("a"))) == (["PEP", "TI'DE"],)
    lists = ("[None, 500.1]", "[np.float64(1), '2', nan]", "(1, 2)", "[]", "[1, 2", None)
    for text, want in zip(lists, ([None, 500.1], [1.0, 2.0, None], [1.0, 2.0], [], None, None)):
        assert one(spark, "a string", (text,), expr.number_list(F.col("a"))) == (want,)
    for text, want in (("[None]", ([None], False)), ("[nan]", ([None], False)), ("['None', None]", (["None", None], True)), ("[]", ([], False)), (None, (None, False))):
        assert one(spark, "a string", (text,), expr.text_list(F.col("a")), expr.holds_any(expr.text_list(F.col("a")))) == want
    assert one(spark, "a string, b string", ("PEPTIDE", "PEP(ox)"), expr.is_peptide(F.col("a")), expr.is_peptide(F.col("b"))) == (True, False)
    assert expr.cutoff_spec("t1000") == ("t", 1000.0)
    for bad in ("q1.5", "x3", "q-1", "t"):
        with pytest.raises(ValueError):
            expr.cutoff_spec(bad)


def test_quantiles_match_numpy(spark):
    rng = random.Random(3)
    data = {"a": [rng.lognormvariate(5, 3) for _ in range(501)] + [7.0] * 300, "b": [0.0, 0.0, -3.5, 2.0], "c": [4.0]}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), ("d", None), (None, 1.0), ("a", float("nan"))]
    qs = [0.0, 0.05, 0.33, 0.5, 0.99, 1.0]
    got = {(r.g, r.q): r.value for r in quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", qs).collect()}
    assert len(got) == 18
    for (g, q), v in got.items():
        assert math.isclose(v, float(np.quantile(data[g], q)), rel_tol=1e-9, abs_tol=1e-12)


def test_quantiles_of_values_close_together(spark):
    """All values in one first cell: it is divided until what is sorted is small."""
    rng = random.Random(6)
    data = {"a": [0.999 + rng.random() * 1e-3 for _ in range(3000)] + [0.9995] * 500, "b": [-1e308, 1e308, 5.0] + [5.0 + k * 1e-12 for k in range(400)]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    qs = [0.0, 0.1, 0.3333, 0.5, 0.9, 1.0]
    for leaf in (5, 100):
        for r in quantiles(df, "g", "v", qs, leaf).collect():
            assert math.isclose(r.value, float(np.quantile(data[r.g], r.q)), rel_tol=1e-12), (r.g, r.q, leaf)


def test_ranks_and_their_ties(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 2, 2, 3] * 10], "g string, x double")
    asked = lambda totals: totals.select("g", F.explode(F.lit([0, 9, 10, 39, 40, 49])).alias("rank"), F.lit("t").alias("tag"))
    for leaf in (1, 7, 1000):
        got = sorted(tuple(r) for r in at_ranks(df, asked, leaf).collect())
        assert got == [("a", k, "t", v, b, t) for k, v, b, t in [(0, 1.0, 0, 10), (9, 1.0, 0, 10), (10, 2.0, 10, 40), (39, 2.0, 10, 40), (40, 3.0, 40, 50), (49, 3.0, 40, 50)]]


def test_intervals_match_nested_loop(spark):
    rng = random.Random(1)
    points = [(rng.choice("ab"), k, round(rng.uniform(0, 1000), 1)) for k in range(300)] + [("a", 999, None), (None, 998, 5.0)]
    spans = [(rng.choice("ab"), k, a := round(rng.uniform(0, 1000), 1), a + rng.choice([0, 1, 5.5, 900, 1e7])) for k in range(120)] + [("a", 500, 7.0, 3.0), ("b", 501, None, 3.0)]
    p, s = spark.createDataFrame(points, "k string, p int, at double"), spark.createDataFrame(spans, "k string, s int, low double, high double")
    got = sorted((r.p, r.s) for r in in_intervals(p, s, ["k"], "at", "low", "high", 2.0).collect())
    want = sorted((i, j) for k, i, t in points for m, j, a, b in spans if t is not None and a is not None and k is not None and k == m and a <= t <= b)
    assert got == want
    assert in_intervals(p, s.where("false"), ["k"], "at", "low", "high", 2.0).count() == 0


def test_scans_in_boxes(spark):
    f = spark.createDataFrame([("r", 1, 2, 500.0, 200.0, 100.0), ("r", 2, 3, 500.0, 100.0, 200.0)], "run string, feat_id bigint, charge int, mz double, a double, b double")
    scans = spark.createDataFrame([("r", 2, rt, mz, k, 10 + k) for k, (rt, mz) in enumerate([(50.0, 500.0), (250.0, 500.0), (250.001, 500.0), (100.0, 500.0049), (100.0, 500.006)])], "run string, charge int, rt double, scan_mz double, ordinal int, scan int")
    boxes = idents.boxes(f, 0.5)
    lists = {r.feat_id: r.ms2_scans for r in idents.scan_lists(boxes, idents.scans_in_boxes(scans, boxes, 5.0)).collect()}
    assert lists == {1: [10, 11, 13], 2: []}


def test_run_groups_and_first_wins(spark):
    df = spark.createDataFrame([("r", k, v) for k, v in enumerate(["x", "x", "y", "x", None, None])], "g string, k int, v string")
    for chunk in (1, 2, 3, 100):
        assert [r.stretch for r in idents.run_groups(df, "g", "k", "v", chunk).orderBy("k").collect()] == [1, 1, 2, 3, 4, 4]
    assert sorted(r.k for r in idents.first_wins(df, ["g"], "v", ["k"]).collect()) == [0, 2, 4]


def test_survival_and_tradeoff(spark):
    df = spark.createDataFrame([(2, 10.0, True), (0, 0.0, False)], "n int, auc double, ms2 boolean")
    c = curves.survival(df, "n", "auc", {"all": F.lit(True), "ms2": F.col("ms2")}, 100).where("variable = 'all'").orderBy("index").collect()
    assert [r["count"] for r in c[:4]] == [2, 1, 1, 0] and [r.area for r in c[:4]] == [10.0, 10.0, 10.0, 0.0] and c[3]["mean"] is None and len(c) == 100
    for a, b, want in (([1, 2, 5], [3, 2, 4], 2), ([5, 1, 1], [1, 2, 2], None), ([1, 1, 1], [2, 2, 2], None), ([5, 5, 1], [1, 1, 1], None)):
        rows = [(k, n, float(v)) for n, vs in (("a", a), ("b", b)) for k, v in enumerate(vs)]
        assert curves.tradeoff(spark.createDataFrame(rows, "index int, variable string, v double"), "v", "a", "b").first()[0] == want


def test_wide_and_coverage(spark):
    f = spark.createDataFrame([("r.1", "f1", 1, 5.0), ("r.1", "f1", 2, 6.0), ("r2", "f2", 3, 7.0), ("r2", "f9", 4, 1.0)], "run string, feature_id string, rec_id bigint, intensity double")
    e = spark.createDataFrame([("e1", "r.1", "f1"), ("e1", "r.1", "f1"), ("e1", "r2", "f2"), ("e2", "r2", "gone")], "ceid string, run string, feature_id string")
    long = consensus.looked_up(e, f)
    w = consensus.wide(long, "ceid", ["r2", "r.1"], ["intensity"])
    assert w.columns == ["ceid", "r.1_____intensity", "r2_____intensity"] and [tuple(r) for r in w.collect()] == [("e1", 5.0, 7.0)]
    assert [r.rec_id for r in consensus.uncovered(f, e).collect()] == [4]
    assert [tuple(r) for r in consensus.dangling(e, f).collect()] == [("e2", "r2", "gone")]


def test_linking_is_mutual(spark):
    kind = "feat_id bigint, run string, charge int, mz double, rt double"
    ref = spark.createDataFrame([(1, "a", 2, 500.0, 100.0), (2, "a", 2, 500.001, 100.0)], kind)
    other = spark.createDataFrame([(11, "b", 2, 500.0001, 101.0), (12, "b", 2, 500.0002, 101.0), (13, "b", 3, 500.0, 100.0), (14, "c", 2, 500.0, 131.0)], kind)
    assert sorted((r.feat_id, r.ref_id) for r in consensus.linked(other, ref, 5.0, 30.0).collect()) == [(11, 1)]


def members(rng, groups=300, size=6, missing=0.2):
    rows, truth = [], {}
    period = {f"p{k}": rng.gauss(0, 0.5) for k in range(8)}
    for g in range(groups):
        level = rng.gauss(9, 1.5)
        for k in range(size):
            rec, p = g * size + k, rng.choice(list(period))
            y = math.expm1(level + period[p] + rng.gauss(0, 0.2))
            gone = rng.random() < missing and k > 0
            truth[rec] = y
            rows.append((f"g{g}", rec, p, rng.choice([None, float("nan"), -1.0]) if gone else y))
    return rows, truth


def test_fill_beats_group_mean(spark):
    rows, truth = members(random.Random(5))
    df = spark.createDataFrame(rows, "group string, record bigint, period string, value double")
    got = {r.record: r.filled for r in fill.fill_numbers(df).collect()}
    gone = {r[1] for r in rows if r[3] is None or math.isnan(r[3]) or r[3] < 0}
    assert set(got) == gone
    by = {}
    for g, rec, _, _ in rows:
        if rec not in gone:
            by.setdefault(g, []).append(math.log1p(truth[rec]))
    group = {rec: np.mean(by[g]) for g, rec, _, _ in rows}
    rmse = lambda f: float(np.sqrt(np.mean([(f(r) - math.log1p(truth[r])) ** 2 for r in gone])))
    mixed, plain = rmse(lambda r: math.log1p(got[r])), rmse(lambda r: group[r])
    assert mixed < 0.35 and mixed < 0.7 * plain


def test_rounds_come_to_rest(spark):
    rows, _ = members(random.Random(5), groups=80)
    df = spark.createDataFrame(rows, "group string, record bigint, period string, value double")
    rough, fine = fill.fit(df), fill.fit(df, 1e-10)
    assert rough.change <= fill.TOLERANCE and fine.change <= 1e-10 and rough.rounds <= fine.rounds
    other = {r.period: r.t for r in fine.periods.collect()}
    assert all(abs(r.t - other[r.period]) < 10 * fill.TOLERANCE for r in rough.periods.collect())
    with pytest.raises(RuntimeError):
        fill.fit(df, 0.0, most=2)


def test_fill_edge_cases(spark):
    kind = "group string, record bigint, period string, value double"
    rows = [("g", 1, None, None), ("g", 2, "p", 10.0), ("g", 2, "p", 10.0), ("h", 3, "p", None), ("h", 4, "p", float("inf")), (None, 5, "p", None), ("g", 6, "q", 0.0), ("k", 1, None, 5.0), ("k", 7, None, 5.0)]
    assert {r.record for r in fill.fill_numbers(spark.createDataFrame(rows, kind)).collect()} == {1}
    assert fill.fill_numbers(spark.createDataFrame([], kind)).count() == 0
    assert fill.fill_numbers(spark.createDataFrame(rows[3:5], kind)).count() == 0


def test_fill_categories(spark):
    kind = "group string, record bigint, period string, value int"
    rows = [("g", 1, "p", None), ("g", 2, "p", 2), ("g", 3, "p", 2), ("g", 4, "p", 3), ("h", 5, "p", None), ("k", 6, "p", 3), ("k", 7, "p", 2), ("k", 8, "p", None), ("k", 9, None, None)]
    got = {r.record: r.filled for r in fill.fill_categories(spark.createDataFrame(rows, kind)).collect()}
    assert got == {1: 2, 8: 2, 9: 2}  # ties go to the period's commoner one, then to the lesser
