import random

import pytest
from pyspark.sql import functions as F

from peakloom.config import QuantConfig
from peakloom.operators import align, consensus, hills, xic
from peakloom.sinks import files
from peakloom.sources import delimited


def test_config():
    assert QuantConfig().protein_column == "fasta_acc" and QuantConfig.of({"graph_search": "true", "ppm_tolerance": "7"}) == QuantConfig(graph_search=True, ppm_tolerance=7.0)
    for bad in ({"intensity_method": "mode"}, {"charge_low": "9"}, {"ppm_tolerance": "0"}, {"cutoff": "x1"}, {"colour": "red"}, {"rt_enlarge_factor": "-1"}):
        with pytest.raises(ValueError):
            QuantConfig.of(bad)


def test_hills_are_found_in_order(spark):
    f = spark.createDataFrame([("f1", "r", [7, 5]), ("f2", "r", [5])], "fid string, run string, hills array<bigint>")
    h = spark.createDataFrame([("r", 5, 1.0, 2.0, [500.0, 502.0]), ("r", 7, 3.0, 4.0, [600.0])], "run string, hill_idx bigint, rt_start double, rt_end double, mz_values array<double>")
    got = {r.fid: r for r in hills.with_hills(f, h, ["fid"], 10.0).collect()}
    assert got["f1"].mz == 600.0 and [x.hill_idx for x in got["f1"].hulls] == [7, 5] and got["f2"].mz == 501.0
    assert (got["f1"].hulls[0].rt_start, got["f1"].hulls[0].rt_end, round(got["f1"].hulls[0].mz_end, 6)) == (180.0, 240.0, 600.006)
    with pytest.raises(Exception, match="no hill 5 in run r"):
        hills.with_hills(f, h.where("hill_idx = 7"), ["fid"]).collect()


def test_queries_and_quantified_rows(spark, tmp_path):
    kind = "array<struct<iso_pos: int, mz_start: double, mz_end: double, rt_start: double, rt_end: double>>"
    f = spark.createDataFrame([(1, "f_1", 2, [5, 6], [(0, 500.0, 500.1, 60.0, 120.0), (1, 500.5, 500.6, 60.0, 120.0)]), (2, "f_2", None, [], [(0, 700.0, 700.1, 0.0, 6.0)])], f"k int, identifier string, charge int, ms2_scans array<bigint>, windows {kind}")
    psms = spark.createDataFrame([(1, 9, "B", "b", None), (1, 4, "A", "a", "P1")], "k int, psm_id bigint, plain_peptide string, raw_peptide string, proteins string")
    q = xic.queries(f, xic.ident_lists(psms, ["k"]), ["k"])
    assert tuple(q.columns) == ("k", "iso_pos", *xic.QUERY)
    first = q.where("k = 1 AND iso_pos = 0").first()
    assert (first.rt_start, first.rt_end, first.mz, first.ppm, first.ms_level, first.pep_idents, first.prot_idents) == (1.0, 2.0, None, None, "ms", ["A", "B"], ["P1", None])
    files.delimited(q.drop("k", "iso_pos"), str(tmp_path / "q"), sep=",")
    back = delimited.delimited(spark, str(tmp_path / "q"), delimited.QUERIES, sep=",").where("mz_start = 500.5").first()
    assert (back.identifier, back.rt_end, back.charge, back.pep_idents, back.ms2_scans) == ("f_1", 2.0, 2, '["A","B"]', "[5,6]")

    peaks = spark.createDataFrame([("r", 61.0, 500.05, 10.0), ("r", 61.0, 500.06, 5.0), ("r", 60.0, 500.0, 1.0), ("r", 120.001, 500.05, 9.0), ("s", 61.0, 500.05, 9.0), ("r", 62.0, 500.55, 4.0)], "run string, rt double, mz double, intensity double")
    boxes = q.withColumn("run", F.lit("r")).withColumns({c: F.col(c) * 60 for c in ("rt_start", "rt_end")})
    for how, both in (("sum", 15.0), ("max", 10.0)):
        arrays = xic.extracted(peaks, boxes, ["k", "iso_pos"], how)
        got = {(r.k, r.iso_pos): (r.retention_times, r.mass_to_charge, r.intensities) for r in arrays.collect()}
        assert got == {(1, 0): ([60.0, 61.0], [500.0, 500.05], [1.0, both]), (1, 1): ([62.0], [500.55], [4.0]), (2, 0): ([], [], [])}
    rows = {r.k: r for r in xic.quantified(q, arrays, ["k"], "sum").collect()}
    assert tuple(rows[1].asDict())[1:] == xic.QUANTIFIED and len(xic.QUANTIFIED) == 14 and len(xic.QUERY) == 13
    assert (rows[1].intensity, rows[1].l_rt_end, rows[1].l_intensities, rows[1].l_mz_start) == (5.5, [120.0, 120.0], [[1.0, 10.0], [4.0]], ["500.0", "500.5"])
    assert (rows[2].intensity, rows[2].charge, rows[2].l_pep_ident, rows[2].l_intensities) == (0.0, None, [], [[]])
    with pytest.raises(ValueError):
        xic.extracted(peaks, boxes, ["k", "iso_pos"], "mean")


def test_times_are_aligned(spark):
    anchors = spark.createDataFrame([("a", 10.0, 12.0), ("a", 20.0, 11.0), ("a", 30.0, 42.0), ("a", 30.0, 44.0), ("a", None, 1.0)], "run string, x double, y double")
    rows = [("a", k, t) for k, t in enumerate([5.0, 10.0, 15.0, 20.0, 25.0, 30.0, 40.0, None, float("nan")])] + [("b", 9, 7.0)]
    got = {r.id: r.aligned for r in align.aligned(spark.createDataFrame(rows, "run string, id int, t double"), "t", anchors, 4.0).collect()}
    assert got == {0: 7.0, 1: 12.0, 2: 12.0, 3: 12.0, 4: 27.5, 5: 43.0, 6: 53.0, 7: None, 8: None, 9: 7.0}


def brute_elements(rows, ppm, window):
    """Rounds over what is left: seeds of the earliest run in the nine cells around, mutual nearest neighbours."""
    import math

    cell = lambda r: (r[3], math.floor(r[5] / window), math.floor(math.log(r[4]) / (2e-6 * ppm)))
    left, out = {(r[1], r[0]): r for r in rows}, {}
    while left:
        around = {}
        for r in left.values():
            c, t, m = cell(r)
            for dt in (-1, 0, 1):
                for dm in (-1, 0, 1):
                    key = (c, t + dt, m + dm)
                    around[key] = min(around.get(key, r[2]), r[2])
        seeds = [r for r in left.values() if r[2] == around[cell(r)]]
        pairs = []
        for r in left.values():
            for s in seeds:
                if r[2] > around[cell(r)] and r[2] != s[2] and r[3] == s[3]:
                    a, b = abs(r[4] - s[4]) / s[4] / (ppm * 1e-6), abs(r[5] - s[5]) / window
                    if a <= 1 and b <= 1:
                        pairs.append((a + b, (s[1], s[0]), (r[1], r[0])))
        found = {(s[1], s[0]): (s[1], s[0]) for s in seeds}
        for gap, s, r in pairs:
            if (gap, s) == min((g, x) for g, x, y in pairs if y == r) and (gap, r) == min((g, y) for g, x, y in pairs if x == s and y[0] == r[0]):
                found[r] = s
        out |= found
        left = {k: r for k, r in left.items() if k not in found}
    return out


def test_elements_span_runs(spark):
    rng = random.Random(2)
    rows = []
    for ion in range(40):
        mz, rt, z = rng.uniform(500, 500.1), rng.uniform(0, 900), rng.choice([2, 3])
        for nth in range(5):
            if rng.random() < 0.7:
                rows.append((len(rows), f"r{nth}", nth, z, mz * (1 + rng.gauss(0, 1.5e-6)), rt + rng.gauss(0, 20)))
    df = spark.createDataFrame(rows, "feat_id bigint, run string, nth int, charge int, mz double, rt double")
    got = consensus.elements(df, 5.0, 60.0).collect()
    assert {(r.run, r.feat_id): (r.seed_run, r.seed_id) for r in got} == brute_elements(rows, 5.0, 60.0) and len(got) == len(rows)
    members = [(r.seed_run, r.seed_id, r.run) for r in got]
    assert len(set(members)) == len(members) and any(r.seed_run not in ("r0",) and r.seed_run != r.run for r in got)
    assert consensus.elements(df.where("false"), 5.0, 60.0).count() == 0


def test_elements_of_strips(spark):
    """Strips down to one block and passes of one round give what all features at once give."""
    rng = random.Random(5)
    rows = []
    for k in range(1200):
        nth = rng.randrange(14)
        rows.append((k, f"r{nth}", nth, rng.choice([2, 3]), 500 * (1 + rng.uniform(0, 4e-4)), rng.uniform(0, 500)))
    df, want = spark.createDataFrame(rows, "feat_id bigint, run string, nth int, charge int, mz double, rt double"), brute_elements(rows, 5.0, 60.0)
    for how in ((1, 1), (2, 30), (8, 50_000)):
        got = consensus.elements(df, 5.0, 60.0, *how).collect()
        assert {(r.run, r.feat_id): (r.seed_run, r.seed_id) for r in got} == want and len(got) == len(rows)
    odd = df.unionByName(spark.createDataFrame([(-1, "r1", 1, 2, float("nan"), 1.0), (-2, "r2", 2, 2, float("inf"), 1.0), (-3, "r3", 3, 2, 500.0, float("inf")), (-4, "r4", 4, 2, 500.0, -float("inf"))], df.schema))
    got = {(r.run, r.feat_id): (r.seed_run, r.seed_id) for r in consensus.elements(odd, 5.0, 60.0).collect()}
    assert got == want | {k: k for k in (("r1", -1), ("r2", -2), ("r3", -3), ("r4", -4))}


def test_elements_write_few_tables(spark, monkeypatch):
    """A run more on the ladder is a round more; the tables written and planned for are one for eight of them."""
    rows = [(k, f"r{k:02}", k, 2, 500 * (1 + 6e-6 * k), 30.0) for k in range(24)]
    df, written = spark.createDataFrame(rows, "feat_id bigint, run string, nth int, charge int, mz double, rt double"), []
    monkeypatch.setattr(consensus, "staged", lambda df, real=consensus.staged: written.append(1) or real(df))
    got = consensus.elements(df, 5.0, 60.0).collect()
    assert {(r.run, r.feat_id): (r.seed_run, r.seed_id) for r in got} == brute_elements(rows, 5.0, 60.0) and len(got) == len(rows)
    assert len(written) <= 4
