"""SQL for the queries of ``quant``, for an engine that casts text to nested lists."""

import numpy as np

from peakloom.operators.consensus import FULL, MINIMAL, REDUCED

LIST = (
    "try_cast(regexp_replace(regexp_replace(replace(translate(regexp_replace(regexp_replace({0}, '(?:np|numpy)\\.float64\\(([^()]*)\\)', '\\1', 'g'),"
    " 'array\\((\\[[^\\[\\]]*\\])\\)', '\\1', 'g'), '()', '[]'), '''', ''), ',\\s*\\]', ']', 'g'), 'None|null|nan|NaN', 'NULL', 'g') AS DOUBLE[][])"
)
POINTS = f"""WITH l AS (SELECT rec_id, run, {LIST.format("l_retention_times")} AS t, {LIST.format("l_mass_to_charges")} AS m, {LIST.format("l_intensities")} AS y FROM feature_tsv),
i AS (SELECT rec_id, run, k - 1 AS iso_pos, t[k] AS t, m[k] AS m, y[k] AS y
  FROM (SELECT *, unnest(range(1, least(len(t), len(m), len(y)) + 1)) AS k FROM l WHERE t IS NOT NULL AND m IS NOT NULL AND y IS NOT NULL)),
pts AS (SELECT rec_id, run, iso_pos::INT AS iso_pos, (k - 1)::INT AS point_pos, t[k] AS rt, m[k] AS mz, y[k] AS y
  FROM (SELECT *, unnest(range(1, least(len(t), len(m), len(y)) + 1)) AS k FROM i)
  WHERE t[k] IS NOT NULL AND m[k] IS NOT NULL AND y[k] IS NOT NULL)
"""
_PARTS = POINTS + """, parts AS (SELECT rec_id, iso_pos, coalesce((rt - lag(rt) OVER w) * (y + lag(y) OVER w) / 2, 0) AS part FROM pts WINDOW w AS (PARTITION BY rec_id, iso_pos ORDER BY point_pos)),
auc AS (SELECT rec_id, iso_pos, count(*) AS n, sum(part) AS auc FROM parts GROUP BY rec_id, iso_pos)
"""
_FEATURES = """WITH f AS (SELECT * FROM detected_features QUALIFY row_number() OVER (PARTITION BY run, feat_id ORDER BY loaded_at) = 1),
u AS (SELECT * FROM f WHERE intensitysum >= 0 AND NOT isnan(intensitysum) AND NOT isinf(intensitysum)),
p AS (SELECT * FROM identifications QUALIFY row_number() OVER (PARTITION BY psm_id ORDER BY loaded_at) = 1)
"""
_BOXES = _FEATURES + """, b AS (SELECT run, feat_id, charge, mz, least(rtstart * 60, rtend * 60) AS a, greatest(rtstart * 60, rtend * 60) AS b FROM f
  WHERE rtstart IS NOT NULL AND rtend IS NOT NULL AND charge IS NOT NULL),
hit AS (SELECT b.run, b.feat_id, p.psm_id AS ordinal, p.scan FROM b JOIN p ON b.run = p.run AND b.charge = p.charge
  AND p.retention_time >= b.a - (b.b - b.a) * 0.5 AND p.retention_time <= b.b + (b.b - b.a) * 0.5
  AND b.mz + b.mz / 1000000 * 5.0 >= p.exp_mass_to_charge - p.exp_mass_to_charge / 1000000 * 5.0
  AND p.exp_mass_to_charge + p.exp_mass_to_charge / 1000000 * 5.0 >= b.mz - b.mz / 1000000 * 5.0)
"""
_ATTACHED = _FEATURES + """, s AS (SELECT DISTINCT run, fdr, rec_id, intensity, unnest(regexp_extract_all(l_ms2_scans, '\\d+'))::BIGINT AS scan FROM feature_tsv),
att AS (SELECT s.rec_id, s.intensity, p.psm_id, p.plain_peptide, coalesce(p.peptide_seq, p.modified_peptide) AS raw_peptide, coalesce(p.fasta_acc, p.fasta_desc) AS proteins
  FROM s JOIN p ON s.run = p.run AND s.fdr = p.fdr AND s.scan = p.scan)
"""
_NUMS = "list_transform(regexp_extract_all({0}, '-?\\d+(?:\\.\\d+)?(?:[eE][-+]?\\d+)?'), lambda x: x::DOUBLE)"
_COLUMNS = ", ".join(f"f.{c}" for c in FULL if c not in ("intensity", "charge"))
_LONG = f"""WITH e AS (SELECT DISTINCT ceid, run, feature_id FROM consensus_edges),
long AS (SELECT e.ceid, e.run, f.rec_id, f.charge, CASE WHEN f.intensity >= 0 AND NOT isnan(f.intensity) AND NOT isinf(f.intensity) THEN f.intensity END AS intensity,
  {_COLUMNS}, (length(f.l_pep_ident) > 2)::INT AS identified, {_NUMS.format("l_mz_start")} AS ms, {_NUMS.format("l_mz_end")} AS me, {_NUMS.format("l_rt_start")} AS rs, {_NUMS.format("l_rt_end")} AS re
  FROM e JOIN feature_tsv f ON e.run = f.run AND e.feature_id = f.openms_fid
  QUALIFY row_number() OVER (PARTITION BY e.ceid, e.run ORDER BY e.feature_id, f.rec_id) = 1),
bounds AS (SELECT ceid, min(ms[1]) AS first_iso_global_min_mz, max(me[1]) AS first_iso_global_max_mz, min(rs[1]) AS first_iso_global_min_rt, max(re[1]) AS first_iso_global_max_rt,
  min(list_min(ms)) AS feature_global_min_mz, max(list_max(me)) AS feature_global_max_mz, min(list_min(rs)) AS feature_global_min_rt, max(list_max(re)) AS feature_global_max_rt
  FROM long GROUP BY ceid)
"""
_STATE = _LONG + """, st AS (SELECT ceid, (SELECT count(DISTINCT run) FROM run_manifest) - count(DISTINCT run) AS missing, sum(identified) AS identified FROM long GROUP BY ceid)
"""
_CURVE = _PARTS + """, marked AS (SELECT auc.*, coalesce(len(regexp_extract_all(l_ms2_scans, '\\d+')) > 0, false) AS ms2, coalesce(length(l_raw_pep_ident) > 2, false) AS ident FROM auc JOIN feature_tsv USING (rec_id)),
each AS (SELECT n, auc, unnest(['All Traces', CASE WHEN ms2 THEN 'Traces with MS2' ELSE 'Traces without MS2' END, CASE WHEN ident THEN 'Identified' ELSE 'Unidentified' END]) AS variable FROM marked),
spine AS (SELECT k::INT AS index, v AS variable FROM range(100) AS r(k), (SELECT unnest(['All Traces', 'Traces with MS2', 'Traces without MS2', 'Identified', 'Unidentified']) AS v)),
curve AS (SELECT s.index, s.variable, count(e.n) AS count, coalesce(sum(e.auc), 0) AS area, sum(e.auc) / nullif(count(e.n), 0) AS mean
  FROM spine s LEFT JOIN each e ON e.variable = s.variable AND least(e.n, 99) >= s.index GROUP BY s.index, s.variable)
"""
_TRADE = "SELECT '{0}' AS curve, nullif(min(a.index), 0) AS tradeoff FROM curve a JOIN curve b ON a.index = b.index AND a.variable = 'Identified' AND b.variable = 'Unidentified' WHERE a.{0} > b.{0}"
_LINK = _FEATURES + """, ref AS (SELECT arg_min(run, acquired_at) AS run FROM run_manifest),
c AS (SELECT feat_id, run, charge, mz, rtapex * 60 AS rt FROM f WHERE charge IS NOT NULL AND mz > 0 AND rtapex IS NOT NULL),
pairs AS (SELECT a.feat_id, a.run, r.feat_id AS ref_id, abs(a.mz - r.mz) / r.mz / (5.0 * 1e-6) + abs(a.rt - r.rt) / 300.0 AS gap
  FROM c a JOIN c r ON a.charge = r.charge AND abs(a.mz - r.mz) <= r.mz * (5.0 * 1e-6) AND abs(a.rt - r.rt) <= 300.0
  WHERE r.run = (SELECT run FROM ref) AND a.run <> (SELECT run FROM ref))
"""


# The runs of the test tables.
RUNS = """liverine_b01_r1_00 serumol_b01_r2_01 leafpulp_b01_r2_02 yeastac_b01_r2_03 mucosal_b01_r2_04 fibron_b01_r3_05
liverine_b02_r3_06 serumol_b02_r2_07 leafpulp_b02_r3_08 yeastac_b02_r3_09 mucosal_b02_r2_10 fibron_b02_r3_11
liverine_b03_r1_12 serumol_b03_r1_13 leafpulp_b03_r1_14 yeastac_b03_r3_15 mucosal_b03_r3_16 fibron_b03_r3_17
liverine_b04_r3_18 serumol_b04_r1_19 leafpulp_b04_r2_20 yeastac_b04_r2_21 mucosal_b04_r1_22 fibron_b04_r1_23""".split()


def _wide(headers: tuple[str, ...]) -> str:
    columns = ", ".join(f"max({h}) FILTER (run = '{r}') AS \"{r}_____{h}\"" for h in headers for r in sorted(RUNS))
    return _LONG + f", one AS (SELECT ceid, {columns} FROM long GROUP BY ceid) SELECT * FROM one JOIN bounds USING (ceid)"


_QS = ", ".join(str(k / 100) for k in range(101))

_CURVE_QS = ", ".join(f"'{q!r}'::DOUBLE" for q in np.linspace(0, 1, 1000).tolist())

SQL = {
    "trapz_auc_hof": _PARTS + "SELECT rec_id, iso_pos, n, round(auc, 6) AS auc FROM auc",
    "trapz_auc_window": _PARTS + "SELECT rec_id, iso_pos, n, round(auc, 6) AS auc FROM auc",
    "intensity_rollup": _PARTS
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY auc DESC) AS nth FROM auc)
SELECT rec_id, round(max(auc), 6) AS maximum, round(sum(auc), 6) AS sum, round(sum(auc) FILTER (nth <= 3), 6) AS top3_sum, round(avg(auc) FILTER (nth <= 3), 6) AS top3_mean FROM r GROUP BY rec_id""",
    "hull_boxes": POINTS
    + """SELECT rec_id, iso_pos, round(min(rt), 5) AS rt_start, round(max(rt), 5) AS rt_end, round(median(mz), 5) AS mz_median,
round(median(mz) - median(mz) / 1000000 * 5.0, 5) AS mz_start, round(median(mz) + median(mz) / 1000000 * 5.0, 5) AS mz_end FROM pts GROUP BY rec_id, iso_pos""",
    "feature_hills": _FEATURES
    + """, h AS (SELECT run, feat_id, list_concat([monoisotope_hill_idx], coalesce(list_transform(regexp_extract_all(isotopes, 'isotope_hill_idx\\D{1,4}(\\d+)', 1), lambda x: x::BIGINT), [])) AS hills FROM f)
SELECT run, feat_id, (k - 1)::INT AS pos, hills[k] AS hill_idx FROM (SELECT *, unnest(range(1, len(hills) + 1)) AS k FROM h)""",
    "cutoff_filter_t": _FEATURES + "SELECT run, count(*) FILTER (intensitysum >= 1000000) AS kept, round(avg((intensitysum <= 1000000)::INT), 9) AS q_cutoff FROM u GROUP BY run",
    "cutoff_filter_q": _FEATURES + ", c AS (SELECT run, quantile_cont(intensitysum, 0.05) AS cutoff FROM u GROUP BY run) SELECT u.run, feat_id FROM u JOIN c ON u.run = c.run AND intensitysum >= cutoff",
    "cutoff_curve": _FEATURES
    + f""", c AS (SELECT run, quantile_cont(intensitysum, [{_QS}]) AS v FROM u GROUP BY run)
SELECT run, (k - 1) / 100.0::DOUBLE AS q, round(v[k], 6) AS intensity FROM (SELECT *, unnest(range(1, 102)) AS k FROM c)""",
    "cutoff_curve_1000": _FEATURES
    + f""", q AS (SELECT [{_CURVE_QS}] AS qs), c AS (SELECT run, quantile_cont(intensitysum, [{_CURVE_QS}]) AS v FROM u GROUP BY run)
SELECT run, qs[k] AS q, round(v[k], 6) AS intensity FROM (SELECT *, unnest(range(1, 1001)) AS k FROM c, q)""",
    "interval_join_ms2": _BOXES + "SELECT * FROM hit",
    "feature_scan_lists": _BOXES + "SELECT b.run, b.feat_id, coalesce(string_agg(scan::VARCHAR, ',' ORDER BY ordinal, scan), '') AS scans FROM b LEFT JOIN hit ON b.run = hit.run AND b.feat_id = hit.feat_id GROUP BY b.run, b.feat_id",
    "psm_in_scan_list": _ATTACHED + "SELECT rec_id, psm_id FROM att",
    "first_wins_peptides": _ATTACHED + "SELECT rec_id, psm_id, plain_peptide, raw_peptide, proteins FROM att QUALIFY row_number() OVER (PARTITION BY rec_id, plain_peptide ORDER BY psm_id) = 1",
    "unassigned_psms": _ATTACHED + "SELECT psm_id, run, fdr FROM p WHERE psm_id NOT IN (SELECT psm_id FROM att WHERE intensity >= 10000 AND NOT isnan(intensity) AND NOT isinf(intensity))",
    "run_length_groups": _FEATURES
    + """, g AS (SELECT run, psm_id, charge, CASE WHEN row_number() OVER w > 1 AND lag(charge) OVER w IS NOT DISTINCT FROM charge THEN 0 ELSE 1 END AS s FROM p WINDOW w AS (PARTITION BY run ORDER BY psm_id)),
h AS (SELECT *, sum(s) OVER (PARTITION BY run ORDER BY psm_id) AS stretch FROM g)
SELECT run, stretch::BIGINT AS stretch, charge, count(*) AS n, min(psm_id) AS first_psm FROM h GROUP BY run, stretch, charge""",
    "consensus_lookup": _LONG + "SELECT ceid, run, rec_id FROM long",
    "coverage_anti": "SELECT run, openms_fid AS feature_id, rec_id FROM feature_tsv f WHERE NOT EXISTS (SELECT 1 FROM consensus_edges e WHERE e.run = f.run AND e.feature_id = f.openms_fid)",
    "global_bounds": _LONG + "SELECT * FROM bounds",
    "consensus_pivot_full": _wide(FULL),
    "consensus_pivot_reduced": _wide(REDUCED),
    "consensus_pivot_minimal": _wide(MINIMAL),
    "unpivot_intensities": _LONG + "SELECT ceid, run, intensity AS value FROM long WHERE intensity IS NOT NULL",
    "missing_histogram": _STATE + "SELECT missing, count(*) AS count FROM st GROUP BY missing",
    "missing_by_ident": _STATE + "SELECT missing, CASE WHEN identified = 1 THEN 'Identified' ELSE 'Unidentified' END AS exactly_one, identified > 0 AS any_run, count(*) AS count FROM st GROUP BY ALL",
    "survival_curves": _CURVE + "SELECT index, variable, count, round(area, 0) AS area, round(mean, 6) AS mean FROM curve",
    "tradeoff_points": _CURVE + _TRADE.format("count") + " UNION ALL " + _TRADE.format("mean"),
    "file_keys": _FEATURES
    + "SELECT psm_id, run || '_____qvalue_no_decoys_fdr_' || fdr AS base, run AS run_key, fdr AS fdr_key, scan AS scan_no FROM p",
    "channel_joins": _FEATURES
    + """SELECT run, fdr, psms, features FROM (SELECT run, fdr, count(*) AS psms FROM p WHERE fdr IS NOT NULL GROUP BY ALL)
JOIN (SELECT run, fdr, count(*) AS features FROM feature_tsv GROUP BY ALL) USING (run, fdr)""",
    "group_tuple": _FEATURES + "SELECT fdr, string_agg(DISTINCT run, ',' ORDER BY run) AS runs FROM p WHERE fdr IS NOT NULL GROUP BY fdr",
    "union_sources": "SELECT run, 'exported' AS kind, count(*) AS n FROM feature_tsv GROUP BY run UNION ALL SELECT run, 'delivered', count(*) FROM feature_batches GROUP BY run",
    "xic_extraction": POINTS
    + f""", w AS (SELECT rec_id, run, {_NUMS.format("l_mz_start")} AS ms, {_NUMS.format("l_mz_end")} AS me, {_NUMS.format("l_rt_start")} AS rs, {_NUMS.format("l_rt_end")} AS re FROM feature_tsv),
b AS (SELECT rec_id, run, (k - 1)::INT AS iso_pos, ms[k] AS ms, me[k] AS me, rs[k] AS rs, re[k] AS re FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM w))
SELECT b.rec_id, b.iso_pos, count(*) AS points, round(sum(pts.y), 2) AS intensity FROM b JOIN pts ON b.run = pts.run
AND pts.mz >= b.ms AND pts.mz <= b.me AND pts.rt >= b.rs AND pts.rt <= b.re GROUP BY b.rec_id, b.iso_pos""",
    "consensus_linking": _LINK
    + """SELECT feat_id, ref_id, run FROM (SELECT *, row_number() OVER (PARTITION BY feat_id ORDER BY gap, ref_id) AS a, row_number() OVER (PARTITION BY ref_id, run ORDER BY gap, feat_id) AS b FROM pairs) WHERE a = 1 AND b = 1""",
    "rt_alignment_points": _FEATURES
    + """, a AS (SELECT run, plain_peptide, charge, arg_min(retention_time, psm_id) AS rt FROM p WHERE retention_time > 0 AND plain_peptide IS NOT NULL AND charge IS NOT NULL GROUP BY ALL),
ref AS (SELECT arg_min(run, acquired_at) AS run FROM run_manifest)
SELECT a.run, a.plain_peptide, a.charge, a.rt AS original_rt, r.rt AS transformed_rt FROM a JOIN a r ON a.plain_peptide = r.plain_peptide AND a.charge = r.charge AND r.run = (SELECT run FROM ref) WHERE a.run <> (SELECT run FROM ref)""",
}
