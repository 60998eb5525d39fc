"""SQL for the queries of ``workflow``."""

from peakloom.plans.quant_sql import _CURVE_QS, _FEATURES, POINTS

_FLAT = lambda c: f"try_cast(replace({c}, '''', '') AS DOUBLE[])"
_TEXTS = lambda c, d: f"array_to_string(list_transform({c}, lambda x: coalesce(x::DECIMAL(24,{d})::VARCHAR, '-')), ' ')"
_KEPT = """, kept AS (SELECT * FROM feature_tsv WHERE intensity >= 10000 AND NOT isnan(intensity) AND NOT isinf(intensity)),
s AS (SELECT DISTINCT run, fdr, rec_id, unnest(regexp_extract_all(l_ms2_scans, '\\d+'))::BIGINT AS scan FROM kept),
att AS (SELECT s.rec_id, p.psm_id, p.plain_peptide, coalesce(p.peptide_seq, p.modified_peptide) AS raw_peptide, coalesce(p.fasta_acc, p.fasta_desc) AS proteins, p.qvalue
  FROM s JOIN p ON s.run = p.run AND s.fdr = p.fdr AND s.scan = p.scan)
"""
_QUERIES = _KEPT + f""", one AS (SELECT * FROM att QUALIFY row_number() OVER (PARTITION BY rec_id, plain_peptide ORDER BY psm_id) = 1),
ids AS (SELECT rec_id, list(plain_peptide ORDER BY psm_id) AS pep_idents, list(raw_peptide ORDER BY psm_id) AS raw_pep_idents, list(proteins ORDER BY psm_id) AS prot_idents FROM one GROUP BY rec_id),
w AS (SELECT rec_id, run, openms_fid, charge, l_ms2_scans, {_FLAT("l_mz_start")} AS ms, {_FLAT("l_mz_end")} AS me, {_FLAT("l_rt_start")} AS rs, {_FLAT("l_rt_end")} AS re FROM kept),
q AS (SELECT w.rec_id, run, (k - 1)::INT AS iso_pos, openms_fid AS identifier, ms[k] AS mz_start, me[k] AS mz_end, rs[k] / 60 AS rt_start, re[k] / 60 AS rt_end, charge,
  to_json(coalesce(pep_idents, [])) AS pep_idents, to_json(coalesce(raw_pep_idents, [])) AS raw_pep_idents, to_json(coalesce(prot_idents, [])) AS prot_idents,
  to_json(list_transform(regexp_extract_all(l_ms2_scans, '\\d+'), lambda x: x::BIGINT)) AS ms2_scans
  FROM (SELECT *, unnest(range(1, greatest(coalesce(len(ms), 0), coalesce(len(me), 0), coalesce(len(rs), 0), coalesce(len(re), 0)) + 1)) AS k FROM w) w LEFT JOIN ids USING (rec_id))
"""


def _round(n: int) -> str:
    """One round of linking: what is left, the earliest run around each cell, its seeds, and who joins them."""
    left = "c0" if n == 1 else f"c{n - 1}"
    near = "(SELECT unnest([-1, 0, 1]) AS dt), (SELECT unnest([-1, 0, 1]) AS dm)"
    return f""", f{n} AS MATERIALIZED (SELECT charge, t + dt AS t, m + dm AS m, min(nth) AS first FROM (SELECT charge, t, m, min(nth) AS nth FROM {left} GROUP BY ALL), {near} GROUP BY ALL),
k{n} AS MATERIALIZED (SELECT c.*, first FROM {left} c JOIN f{n} USING (charge, t, m)),
s{n} AS MATERIALIZED (SELECT charge, t + dt AS t, m + dm AS m, run, feat_id, nth, mz, rt FROM k{n}, {near} WHERE nth = first),
p{n} AS MATERIALIZED (SELECT k.run, k.feat_id, s.run AS seed_run, s.feat_id AS seed_id, abs(k.mz - s.mz) / s.mz / (5.0 * 1e-6) + abs(k.rt - s.rt) / 300.0 AS gap FROM k{n} k JOIN s{n} s USING (charge, t, m)
  WHERE k.nth > k.first AND k.nth <> s.nth AND abs(k.mz - s.mz) / s.mz / (5.0 * 1e-6) <= 1 AND abs(k.rt - s.rt) / 300.0 <= 1),
m{n} AS MATERIALIZED (SELECT run, feat_id, run AS seed_run, feat_id AS seed_id FROM k{n} WHERE nth = first
  UNION ALL SELECT run, feat_id, seed_run, seed_id FROM (SELECT *, row_number() OVER (PARTITION BY run, feat_id ORDER BY gap, seed_run, seed_id) AS a,
    row_number() OVER (PARTITION BY seed_run, seed_id, run ORDER BY gap, feat_id) AS b FROM p{n}) WHERE a = 1 AND b = 1),
c{n} AS MATERIALIZED (SELECT * FROM {left} c WHERE NOT EXISTS (SELECT 1 FROM m{n} m WHERE m.run = c.run AND m.feat_id = c.feat_id))
"""


_ROUNDS = 5  # more than the tables the SQL is run on need
_ELEMENTS = (
    _FEATURES
    + """, o AS (SELECT run, row_number() OVER (ORDER BY acquired_at, run) AS nth FROM run_manifest),
c0 AS MATERIALIZED (SELECT feat_id, run, nth, charge, mz, rtapex * 60 AS rt, floor(rtapex * 60 / 300.0)::BIGINT AS t, floor(ln(mz) / (2e-6 * 5.0))::BIGINT AS m FROM f JOIN o USING (run) WHERE charge IS NOT NULL AND mz > 0 AND rtapex IS NOT NULL)
"""
    + "".join(_round(n) for n in range(1, _ROUNDS + 1))
)
SQL = {
    "cutoff_report": _FEATURES
    + f""", qs AS (SELECT [{_CURVE_QS}] AS qs), c AS (SELECT run, quantile_cont(intensitysum, [{_CURVE_QS}]) AS v, quantile_cont(intensitysum, 0.05) AS i, min(intensitysum) AS least FROM u GROUP BY run)
SELECT run, qs[k] AS q, round(v[k], 6) AS intensity, 0.05::DOUBLE AS q_cutoff, round(i, 6) AS i_cutoff, least FROM (SELECT *, unnest(range(1, 1001)) AS k FROM c, qs)""",
    "annotated_features": _FEATURES + _KEPT
    + """, b AS (SELECT kept.rec_id, psm_id FROM kept LEFT JOIN att USING (rec_id) UNION ALL SELECT NULL, psm_id FROM p WHERE psm_id NOT IN (SELECT psm_id FROM att))
SELECT rec_id, b.psm_id, plain_peptide, qvalue, CASE WHEN b.psm_id IS NOT NULL THEN 'q-value' END AS score_type, CASE WHEN b.psm_id IS NOT NULL THEN 1 END AS hit_rank FROM b LEFT JOIN p ON b.psm_id = p.psm_id""",
    "xic_queries": _FEATURES + _QUERIES
    + """SELECT rec_id, iso_pos, identifier, mz_start, mz_end, rt_start, rt_end, NULL::DOUBLE AS mz, NULL::DOUBLE AS ppm, 'ms' AS ms_level, charge, pep_idents::VARCHAR AS pep_idents,
raw_pep_idents::VARCHAR AS raw_pep_idents, prot_idents::VARCHAR AS prot_idents, ms2_scans::VARCHAR AS ms2_scans FROM q""",
    "xic_arrays": POINTS + _FEATURES.replace("WITH f", ", f", 1) + _QUERIES
    + f""", hit AS (SELECT q.rec_id, q.iso_pos, pts.rt, sum(pts.y) AS y, arg_max(pts.mz, {{'y': pts.y, 'mz': pts.mz}}) AS mz FROM q JOIN pts ON q.run = pts.run
  AND pts.mz >= q.mz_start AND pts.mz <= q.mz_end AND pts.rt >= q.rt_start * 60 AND pts.rt <= q.rt_end * 60 GROUP BY q.rec_id, q.iso_pos, pts.rt),
xl AS (SELECT rec_id, iso_pos, list(rt ORDER BY rt) AS t, list(mz ORDER BY rt) AS m, list(y ORDER BY rt) AS y FROM hit GROUP BY rec_id, iso_pos)
SELECT q.rec_id, q.iso_pos, coalesce({_TEXTS("t", 3)}, '') AS retention_times, coalesce({_TEXTS("m", 5)}, '') AS mass_to_charge, coalesce({_TEXTS("y", 2)}, '') AS intensities FROM q LEFT JOIN xl USING (rec_id, iso_pos)""",
    "quantified_features": POINTS + _FEATURES.replace("WITH f", ", f", 1) + _QUERIES
    + f""", tr AS (SELECT rec_id, iso_pos, list(rt ORDER BY point_pos) AS t, list(mz ORDER BY point_pos) AS m, list(y ORDER BY point_pos) AS y, sum(part) AS auc
  FROM (SELECT *, coalesce((rt - lag(rt) OVER w) * (y + lag(y) OVER w) / 2, 0) AS part FROM pts WINDOW w AS (PARTITION BY rec_id, iso_pos ORDER BY point_pos)) GROUP BY rec_id, iso_pos),
j AS (SELECT q.*, coalesce(t, []) AS t, coalesce(m, []) AS m, coalesce(y, []) AS y, coalesce(auc, 0) AS auc, row_number() OVER (PARTITION BY q.rec_id ORDER BY coalesce(auc, 0) DESC) AS top FROM q LEFT JOIN tr USING (rec_id, iso_pos))
SELECT rec_id, any_value(identifier) AS openms_fid, round(sum(auc) FILTER (top <= 3), 4) AS intensity, any_value(charge) AS charge, any_value(pep_idents)::VARCHAR AS l_pep_ident, any_value(raw_pep_idents)::VARCHAR AS l_raw_pep_ident,
any_value(prot_idents)::VARCHAR AS l_prot_ident, any_value(ms2_scans)::VARCHAR AS l_ms2_scans,
{_TEXTS("list(mz_start ORDER BY iso_pos)", 5)} AS l_mz_start, {_TEXTS("list(mz_end ORDER BY iso_pos)", 5)} AS l_mz_end, {_TEXTS("list(rt_start * 60 ORDER BY iso_pos)", 3)} AS l_rt_start, {_TEXTS("list(rt_end * 60 ORDER BY iso_pos)", 3)} AS l_rt_end,
string_agg({_TEXTS("t", 4)}, '; ' ORDER BY iso_pos) AS l_retention_times, string_agg({_TEXTS("m", 5)}, '; ' ORDER BY iso_pos) AS l_mass_to_charges, string_agg({_TEXTS("y", 4)}, '; ' ORDER BY iso_pos) AS l_intensities FROM j GROUP BY rec_id""",
    "trace_counts": POINTS
    + """, t AS (SELECT run, rec_id, count(DISTINCT iso_pos) AS traces FROM pts GROUP BY run, rec_id)
SELECT f.run, fdr, count(*) AS features, count(t.rec_id) AS traced, coalesce(sum(traces), 0)::BIGINT AS traces FROM feature_tsv f LEFT JOIN t ON f.rec_id = t.rec_id GROUP BY f.run, fdr""",
    "dangling_edges": "SELECT DISTINCT ceid, run, feature_id FROM consensus_edges e WHERE NOT EXISTS (SELECT 1 FROM feature_tsv f WHERE f.run = e.run AND f.openms_fid = e.feature_id)",
    "consensus_elements": _ELEMENTS + " UNION ALL ".join(f"SELECT run, feat_id, seed_run, seed_id FROM m{n}" for n in range(1, _ROUNDS + 1)),
    "rt_aligned": _FEATURES
    + """, a AS (SELECT run, plain_peptide, charge, arg_min(retention_time, psm_id) AS rt FROM p WHERE retention_time > 0 AND plain_peptide IS NOT NULL AND charge IS NOT NULL GROUP BY ALL),
ref AS (SELECT arg_min(run, acquired_at) AS run FROM run_manifest),
anchors AS (SELECT a.run, a.rt AS x, avg(r.rt) AS y FROM a JOIN a r ON a.plain_peptide = r.plain_peptide AND a.charge = r.charge AND r.run = (SELECT run FROM ref) WHERE a.run <> (SELECT run FROM ref) GROUP BY a.run, a.rt),
mono AS (SELECT run, x, max(y) OVER (PARTITION BY run ORDER BY x) AS y FROM anchors),
seg AS (SELECT run, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2, row_number() OVER w AS nth FROM mono WINDOW w AS (PARTITION BY run ORDER BY x)),
own AS (SELECT run, feat_id, rtapex * 60 AS rt FROM f),
met AS (SELECT own.run, own.feat_id, own.rt, seg.x, seg.y, seg.x2, seg.y2 FROM own ASOF LEFT JOIN seg ON own.run = seg.run AND own.rt >= seg.x),
first AS (SELECT run, x, y FROM seg WHERE nth = 1)
SELECT met.run, feat_id, rt, round(CASE WHEN met.x IS NOT NULL THEN met.y + (rt - met.x) * coalesce((y2 - met.y) / (x2 - met.x), 1) WHEN first.x IS NOT NULL THEN first.y + (rt - first.x) ELSE rt END, 6) AS aligned
FROM met LEFT JOIN first ON met.run = first.run""",
}
