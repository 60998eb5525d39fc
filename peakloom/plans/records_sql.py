"""SQL for the flat tables of ``records``."""

from peakloom.plans.quant_sql import LIST, POINTS

_T, _M, _Y = "l_retention_times", "l_mass_to_charges", "l_intensities"
_V = lambda c: f"try_cast({c}->>(k - 1)::INT AS DOUBLE)"
_O = lambda c: f"try_cast(x->('$['||(k - 1)||']')->>'{c}' AS DOUBLE)"
_LEN = "greatest(0, least(coalesce(json_array_length(t), 0), coalesce(json_array_length(m), 0), coalesce(json_array_length(y), 0)))"
ALL_POINTS = POINTS + f""",
fb AS (SELECT batch_id AS rec_id, k - 1 AS feature_pos, json_extract(payload, '$.features['||(k - 1)||']') AS f
  FROM (SELECT *, unnest(range(1, coalesce(json_array_length(payload, '$.features'), 0)::BIGINT + 1)) AS k FROM feature_batches WHERE json_valid(payload))),
io AS (SELECT rec_id, feature_pos, k - 1 AS iso_pos, json_extract(f, '$.isotopes['||(k - 1)||'].xic') AS x
    FROM (SELECT *, unnest(range(1, json_array_length(f, '$.isotopes')::BIGINT + 1)) AS k FROM fb WHERE json_type(f, '$.isotopes') = 'ARRAY')
  UNION ALL SELECT rec_id, feature_pos, key::BIGINT, json_extract(f, '$.isotopes."'||key||'".xic')
    FROM (SELECT *, unnest(json_keys(f, '$.isotopes')) AS key FROM fb WHERE json_type(f, '$.isotopes') = 'OBJECT')),
li AS (SELECT rec_id, feature_pos, iso_pos, x->'{_T}' AS t, x->'{_M}' AS m, x->'{_Y}' AS y FROM io WHERE json_type(x) = 'OBJECT'
  UNION ALL SELECT rec_id, feature_pos, k - 1, json_extract(t, '$['||(k - 1)||']'), json_extract(m, '$['||(k - 1)||']'), json_extract(y, '$['||(k - 1)||']')
    FROM (SELECT *, unnest(range(1, {_LEN}::BIGINT + 1)) AS k FROM (SELECT rec_id, feature_pos, f->'{_T}' AS t, f->'{_M}' AS m, f->'{_Y}' AS y FROM fb))),
vals AS (SELECT rec_id, feature_pos, iso_pos, k - 1 AS point_pos, {_V("t")} AS rt, {_V("m")} AS mz, {_V("y")} AS y FROM (SELECT *, unnest(range(1, {_LEN}::BIGINT + 1)) AS k FROM li)
  UNION ALL SELECT rec_id, feature_pos, iso_pos, k - 1, {_O(_T)}, {_O(_M)}, {_O(_Y)} FROM (SELECT *, unnest(range(1, json_array_length(x)::BIGINT + 1)) AS k FROM io WHERE json_type(x) = 'ARRAY')),
allp AS (SELECT 'feature_tsv' AS src_table, rec_id, 0 AS feature_pos, iso_pos, point_pos, y FROM pts
  UNION ALL SELECT 'feature_batches', rec_id, feature_pos::INT, iso_pos::INT, point_pos::INT, y FROM vals
    WHERE rt IS NOT NULL AND mz IS NOT NULL AND y IS NOT NULL AND NOT isnan(rt) AND NOT isnan(mz) AND NOT isnan(y))
"""
_FLAT = lambda c: f"try_cast(replace({c}, '''', '') AS DOUBLE[])"
_AT = lambda t: f"list_distinct([k FOR k IN range(0, len({t})) IF {t}[k + 1] IS NOT NULL])"
_HELD = ("mz_start", "mz_end", "rt_start", "rt_end")
ISOTOPES = f"""{ALL_POINTS}, wl AS (SELECT rec_id, {", ".join(f"{_FLAT('l_' + c)} AS {c}" for c in _HELD)},
  {", ".join(f"{LIST.format(c)} AS {c}" for c in (_T, _M, _Y))} FROM feature_tsv),
wk AS (SELECT *, unnest(list_distinct(list_concat(range(0, greatest({", ".join(f"coalesce(len({c}), 0)" for c in _HELD)})), {", ".join(f"coalesce({_AT(c)}, [])" for c in (_T, _M, _Y))}))) AS k FROM wl),
ij AS (SELECT rec_id, feature_pos, k - 1 AS iso_pos, json_extract(f, '$.isotopes['||(k - 1)||']') AS i
    FROM (SELECT *, unnest(range(1, json_array_length(f, '$.isotopes')::BIGINT + 1)) AS k FROM fb WHERE json_type(f, '$.isotopes') = 'ARRAY')
  UNION ALL SELECT rec_id, feature_pos, key::BIGINT, json_extract(f, '$.isotopes."'||key||'"')
    FROM (SELECT *, unnest(json_keys(f, '$.isotopes')) AS key FROM fb WHERE json_type(f, '$.isotopes') = 'OBJECT')),
tj AS (SELECT DISTINCT rec_id, feature_pos, k - 1 AS iso_pos
  FROM (SELECT rec_id, feature_pos, l, unnest(range(1, json_array_length(l)::BIGINT + 1)) AS k FROM (SELECT rec_id, feature_pos, unnest([f->'{_T}', f->'{_M}', f->'{_Y}']) AS l FROM fb) WHERE json_type(l) = 'ARRAY')
  WHERE json_type(l, '$['||(k - 1)||']') = 'ARRAY')
"""
_WINDOW = lambda c: f"try_cast(coalesce(i->'window'->>'{c}', i->>'{c}') AS DOUBLE) AS {c}"
_LEFT_OUT = "SELECT 'feature_tsv' AS src_table, rec_id, '{0}' AS cell, CASE WHEN trim(coalesce({0}, '')) = '' THEN 'missing' ELSE 'ends early' END AS reason FROM feature_tsv WHERE trim(coalesce({0}, '')) = '' OR {1}"
SQL = {
    "p1_found": ALL_POINTS + "SELECT src_table, rec_id, feature_pos, iso_pos, point_pos FROM allp",
    "p1_trace_sums": ALL_POINTS + "SELECT src_table, rec_id, feature_pos, iso_pos, count(*) AS points, max(y) AS top_intensity FROM allp GROUP BY ALL",
    "p1_features": ALL_POINTS
    + """SELECT 'feature_tsv' AS src_table, rec_id, 0 AS feature_pos, openms_fid, charge FROM feature_tsv
UNION ALL SELECT 'feature_batches', rec_id, feature_pos::INT, f->>'openms_fid', try_cast(f->>'charge' AS INT) FROM fb WHERE json_type(f) = 'OBJECT'""",
    "p1_isotopes": ISOTOPES
    + f"""SELECT 'feature_tsv' AS src_table, rec_id, 0 AS feature_pos, k::INT AS iso_pos, {", ".join(f"{c}[k + 1] AS {c}" for c in _HELD)} FROM wk
UNION ALL SELECT 'feature_batches', rec_id, feature_pos::INT, iso_pos::INT, {", ".join(map(_WINDOW, _HELD))} FROM ij WHERE json_type(i) = 'OBJECT'
UNION ALL SELECT 'feature_batches', rec_id, feature_pos::INT, iso_pos::INT, NULL, NULL, NULL, NULL FROM tj""",
    "p1_rejected": " UNION ALL ".join(
        [_LEFT_OUT.format(f"l_{c}", f"NOT regexp_matches(l_{c}, '[\\])]\\s*$')") for c in _HELD] + [_LEFT_OUT.format(c, f"{LIST.format(c)} IS NULL") for c in (_T, _M, _Y)]
    )
    + """ UNION ALL SELECT 'feature_batches', batch_id, 'payload', CASE WHEN trim(coalesce(payload, '')) = '' THEN 'missing' ELSE 'ends early' END FROM feature_batches WHERE payload IS NULL OR NOT json_valid(payload)""",
}
