import json
import math
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.oracle import SMALL

from peakloom.functions.literals import Broken, number, numbers, scan
from peakloom.operators.nested import Flat, flatten, rejected
from peakloom.plans.records import ALL_ISOTOPES, FEATURES, ISOTOPES, POINTS, QUERIES, TRACES, _cells


def test_scan_names_paths_and_positions():
    got = scan('{"a": [{"b": {"3": {"c": [1, 2]}}}, null], "d": "x\\u00e9"}')
    assert got == [("a[].b{}.c[]", (0, 3), ["1", " 2"]), ("a[]", (1,), "null"), ("d", (), "xé")]


@pytest.mark.parametrize("text", [None, "", "  ", "[[1, 2], [3", "[1, 2}", '{"a": 1', '{"a" 1}', "[[1], [2]] [", "[" * 5000])
def test_broken_texts(text):
    with pytest.raises(Broken):
        scan(text)


@pytest.mark.parametrize(
    "text",
    ["[[1.5, nan], [2]]", "[array([1.5, nan]), array([2])]", "((1.5, nan), (2,))", "[[np.float64(1.5), np.float64(nan)], [np.float64(2)]]", "[['1.5', 'nan'], ['2']]", " [[1.5 ,\tnan] ,\t[2]] "],
)
def test_writers_agree(text):
    got = scan(text)
    assert [(p, o, [number(v) if not math.isnan(number(v)) else None for v in vs]) for p, o, vs in got] == [("[][]", (0,), [1.5, None]), ("[][]", (1,), [2.0])]


def test_depth_has_no_limit():
    deep = scan("[" * 5000 + "1, [2]" + "]" * 5000)
    assert [(len(p), o[-1], v) for p, o, v in deep] == [(10_000, 0, "1"), (10_002, 1, ["2"])]
    deep = scan('{"a": ' * 5000 + "7" + "}" * 5000)
    assert [(p.count("a"), v) for p, _, v in deep] == [(5000, "7")]
    assert scan("f(" * 3000 + "[1]" + ")" * 3000) == [("[]", (), ["1"])]


def test_number_keys_of_any_length():
    assert scan('{"isotopes": {"123456789012": {"x": 1}}}') == [("isotopes{}.x", (123456789012,), "1")]
    with pytest.raises(Broken, match="key too large"):
        scan('{"1234567890123456789": 1}')
    assert scan('{"[]": {"{}": 1}, "": 2}') == [("[].{}", (), "1"), ("", (), "2")]


def test_grouped_digits_are_no_number():
    assert math.isnan(number("1_000")) and [x if x == x else None for x in numbers(["1", "1_0", "x"])] == [1.0, None, None]


def test_why_texts_are_rejected(spark):
    rows = [(1, "[1]", "[[1"), (2, None, ""), (3, "{'a' 1}", '{"12345678901234567890": 1}'), (4, "[]", "{}")]
    got = rejected(spark.createDataFrame(rows, "rec bigint, a string, b string").selectExpr("*", "1 AS cell"), "rec", ("a", "b")).collect()
    assert sorted(map(tuple, got)) == [(1, "b", "ends early"), (2, "a", "missing"), (2, "b", "missing"), (3, "a", "malformed"), (3, "b", "key too large")]


nested = st.recursive(st.none() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.sampled_from("abc"), x, max_size=3), max_leaves=12)


def leaves(x, path="", ords=()):
    if isinstance(x, dict):
        return [y for k, v in x.items() for y in leaves(v, f"{path}.{k}" if path else k, ords)]
    if isinstance(x, list):
        return [y for k, v in enumerate(x) for y in leaves(v, path + "[]", (*ords, k))]
    return [(path, ords, x)]


@settings(max_examples=500, deadline=None)
@given(nested)
def test_scan_finds_every_leaf(x):
    flat = []
    for path, ords, v in scan(json.dumps(x)):
        flat += [(path, (*ords, k), t.strip()) for k, t in enumerate(v)] if isinstance(v, list) else [(path, ords, v)]
    want = [(p, o, "null" if v is None else v if isinstance(v, str) else json.dumps(v)) for p, o, v in leaves(x)]
    bare = lambda rows: [(p, o, t.strip()) for p, o, t in rows]
    assert bare(flat) == bare(want)


def test_points_of_dirty_records(spark):
    cells = "rec_id bigint, l_retention_times string, l_mass_to_charges string, l_intensities string, feature_pos int, point_pos string"
    ok = "[[1.0, 2.0, 3.0], [], [4]]"
    rows = [
        (1, ok, "[[1, None, 3], [], [4, 5]]", "((1, 2, 3), (), (inf,))", 9, "clash"),
        (2, ok, None, ok, 9, ""),
        (3, ok, "", ok, 9, ""),
        (4, ok, ok[:-4], ok, 9, ""),
        (5, "[None, [1]]", "[None, [1]]", "[[7], [1]]", 9, ""),
        (5, "[None, [1]]", "[None, [1]]", "[[7], [1]]", 9, ""),
        (None, "[[1]]", "[[1]]", "[['1e3']]", 9, ""),
        (7, "[]", "[]", "[]", 9, ""),
    ]
    df = flatten(spark.createDataFrame(rows, cells), "rec_id", _cells(TRACES), POINTS)
    got = sorted(((r.rec_id or 0), r.feature_pos, r.iso_pos, r.point_pos, r.intensity) for r in df.collect())
    assert got == [(0, 0, 0, 0, 1000.0), (1, 0, 0, 0, 1.0), (1, 0, 0, 2, 3.0), (5, 0, 1, 0, 1.0), (5, 0, 1, 0, 1.0)]
    assert flatten(spark.createDataFrame([], cells), "rec_id", _cells(TRACES), POINTS).count() == 0


def test_shapes_of_payloads(spark):
    xic = {"l_retention_times": [1, 2], "l_mass_to_charges": [1, None], "l_intensities": [5, 6]}
    listed = [{"l_retention_times": 1, "l_mass_to_charges": 2, "l_intensities": 3}, None, {"l_retention_times": 1, "l_mass_to_charges": "2", "l_intensities": 4}]
    features = [
        {"openms_fid": "a", "charge": 2, "isotopes": [{"window": {"mz_start": "1.5", "mz_end": "2"}, "xic": xic}, {"xic": None}, {"xic": listed}]},
        None,
        {"openms_fid": "b", "charge": None, "isotopes": {"4": {"xic": xic}}},
        {"openms_fid": "c", "l_retention_times": [[1], [2]], "l_mass_to_charges": [[1], None], "l_intensities": [[1], [2]]},
        {"openms_fid": "d", "isotopes": []},
    ]
    df = spark.createDataFrame([(1, json.dumps({"run": "r", "features": features})), (2, json.dumps({"features": features})[:-9]), (3, "{}"), (4, '{"features": null}')], "rec_id bigint, payload string")
    get = lambda spec, *cols: sorted(tuple(r[c] for c in cols) for r in flatten(df, "rec_id", {"payload": ("", ())}, spec).collect())
    assert get(POINTS, "rec_id", "feature_pos", "iso_pos", "point_pos") == [(1, 0, 0, 0), (1, 0, 2, 0), (1, 0, 2, 2), (1, 2, 4, 0), (1, 3, 0, 0)]
    assert get(FEATURES, "feature_pos", "openms_fid") == [(0, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert get(ISOTOPES, "feature_pos", "iso_pos", "mz_start", "mz_end") == [(0, 0, 1.5, 2.0)]


def test_long_cells(spark):
    n = 200_000
    cell = "[[" + ",".join(["1.25"] * n) + "]]"
    df = flatten(spark.createDataFrame([(1, cell)], "k bigint, t string"), "k", {"t": ("a", ())}, Flat(r"\[\]\[\]|\[\]|", ("i", "p"), (("x", "a"),), ("x",), True))
    assert df.count() == n


def test_isotopes_without_windows(spark):
    trace = {"l_retention_times": [1], "l_mass_to_charges": [1], "l_intensities": [5]}
    features = [
        {"isotopes": [{"window": {"mz_start": 1.5}, "xic": trace}, {"xic": trace}, None, {"xic": [trace | {"l_intensities": 3}]}]},
        {"l_retention_times": [[1], [], None], "l_mass_to_charges": [[1], [], None], "l_intensities": [[1], [], None]},
        {"isotopes": {"4": {"xic": trace}}, "l_intensities": None},
    ]
    df = spark.createDataFrame([(1, json.dumps({"features": features}))], "rec_id bigint, payload string")
    got = flatten(df, "rec_id", {"payload": ("", ())}, ALL_ISOTOPES).collect()
    assert sorted((r.feature_pos, r.iso_pos, r.mz_start) for r in got) == [(0, 0, 1.5), (0, 1, None), (0, 3, None), (1, 0, None), (1, 1, None), (2, 4, None)]
    cells = "rec_id bigint, l_mz_start string, l_mz_end string, l_intensities string"
    df = spark.createDataFrame([(1, "[1, 2]", None, "[[1], [2], [3]]"), (2, "[1, 2", "['3']", ""), (3, None, "", "[[1")], cells)
    got = flatten(df, "rec_id", _cells(("l_mz_start", "l_mz_end", "l_intensities")), ALL_ISOTOPES, apart=True).collect()
    assert sorted((r.rec_id, r.iso_pos, r.mz_start, r.mz_end) for r in got) == [(1, 0, 1.0, None), (1, 1, 2.0, None), (1, 2, None, None), (2, 0, None, 3.0)]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_points_have_isotopes_and_isotopes_features(spark):
    found, isotopes, features = (QUERIES[q](spark, SMALL) for q in ("p1_found", "p1_isotopes", "p1_features"))
    keys = ["src_table", "rec_id", "feature_pos", "iso_pos"]
    assert found.join(isotopes, keys, "left_anti").count() == 0 and isotopes.join(features, keys[:3], "left_anti").count() == 0
    assert isotopes.groupBy(*keys).count().where("count > 1").count() == 0


def test_folded_levels_and_carried_columns(spark):
    xic = lambda t, y: {"xic": {"l_retention_times": [t], "l_mass_to_charges": [t], "l_intensities": [y]}}
    features = [{"l_retention_times": [[1, 2], [3]], "l_mass_to_charges": [[1, 2], [3]], "l_intensities": [[5, 6], [None]]}, {"isotopes": {"9": xic(1, 5), "4": xic(2, 7)}}]
    df = spark.createDataFrame([(1, "r", json.dumps({"features": features})), (2, None, "{")], "rec_id bigint, run string, payload string")
    get = lambda n: sorted((r.run, r.feature_pos, r.iso_pos, r.intensity) for r in flatten(df, "rec_id", {"payload": ("", ())}, POINTS, n, carry=("run",)).collect())
    assert get(0) == [("r", 0, 0, 5.0), ("r", 0, 0, 6.0), ("r", 1, 4, 7.0), ("r", 1, 9, 5.0)]
    assert get(1) == [("r", 0, 0, [5.0, 6.0]), ("r", 1, 4, [7.0]), ("r", 1, 9, [5.0])]
    assert get(2) == [("r", 0, [0], [[5.0, 6.0]]), ("r", 1, [4, 9], [[7.0], [5.0]])]
    with pytest.raises(ValueError):
        flatten(df.withColumnRenamed("run", "iso_pos"), "rec_id", {"payload": ("", ())}, POINTS, carry=("iso_pos",))
