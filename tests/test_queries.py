import os

import numpy as np
import pytest
from tests.oracle import MEDIUM, SMALL, rows

from peakloom.plans import filling, quant, records, workflow

MODULES = [records, filling, quant, workflow]
SPARSE = ("consensus_linking", "dangling_edges", "first_wins_peptides", "psm_in_scan_list")  # nothing at the smallest scale
QUERIES = {n: q for m in MODULES for n, q in m.QUERIES.items()}
SQL = {n: s for m in MODULES for n, s in m.SQL.items()}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    folder = MEDIUM if name in SPARSE and os.path.isdir(MEDIUM) else SMALL
    mine, other = rows(QUERIES[name], SQL[name], spark, folder)
    assert mine == other and (mine or folder == SMALL and name in SPARSE)


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
@pytest.mark.parametrize("name", ["interval_join_ms2", "psm_in_scan_list", "consensus_lookup", "xic_extraction"])
def test_plans_have_no_nested_loops(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BatchEvalPython" not in plan


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_curve_has_the_plotted_points(spark):
    rows = QUERIES["cutoff_curve_1000"](spark, SMALL).groupBy("run").agg({"q": "collect_set"}).collect()
    assert rows and all(sorted(r[1]) == np.linspace(0, 1, 1000).tolist() for r in rows)
