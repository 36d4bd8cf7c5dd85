"""Registered queries vs their SQL twins on sf0.001, and the driver entry."""
import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

from .conftest import SMALL

FAST = ["a1_panel", "c1_purchase_events", "c5_target_panel", "c6_panel_diagnostics",
        "c12_class_distribution", "j9_scope_metrics", "j1_macro_roc_auc", "j3_per_class_pr_auc",
        "g6_apply_preprocessing", "b4_numeric_summary", "k1_psi", "k7_latency_p95",
        "e3_stratified_sample", "d2_interactions", "j13_list_metrics"]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql_twin(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SMALL)
    assert r["cols"] and r["rows"] and r["values"], r


def test_every_twin_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"split", "purchase", "n"}
