"""Every query against its SQL at the smallest scale; slow learners have their own tests."""

import os

import pytest

import __spark_entry__ as entry
from skyroute.plans import catalog
from compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CHECKED = sorted(catalog.ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert sorted(set(catalog.QUERIES) - set(catalog.ORACLES)) == [
        "balanced_sample", "cv_grid", "dt_scores", "feature_importance", "gbt_scores",
        "nb_scores", "random_split", "rf_scores", "scored_rows", "stratified_sample",
        "svc_scores",
    ]


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() == 10


def test_degree_sums(spark):
    run = {k: entry.queries()[k](spark, SF_DIR) for k in ("in_degrees", "out_degrees", "total_degrees", "graph_edges")}
    total = {k: sum(r.routes for r in df.collect()) for k, df in run.items() if k != "graph_edges"}
    edges = run["graph_edges"].count()
    assert total == {"in_degrees": edges, "out_degrees": edges, "total_degrees": 2 * edges}
