"""What the planner makes of the queries: pruning, pushdown, top-k, no global steps."""

import re

import pytest

from goldens import graph_a
from skyroute.functions.scratch import write_table
from skyroute.operators import graph
from skyroute.plans import catalog
from test_queries import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_schema(text, table):
    return re.search(rf"{table}\.parquet\].*?ReadSchema: struct<([^>]*)>", text).group(1)


def test_routes_read_three_columns_of_the_line_items(spark):
    text = plan(catalog.QUERIES["graph_edges"](spark, SF_DIR))
    columns = {c.split(":")[0] for c in read_schema(text, "lineitem").split(",")}
    assert columns == {"l_orderkey", "l_suppkey", "l_extendedprice"}


def test_distance_filter_reaches_the_scan(spark):
    g = graph_a(spark)
    stored = graph.RouteGraph(g.airports, write_table(g.routes))
    far = graph.RouteGraph(stored.airports, stored.routes.filter("distance > 500"))
    assert "GreaterThan(distance,500.0)" in plan(graph.triplets(far))


@pytest.mark.parametrize("name", ["top_incoming", "top_outgoing", "cheapest_routes", "flights_preview"])
def test_limits_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize(
    "name",
    [
        "list_edges", "edges_longer_than", "triplets", "graph_dangling", "max_degrees", "string_index",
        "assemble_features", "roc_curve", "class_balance", "flights_profile",
    ],
)
def test_no_cross_joins_or_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, REPARTITION"):
        assert node not in text


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(catalog.QUERIES["confusion_matrix"](spark, SF_DIR))
    assert "partial_count" in text
