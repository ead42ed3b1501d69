import random

import pytest
from pyspark.sql import functions as F

from goldens import EDGES_B, graph_a, graph_b, rows
from skyroute.functions.costmaps import add_to_costs, cheaper_costs
from skyroute.functions.resident import Resident
from skyroute.operators import graph, paths, propagate, ranks
from skyroute.plans import catalog

INF = float("inf")


def parts(g):
    return g.airports, graph.route_costs(g.routes)


def test_costs_from_a(spark):
    expected = [("A", 0.0), ("B", 100.0), ("C", 200.0), ("D", 275.0), ("E", INF)]
    assert rows(paths.cheapest_costs(*parts(graph_a(spark)), "A")) == expected


def test_paths_from_a(spark):
    a = graph_a(spark)
    found = {r.vertex: (r.cost, r.path) for r in paths.cheapest_paths(*parts(a), "A").collect()}
    assert found == {
        "A": (0.0, ["A"]), "B": (100.0, ["A", "B"]), "C": (200.0, ["A", "B", "C"]),
        "D": (275.0, ["A", "B", "C", "D"]),
    }
    assert rows(paths.cheapest_multi_hop_paths(a, "A")) == [
        (1, "C", "A->B->C", 200.0), (2, "D", "A->B->C->D", 275.0),
    ]
    assert rows(paths.cheapest_multi_hop_paths(a, "A", 1)) == [(1, "C", "A->B->C", 200.0)]


def test_cheapest_airports_limit_before_filter(spark):
    a = graph_a(spark)
    assert rows(paths.cheapest_airports(a, "A", 2)) == [(1, "A", 0.0), (2, "B", 100.0)]
    partial = graph.RouteGraph(a.airports.filter("code <> 'B'"), a.routes)
    assert rows(paths.cheapest_airports(partial, "A", 3)) == [(1, "A", 0.0), (2, "C", 200.0)]
    assert rows(paths.cheapest_airports(a, "A"))[-1] == (5, "E", INF)


def test_unknown_source(spark):
    a = graph_a(spark)
    assert rows(paths.cheapest_costs(*parts(a), "Z")) == [(c, INF) for c in "ABCDE"]
    assert paths.cheapest_paths(*parts(a), "Z").count() == 0
    assert paths.cheapest_multi_hop_paths(a, "Z").count() == 0


def test_costs_to_landmarks(spark):
    a = graph_a(spark)
    long = rows(paths.costs_to_landmarks(*parts(a), ["A", "D", "E", "Z"]), "landmark", "vertex", "cost")
    assert long == [
        ("A", "A", 0.0), ("A", "B", 230.0), ("A", "C", 130.0), ("A", "D", 55.0), ("A", "E", 60.0),
        ("D", "A", 275.0), ("D", "B", 175.0), ("D", "C", 75.0), ("D", "D", 0.0), ("D", "E", 335.0),
        ("E", "E", 0.0),
    ]
    maps = {r.vertex: r.costs for r in paths.landmark_maps(*parts(a), ["A", "E"]).collect()}
    assert maps["E"] == {"A": 60.0, "E": 0.0} and maps["B"] == {"A": 230.0}
    assert {r.vertex: r.costs for r in paths.landmark_maps(*parts(a), ["E"]).collect()}["A"] == {}


def test_negative_or_missing_costs_fail(spark):
    codes = spark.createDataFrame([("A",), ("B",)], "code STRING")
    for bad in (-1.0, None, float("nan")):
        edges = spark.createDataFrame([("A", "B", bad)], "src STRING, dst STRING, cost DOUBLE")
        with pytest.raises(Exception, match="edge costs must be"):
            paths.cheapest_costs(codes, edges, "A")
    free = spark.createDataFrame([("A", "B", 0.0)], "src STRING, dst STRING, cost DOUBLE")
    assert rows(paths.cheapest_costs(codes, free, "A")) == [("A", 0.0), ("B", 0.0)]
    with pytest.raises(Exception, match="edge costs must be above zero"):
        paths.cheapest_paths(codes, free, "A")


def test_cost_maps(spark):
    df = spark.sql("SELECT map('a', 1.0D, 'b', 5.0D) AS l, map('b', 2.0D, 'c', 3e10D) AS r")
    both = df.select(
        cheaper_costs(F.col("l"), F.col("r")).alias("m"),
        add_to_costs(F.col("l"), F.lit(2)).alias("plus"),
        cheaper_costs(F.col("l"), F.lit(None).cast("map<string,double>")).alias("one"),
    ).first()
    assert both.m == {"a": 1.0, "b": 2.0, "c": 3e10}
    assert both.plus == {"a": 3.0, "b": 7.0} and both.one == {"a": 1.0, "b": 5.0}


def test_rendering_skips_nowhere_after_the_first(spark):
    df = spark.createDataFrame(
        [(["nowhere", "B", "nowhere", "C"],), (["A"],), (["A", "B"],)], "path ARRAY<STRING>"
    )
    assert [r[0] for r in df.select(paths.render_path(F.col("path"))).collect()] == [
        "nowhere->B->C", "A", "A->B",
    ]


def brute_force(edges, source):
    cost = {source: 0.0}
    changed = True
    while changed:
        changed = False
        for s, d, c in edges:
            if s in cost and cost[s] + c < cost.get(d, INF):
                cost[d] = cost[s] + c
                changed = True
    return cost


def hub_edges():
    """A third of the edges leave vertex 0; costs tie often."""
    draw = random.Random(5)
    edges = [(0, draw.randrange(1, 60), float(draw.randrange(1, 40))) for _ in range(150)]
    edges += [(draw.randrange(60), draw.randrange(60), float(draw.randrange(1, 6))) for _ in range(250)]
    return edges + [(100 + i, 101 + i, 1.0) for i in range(6)] + [(3, 100, 2.0)]


@pytest.fixture(scope="module")
def hub(spark):
    edges = hub_edges()
    codes = sorted({v for e in edges for v in e[:2]})
    return (
        edges,
        spark.createDataFrame([(c,) for c in codes], "code LONG"),
        spark.createDataFrame(edges, "src LONG, dst LONG, cost DOUBLE"),
    )


def test_against_brute_force_with_a_split_hub(spark, hub, monkeypatch):
    laid_out = propagate.lay_out
    seen = []

    def split(edges):
        layout = laid_out(edges, 20)
        seen.append((layout.tables, layout.fans.count() if layout.fans else 0))
        return layout

    monkeypatch.setattr(paths, "lay_out", split)
    edges, codes, table = hub
    expected = brute_force(edges, 0)
    costs = dict(rows(paths.cheapest_costs(codes, table, 0)))
    assert {v: c for v, c in costs.items() if c < INF} == expected

    cheapest = {}
    for s, d, c in edges:
        cheapest[s, d] = min(c, cheapest.get((s, d), INF))
    found = paths.cheapest_paths(codes, table, 0).collect()
    assert {r.vertex: r.cost for r in found} == expected
    for r in found:
        assert r.path[0] == 0 and r.path[-1] == r.vertex
        assert sum(cheapest[a, b] for a, b in zip(r.path, r.path[1:])) == r.cost

    reached = paths.costs_to_landmarks(codes, table, [105, 5]).collect()
    backwards = [(d, s, c) for s, d, c in edges]
    for landmark in (105, 5):
        assert {r.vertex: r.cost for r in reached if r.landmark == landmark} == brute_force(
            backwards, landmark
        )
    assert seen[0][1] >= 1, "the hub has several slots"
    tables = [t.name for t in spark.catalog.listTables()]
    assert not any(table in tables for own, _ in seen for table in own), "the laid-out tables are dropped"


def test_large_layout_shuffles_no_edges(spark, hub):
    _, _, table = hub
    layout = propagate.lay_out(table.withColumnRenamed("cost", "edge_cost"), 20)
    try:
        frontier = spark.range(60).select(F.col("id").alias("vertex"))
        plan = layout.out_of(frontier)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan parquet spark_catalog" in line]
        assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)
        # Rows are hashed once for the near edges and, spread over slots, for those of hubs.
        assert plan.count("Exchange hashpartitioning") == 2, plan
        assert "ShuffledHashJoin" in plan and "Sort [" not in plan, plan
        assert layout.hubs.filter("src = 0").select("slot").distinct().count() > 1
        assert layout.edges.filter("src = 0").isEmpty()
        assert layout.every().count() == table.count()
    finally:
        layout.drop()


def test_a_round_shuffles_its_messages_alone(spark, hub):
    _, codes, table = hub
    layout = propagate.lay_out(table.withColumnRenamed("cost", "edge_cost"))
    start = codes.select(F.col("code").alias("vertex"), F.lit(1.0).alias("cost"), F.lit(True).alias("active"))
    resident = Resident(start, ["vertex"])
    try:
        met = propagate.next_versions(resident, layout, *paths._offers())
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1, plan
        before_exchange = plan[plan.index("Exchange hashpartitioning(vertex") :]
        assert "partial_min" in before_exchange, "messages are combined on the map side"
        better = met.filter("offer < 0.5").select("vertex", F.col("offer").alias("cost"), F.lit(True).alias("active"))
        writing = better.withColumn("_round", F.lit(1))._jdf.queryExecution().executedPlan().toString()
        assert writing.count("Exchange") == 1
    finally:
        resident.drop()
        layout.drop()


def test_rounds_write_their_frontier(spark, monkeypatch):
    """On a chain every round changes one row, whatever the size of the state."""
    written = []
    append = Resident.append
    monkeypatch.setattr(Resident, "append", lambda self, rows: written.append(append(self, rows)) or written[-1])
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(12)], "src LONG, dst LONG, cost DOUBLE")
    codes = spark.range(13).withColumnRenamed("id", "code")
    costs = dict(rows(paths.cheapest_costs(codes, chain, 0)))
    assert costs == {i: float(i) for i in range(13)}
    assert written == [1] * 12 + [0]


def test_resident_rows_keep_their_newest_version(spark):
    draw = random.Random(4)
    truth = {(i % 40, i % 3): float(i) for i in range(100)}
    start = spark.createDataFrame([(a, b, v, "x") for (a, b), v in truth.items()], "a LONG, b LONG, v DOUBLE, w STRING")
    store = Resident(start, ["a", "b"], least=0)
    folders = set()
    for _ in range(7):
        folders.add(store._folder)
        new = {(draw.randrange(60), draw.randrange(3)): draw.random() for _ in range(50)}
        frame = spark.createDataFrame([(a, b, v, "y") for (a, b), v in new.items()], "a LONG, b LONG, v DOUBLE, w STRING")
        assert store.append(frame) == len(new)
        truth.update(new)
        assert {(r.a, r.b): r.v for r in store.changed().collect()} == new
        assert {(r.a, r.b): r.v for r in store.latest().collect()} == truth
        assert store.versions().count() <= 2 * len(truth) + len(new)
    assert len(folders) > 1, "versions were thinned out"
    asked = spark.createDataFrame([(0, 0, 5), (99, 0, 6)], "a LONG, b LONG, ask LONG")
    met = {(r.a, r.ask): (r.v, r.w) for r in store.join_latest(asked).collect()}
    assert met == {(0, 5): (truth[0, 0], met[0, 5][1]), (99, 6): (None, None)}
    out = store.finish()
    assert {(r.a, r.b): r.v for r in out.collect()} == truth
    assert store._table not in [t.name for t in spark.catalog.listTables()]


@pytest.mark.parametrize("step", [20.0, 1e9])
def test_steps_give_the_same_costs(spark, hub, step):
    edges, codes, table = hub
    costs = dict(rows(paths.cheapest_costs(codes, table, 0, step=step)))
    assert {v: c for v, c in costs.items() if c < INF} == brute_force(edges, 0)
    with pytest.raises(ValueError):
        paths.cheapest_costs(codes, table, 0, step=0)


def test_steps_send_fewer_messages(spark, monkeypatch):
    """A ladder where every long rung is undercut by short ones later."""
    n = 6
    edges = [(i, i + 1, 1.0) for i in range(n)]
    edges += [(0, i, 3.0 * i) for i in range(2, n + 1)] + [(i, 100 + 20 * i + j, 0.5) for i in range(n + 1) for j in range(20)]
    table = spark.createDataFrame(edges, "src LONG, dst LONG, cost DOUBLE")
    codes = spark.createDataFrame([(c,) for c in sorted({v for e in edges for v in e[:2]})], "code LONG")
    sent = []
    out_of = propagate.EdgeLayout.out_of

    def counted(self, rows):
        found = out_of(self, rows)
        sent[-1] += found.count()
        return found

    monkeypatch.setattr(propagate.EdgeLayout, "out_of", counted)
    found = []
    for step in (None, 1.0):
        sent.append(0)
        found.append(rows(paths.cheapest_costs(codes, table, 0, step=step)))
    assert found[0] == found[1] and dict(found[0]) == brute_force(edges, 0)
    assert sent[1] == len(edges), "every edge carries one message"
    assert sent[1] < 0.8 * sent[0]


def test_walk_back_by_lifting(spark, monkeypatch):
    n = 500
    before = spark.createDataFrame([(i, i - 1) for i in range(1, n + 1)] + [(901, 900), (902, 901)], "vertex LONG, head LONG")
    ends = spark.createDataFrame([(n,), (3,), (902,), (902,), (1,), (0,)], "vertex LONG")
    written = []
    write = paths.write_table
    monkeypatch.setattr(paths, "write_table", lambda df, *a: written.append(1) or write(df, *a))
    found = {r.vertex: r.path for r in paths.walk_back(ends, before).collect()}
    assert found == {
        n: list(range(n + 1)), 3: [0, 1, 2, 3], 902: [900, 901, 902], 1: [0, 1], 0: [0]
    }
    assert len(written) <= 12, "ancestors at powers of two"
    assert paths.walk_back(ends.limit(0), before).count() == 0


def test_triangle_inequality(spark, hub):
    edges, codes, table = hub
    cost = dict(rows(paths.cheapest_costs(codes, table, 0)))
    assert all(cost[d] <= cost[s] + c for s, d, c in edges)


RANKS_01 = {1: 1.372855, 2: 1.157372, 3: 1.189128, 4: 0.839171, 5: 0.789594, 6: 0.651880}
RANKS_0001 = {1: 1.614433, 2: 1.175078, 3: 1.217649, 4: 0.760813, 5: 0.778549, 6: 0.453479}
NO_SINK_01 = {1: 1.469453, 2: 1.092438, 3: 1.112685, 4: 0.763598, 6: 0.561825}
NO_SINK_0001 = {1: 1.783323, 2: 1.161654, 3: 1.149083, 4: 0.643808, 6: 0.262131}


@pytest.mark.parametrize(
    "sink, tolerance, expected",
    [
        (True, 0.1, RANKS_01), (True, 0.001, RANKS_0001),
        (False, 0.1, NO_SINK_01), (False, 0.001, NO_SINK_0001),
    ],
)
def test_page_rank(spark, sink, tolerance, expected):
    b = graph_b(spark, [e for e in EDGES_B if sink or e != (3, 5)])
    found = dict(rows(ranks.page_rank(b.airports, b.routes, tolerance)))
    assert found.keys() == expected.keys()
    assert all(abs(found[v] - r) < 1e-6 for v, r in expected.items())
    assert abs(sum(found.values()) - len(found)) < 1e-9


def test_page_rank_with_split_hubs(spark, monkeypatch):
    laid_out = propagate.lay_out
    monkeypatch.setattr(ranks, "lay_out", lambda edges: laid_out(edges, 1))
    b = graph_b(spark)
    found = dict(rows(ranks.page_rank(b.airports, b.routes, 0.001)))
    assert all(abs(found[v] - r) < 1e-6 for v, r in RANKS_0001.items())


def test_top_ranked_drops_unknown_airports_before_the_limit(spark):
    b = graph_b(spark)
    partial = graph.RouteGraph(b.airports.filter("code <> 1"), b.routes)
    top = rows(ranks.top_ranked(partial, 0.1, 2))
    assert [r[:2] for r in top] == [(1, 3), (2, 2)]
    assert abs(top[0][2] - RANKS_01[3]) < 1e-6


def test_page_rank_with_unlisted_ends(spark):
    a = graph_a(spark)
    whole = dict(rows(ranks.page_rank(a.airports, a.routes, 0.01)))
    partial = dict(rows(ranks.page_rank(a.airports.filter("code < 'C'"), a.routes, 0.01)))
    assert partial == pytest.approx(whole)


def test_round_limit(spark):
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(6)], "src LONG, dst LONG, edge_cost DOUBLE")
    layout = propagate.lay_out(chain)
    start = spark.createDataFrame([(0, 0.0, True)], "vertex LONG, cost DOUBLE, active BOOLEAN")
    state = propagate.propagate(
        start,
        layout,
        *paths._offers(),
        update={"cost": F.col("offer"), "active": F.lit(True)},
        max_rounds=2,
    )
    assert rows(state, "vertex", "cost") == [(0, 0.0), (1, 1.0), (2, 2.0)]


def test_landmark_lists_share_one_layout(spark, monkeypatch):
    made, dropped = [], []
    laid_out, drop = propagate.lay_out, propagate.EdgeLayout.drop
    monkeypatch.setattr(paths, "lay_out", lambda edges: made.append(1) or laid_out(edges))
    monkeypatch.setattr(propagate.EdgeLayout, "drop", lambda self: dropped.append(1) or drop(self))
    found = catalog.QUERIES["landmark_map_merge"](spark, "/root/testdata/sf0.001")
    assert len(made) == len(dropped) == 1
    assert found.count() == found.select("vertex", "landmark").distinct().count() > 0
