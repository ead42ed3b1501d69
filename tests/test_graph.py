from pyspark.sql import functions as F

from goldens import flights, graph_a, graph_b, rows
from skyroute.operators import graph


def test_sizes_and_degrees(spark):
    a = graph_a(spark)
    assert rows(graph.graph_size(a)) == [(5, 8)]
    assert rows(graph.in_degrees(a)) == [("A", 2), ("B", 1), ("C", 4), ("D", 1)]
    assert rows(graph.out_degrees(a)) == [("A", 3), ("B", 1), ("C", 2), ("D", 1), ("E", 1)]
    assert rows(graph.total_degrees(a)) == [("A", 5), ("B", 2), ("C", 6), ("D", 2), ("E", 1)]


def test_degrees_of_multigraph_with_sink(spark):
    b = graph_b(spark)
    assert rows(graph.in_degrees(b)) == [(1, 3), (2, 2), (3, 2), (4, 1), (5, 1), (6, 1)]
    assert rows(graph.out_degrees(b)) == [(1, 3), (2, 2), (3, 2), (4, 1), (6, 2)]
    assert rows(graph.total_degrees(b)) == [(1, 6), (2, 4), (3, 4), (4, 2), (5, 1), (6, 3)]


def test_max_degrees_break_ties_by_code(spark):
    assert rows(graph.max_degrees(graph_a(spark))) == [
        ("incoming", "C", 4), ("outgoing", "A", 3), ("total", "C", 6),
    ]
    tied = graph.build_graph(flights(spark, [("B", "A", 1.0), ("A", "B", 1.0)]))
    assert {r[1] for r in rows(graph.max_degrees(tied))} == {"A"}


def test_listings_are_numbered(spark):
    a = graph_a(spark)
    assert [r[::2] for r in rows(graph.list_airports(a))] == list(enumerate("ABCDE", start=1))
    listed = rows(graph.list_routes(a), "number", "src", "dst", "distance")
    assert [r[0] for r in listed] == list(range(1, 9))
    assert [r[1:] for r in listed] == sorted(r[1:] for r in listed)


def test_longer_than_is_strict_and_ascending(spark):
    far = rows(graph.routes_longer_than(graph_a(spark), 100), "number", "src", "dst", "distance")
    assert far == [(1, "A", "C", 400.0), (2, "A", "C", 600.0)]


def test_cheapest_routes(spark):
    assert [tuple(r) for r in graph.cheapest_routes(graph_a(spark)).collect()] == [
        (1, "C", "C", 52.5), (2, "D", "A", 55.0), (3, "E", "A", 60.0), (4, "C", "D", 75.0),
        (5, "A", "B", 100.0), (6, "B", "C", 100.0), (7, "A", "C", 250.0), (8, "A", "C", 350.0),
    ]


def test_unknown_ends_are_nowhere(spark):
    a = graph_a(spark)
    partial = graph.RouteGraph(a.airports.filter("code <> 'C'"), a.routes)
    coded = rows(graph.attach_codes(partial), "dst", "dst_code")
    assert {c for d, c in coded if d == "C"} == {"nowhere"}
    assert len(coded) == 8
    assert rows(graph.triplets(partial), "src", "dst") == [("A", "B"), ("D", "A"), ("E", "A")]
    # The limit comes after the filter for degrees, before it for the cheapest routes.
    assert rows(graph.top_incoming(partial, 1)) == [(1, "A", 2)]
    assert rows(graph.cheapest_routes(partial, 2)) == [(1, "D", "A", 55.0)]
    assert rows(graph.list_airports(partial), "number", "code") == list(enumerate("ABDE", start=1))


def test_top_and_full_ranking_agree(spark):
    a = graph_a(spark)
    assert rows(graph.top_incoming(a, 2)) == rows(graph.top_incoming(a, None))[:2]
    assert rows(graph.top_outgoing(a, 1)) == [(1, "A", 3)]


def test_flights_with_missing_values_are_rejected(spark):
    bad = flights(
        spark,
        [("A", "B", 1.0), (None, "B", 1.0), ("A", None, 1.0), ("A", "B", None), ("X", "Y", float("nan"))],
    )
    assert rows(graph.build_graph(bad).routes) == [("A", "B", 1.0)]
    assert rows(graph.airports(bad), "code") == [("A",), ("B",)]
    assert rows(graph.rejected_flights(bad)) == [(4,)]


def test_code_with_a_comma_is_one_vertex(spark):
    g = graph.build_graph(flights(spark, [("A,B", "C", 1.0)]))
    assert rows(g.airports, "code") == [("A,B",), ("C",)]


def test_hash_ids(spark):
    from skyroute.functions.javahash import java_hash

    def expected(text):
        h = 0
        units = text.encode("utf-16-be")
        for i in range(0, len(units), 2):
            h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) & 0xFFFFFFFF
        return h - 2**32 if h >= 2**31 else h

    texts = ["LAX", "NATION_11", "", "Zürich", "日本", "a\U0001f6ebb", "x" * 300]
    df = spark.createDataFrame([(t,) for t in texts + [None]], "code STRING")
    found = {r.code: r.h for r in df.select("code", java_hash(F.col("code")).alias("h")).collect()}
    assert found == {**{t: expected(t) for t in texts}, None: None}
    assert found["LAX"] == 75139 and found["NATION_11"] == 1772195352
