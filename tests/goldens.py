"""Small graphs with known answers."""

from skyroute.operators.graph import RouteGraph, build_graph

ROUTES_A = [
    ("A", "B", 100.0), ("B", "C", 100.0), ("A", "C", 600.0), ("A", "C", 400.0),
    ("C", "D", 50.0), ("D", "A", 10.0), ("E", "A", 20.0), ("C", "C", 5.0),
]

EDGES_B = [(1, 2), (1, 2), (2, 3), (3, 1), (4, 1), (3, 5), (1, 3), (6, 6), (6, 1), (2, 4)]


def flights(spark, rows):
    return spark.createDataFrame(rows, "Origin STRING, Dest STRING, Distance DOUBLE")


def graph_a(spark):
    # Every route is flown twice: flights are not routes.
    return build_graph(flights(spark, ROUTES_A + ROUTES_A))


def graph_b(spark, edges=EDGES_B):
    codes = sorted({v for e in edges for v in e})
    return RouteGraph(
        spark.createDataFrame([(c,) for c in codes], "code LONG"),
        spark.createDataFrame([(*e, float(i)) for i, e in enumerate(edges)], "src LONG, dst LONG, distance DOUBLE"),
    )


def rows(df, *columns):
    return sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())
