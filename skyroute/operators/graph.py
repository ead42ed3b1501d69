"""The route multigraph: construction, listings, degrees and top-k reports.

A graph is a pair of DataFrames, ``airports(code, vertex_id)`` and
``routes(src, dst, distance)``. The code is the identity; the hash id is shown only.
A route end that is missing from the airports has the code ``nowhere``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyroute.functions.javahash import java_hash
from skyroute.functions.ordered import number_rows
from skyroute.functions.scratch import write_table

NOWHERE = "nowhere"


class RouteGraph(NamedTuple):
    airports: DataFrame
    routes: DataFrame


def _ends(flights: DataFrame) -> DataFrame:
    return flights.select(
        F.col("Origin").alias("src"), F.col("Dest").alias("dst"), F.col("Distance").alias("distance")
    )


def routes(flights: DataFrame) -> DataFrame:
    """Distinct (src, dst, distance); rows with a missing value make no route."""
    return _ends(flights).na.drop().distinct()


def rejected_flights(flights: DataFrame) -> DataFrame:
    """How many flights lack an origin, a destination or a distance."""
    ends = _ends(flights)
    missing = F.col("src").isNull() | F.col("dst").isNull() | F.col("distance").isNull()
    missing = missing | F.isnan("distance")
    return ends.agg(F.count_if(missing).alias("rejected"))


def _airports_at(ends: DataFrame) -> DataFrame:
    codes = ends.select(F.explode(F.array("src", "dst")).alias("code")).distinct()
    return codes.select("code", java_hash(F.col("code")).alias("vertex_id"))


def airports(flights: DataFrame) -> DataFrame:
    """Every code that a route starts or ends at, with its hash id."""
    return _airports_at(_ends(flights).na.drop())


def build_graph(flights: DataFrame, store: bool = True) -> RouteGraph:
    """The graph of the flights; its airports are taken from the distinct routes.

    The routes are written once, as most queries go over them several times and the
    flights may be costly to read; ``store=False`` is for a single pass.
    """
    distinct = routes(flights)
    if store:
        distinct = write_table(distinct)
    return RouteGraph(_airports_at(distinct), distinct)


def known_airports(graph: RouteGraph) -> DataFrame:
    return graph.airports.filter(F.col("code").cast("string") != NOWHERE)


def all_codes(graph: RouteGraph) -> DataFrame:
    """The codes of the airports and of all route ends: the vertices of the graph."""
    ends = graph.routes.select(F.explode(F.array("src", "dst")).alias("code"))
    return graph.airports.select("code").union(ends).distinct()


def route_cost(distance: Column) -> Column:
    return 50 + distance / 2


def route_costs(routes: DataFrame) -> DataFrame:
    return routes.withColumn("cost", route_cost(F.col("distance")))


def attach_codes(graph: RouteGraph) -> DataFrame:
    """Routes with the codes of both ends, ``nowhere`` for an end that is no airport."""
    src_known = graph.airports.select(F.col("code").alias("src_known"))
    dst_known = graph.airports.select(F.col("code").alias("dst_known"))
    return (
        graph.routes.join(src_known, F.col("src") == F.col("src_known"), "left")
        .join(dst_known, F.col("dst") == F.col("dst_known"), "left")
        .select(
            "src",
            "dst",
            "distance",
            F.coalesce("src_known", F.lit(NOWHERE)).alias("src_code"),
            F.coalesce("dst_known", F.lit(NOWHERE)).alias("dst_code"),
        )
    )


def triplets(graph: RouteGraph) -> DataFrame:
    """Routes joined to both of their airports; routes with an unknown end drop out."""
    known = known_airports(graph)
    src = known.select(F.col("code").alias("src"), F.col("vertex_id").alias("src_id"))
    dst = known.select(F.col("code").alias("dst"), F.col("vertex_id").alias("dst_id"))
    return (
        graph.routes.join(src, "src")
        .join(dst, "dst")
        .select("src_id", "src", "dst_id", "dst", "distance")
    )


def graph_size(graph: RouteGraph) -> DataFrame:
    """One row with the number of airports and of routes."""
    counts = graph.airports.agg(F.count(F.lit(1)).alias("airports"), F.lit(0).alias("routes")).union(
        graph.routes.agg(F.lit(0), F.count(F.lit(1)))
    )
    return counts.agg(F.sum("airports").alias("airports"), F.sum("routes").alias("routes"))


def list_airports(graph: RouteGraph) -> DataFrame:
    return number_rows(known_airports(graph), ["code"], unique=True).select("number", "vertex_id", "code")


def list_routes(graph: RouteGraph) -> DataFrame:
    return number_rows(triplets(graph), ["src", "dst", "distance"], unique=True)


def routes_longer_than(graph: RouteGraph, distance: float = 500) -> DataFrame:
    """Routes strictly longer than ``distance``, numbered from the shortest on."""
    far = RouteGraph(graph.airports, graph.routes.filter(F.col("distance") > distance))
    return number_rows(triplets(far), ["distance", "src", "dst"], unique=True)


def in_degrees(graph: RouteGraph) -> DataFrame:
    """Routes that end at each code; codes without any are absent."""
    return graph.routes.groupBy(F.col("dst").alias("code")).agg(F.count(F.lit(1)).alias("routes"))


def out_degrees(graph: RouteGraph) -> DataFrame:
    """Routes that start at each code; codes without any are absent."""
    return graph.routes.groupBy(F.col("src").alias("code")).agg(F.count(F.lit(1)).alias("routes"))


def _both_ends(graph: RouteGraph) -> DataFrame:
    ends = F.array(
        F.struct(F.col("src").alias("code"), F.lit(0).alias("incoming"), F.lit(1).alias("outgoing")),
        F.struct(F.col("dst").alias("code"), F.lit(1).alias("incoming"), F.lit(0).alias("outgoing")),
    )
    return (
        graph.routes.select(F.inline(ends))
        .groupBy("code")
        .agg(
            F.sum("incoming").alias("incoming"),
            F.sum("outgoing").alias("outgoing"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def total_degrees(graph: RouteGraph) -> DataFrame:
    """Route ends at each code; a self loop counts twice."""
    return _both_ends(graph).select("code", F.col("total").alias("routes"))


def max_degrees(graph: RouteGraph) -> DataFrame:
    """The code with the most incoming, outgoing and total routes; ties go to the smallest."""
    kinds = ["incoming", "outgoing", "total"]
    best = [F.min(F.struct((-F.col(k)).alias("less"), "code")).alias(k) for k in kinds]
    rows = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("best")) for k in kinds]
    return (
        _both_ends(graph)
        .agg(*best)
        .select(F.inline(F.array(*rows)))
        .filter(F.col("best.less") < 0)
        .select("kind", F.col("best.code").alias("code"), (-F.col("best.less")).alias("routes"))
    )


def known_only(values: DataFrame, graph: RouteGraph) -> DataFrame:
    """Keep the rows whose ``code`` is an airport of the graph."""
    return values.join(known_airports(graph).select("code"), "code", "left_semi")


def ranked(values: DataFrame, by: Column, rows: int | None = 10) -> DataFrame:
    """The first ``rows`` rows by ``by`` and code with their rank (all rows for None)."""
    if rows is None:
        return number_rows(values, [by, "code"], name="rank", unique=True)
    top = values.orderBy(by, "code").limit(rows)
    # The window sees the limited rows only.
    rank = F.row_number().over(Window.orderBy(by, "code")).cast("long")
    return top.select(rank.alias("rank"), *values.columns)


def top_incoming(graph: RouteGraph, rows: int | None = 10) -> DataFrame:
    """The airports with the most incoming routes, known ones only."""
    return ranked(known_only(in_degrees(graph), graph), F.col("routes").desc(), rows)


def top_outgoing(graph: RouteGraph, rows: int | None = 10) -> DataFrame:
    """The airports with the most outgoing routes, known ones only."""
    return ranked(known_only(out_degrees(graph), graph), F.col("routes").desc(), rows)


def cheapest_routes(graph: RouteGraph, rows: int = 10) -> DataFrame:
    """Of the ``rows`` cheapest routes, those between known airports, with their rank."""
    cheapest = route_costs(graph.routes).orderBy("cost", "src", "dst").limit(rows)
    ends = triplets(RouteGraph(graph.airports, cheapest.drop("cost")))
    # At most ``rows`` rows, which the join may have put out of order.
    found = ends.select("src", "dst", route_cost(F.col("distance")).alias("cost"))
    rank = F.row_number().over(Window.orderBy("cost", "src", "dst")).cast("long")
    return found.select(rank.alias("rank"), "src", "dst", "cost")
