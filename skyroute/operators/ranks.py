"""PageRank to a tolerance, in its delta form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.operators.graph import RouteGraph, known_only, ranked
from skyroute.operators.propagate import lay_out, propagate


def page_rank(
    vertices: DataFrame, edges: DataFrame, tolerance: float = 0.1, reset: float = 0.15
) -> DataFrame:
    """(vertex, rank) for every vertex and route end; the ranks sum to their number.

    A vertex whose rank last grew by more than ``tolerance`` hands the growth on along
    its out-edges, each parallel edge counting. Parallel edges are kept as one edge
    with a multiplicity.
    """
    multiplicity = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
    layout = lay_out(multiplicity)
    degrees = layout.every().groupBy(F.col("src").alias("vertex")).agg(
        F.sum("copies").alias("out_degree")
    )
    ends = layout.every().select(F.explode(F.array("src", "dst")).alias("vertex"))
    start = (
        vertices.select(F.col("code").alias("vertex"))
        .unionAll(ends)
        .distinct()
        .join(degrees, "vertex", "left")
        .select(
            "vertex",
            "out_degree",
            F.lit(reset).alias("rank"),
            F.lit(reset).alias("delta"),
            F.lit(reset > tolerance).alias("active"),
        )
    )
    delta = (1 - reset) * F.col("share")
    try:
        state = propagate(
            start,
            layout,
            send={"share": F.col("delta") * F.col("copies") / F.col("out_degree")},
            merge={"share": F.sum("share")},
            update={
                "out_degree": F.col("out_degree"),
                "rank": F.col("rank") + delta,
                "delta": delta,
                "active": delta > tolerance,
            },
        )
    finally:
        layout.drop()
    total, count = state.agg(F.sum("rank"), F.count(F.lit(1))).first()
    scale = count / total if total else 1.0
    return state.select("vertex", (F.col("rank") * scale).alias("rank"))


def top_ranked(graph: RouteGraph, tolerance: float = 0.1, rows: int | None = 10) -> DataFrame:
    """The known airports with the highest ranks; unknown route ends take part in ranking."""
    ranks = page_rank(graph.airports.select("code"), graph.routes, tolerance)
    values = ranks.select(F.col("vertex").alias("code"), F.col("rank").alias("score"))
    return ranked(known_only(values, graph), F.col("score").desc(), rows)
