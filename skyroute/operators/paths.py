"""Cheapest costs and paths from a source, and costs to landmarks.

Edges are (src, dst, cost). Vertices are any DataFrame with a column ``code``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyroute.functions.resident import Resident
from skyroute.functions.scratch import TwoSlots, delete_folder, new_folder, write_table
from skyroute.operators.graph import RouteGraph, all_codes, known_only, ranked, route_costs
from skyroute.operators.propagate import EdgeLayout, lay_out, next_versions, propagate

INFINITY = float("inf")


def _checked(cost: Column, allowed: Column, what: str) -> Column:
    return F.when(allowed & ~F.isnan(cost), cost).otherwise(
        F.raise_error(F.lit(f"edge costs must be {what}"))
    )


def cheapest_edges(edges: DataFrame, positive: bool = False) -> DataFrame:
    """One edge per (src, dst), the cheapest, so parallel edges travel no further."""
    cost = F.col("cost").cast("double")
    checked = (
        _checked(cost, cost > 0, "above zero") if positive else _checked(cost, cost >= 0, "zero or more")
    )
    return edges.select("src", "dst", checked.alias("cost")).groupBy("src", "dst").agg(
        F.min("cost").alias("cost")
    )


def _offers() -> tuple[dict[str, Column], dict[str, Column]]:
    """What a vertex sends along an edge, and how a vertex merges it."""
    return {"offer": F.col("cost") + F.col("edge_cost")}, {"offer": F.min("offer")}


def _improves() -> Column:
    return F.col("cost").isNull() | (F.col("offer") < F.col("cost"))


def _relax(state: DataFrame, layout: EdgeLayout, keys: Sequence[str]) -> DataFrame:
    """Lower costs along edges until none improves; ``state`` is keys, cost, active."""
    update = {"cost": F.col("offer"), "active": F.lit(True)}
    return propagate(state, layout, *_offers(), update, keys, _improves()).select(*keys, "cost")


def _relax_by_steps(state: DataFrame, light: EdgeLayout, heavy: EdgeLayout, step: float) -> DataFrame:
    """``_relax`` in the order of costs (delta-stepping).

    Vertices wait in intervals of ``step``. Those of the lowest interval send along
    ``light`` edges, of at most ``step``, until no more fall into it; their costs are
    final then, and they send along ``heavy`` edges once. A vertex that is far away
    doesn't send costs that later rounds lower.
    """
    resident = Resident(state.withColumn("waits", F.lit(True)), ["vertex"])
    better = [F.col("offer").alias("cost"), F.lit(True).alias("active"), F.lit(True).alias("waits")]
    try:
        while (low := resident.latest().filter("waits").agg(F.min("cost")).first()[0]) is not None:
            begin = low // step * step
            inside = (F.col("cost") >= begin) & (F.col("cost") < max(begin + step, math.nextafter(low, INFINITY)))
            while resident.append(resident.latest().filter(inside & F.col("waits")).withColumn("waits", F.lit(False))):
                met = next_versions(resident, light, *_offers())
                resident.append(met.filter(_improves()).select("vertex", *better))
            settled = resident.latest().filter(inside)
            met = next_versions(resident, heavy, *_offers(), settled)
            resident.append(met.filter(_improves()).select("vertex", *better))
        return resident.finish().select("vertex", "cost")
    except BaseException:
        resident.drop()
        raise


def _start(vertices: DataFrame, source: object) -> DataFrame:
    return (
        vertices.filter(F.col("code") == F.lit(source))
        .select(F.col("code").alias("vertex"), F.lit(0.0).alias("cost"), F.lit(True).alias("active"))
        .limit(1)
    )


def _laid_out(edges: DataFrame) -> EdgeLayout:
    return lay_out(edges.withColumnRenamed("cost", "edge_cost"))


def cheapest_costs(
    vertices: DataFrame, edges: DataFrame, source: object, step: float | None = None
) -> DataFrame:
    """(vertex, cost) for every vertex; infinite where the source does not lead.

    By default every lowered cost is sent on at once. With ``step`` vertices send in
    intervals of so much cost: more rounds, but fewer messages where edges differ much.
    """
    if step is not None and not step > 0:
        raise ValueError("step must be above zero")
    best, start = cheapest_edges(edges), _start(vertices, source)
    layouts = []
    try:
        if step is None:
            layouts.append(_laid_out(best))
            reached = _relax(start, layouts[0], ["vertex"])
        else:
            layouts.append(_laid_out(best.filter(F.col("cost") <= step)))
            layouts.append(_laid_out(best.filter(F.col("cost") > step)))
            reached = _relax_by_steps(start, *layouts, step)
    finally:
        for layout in layouts:
            layout.drop()
    return (
        vertices.select(F.col("code").alias("vertex"))
        .join(reached, "vertex", "left")
        .select("vertex", F.coalesce("cost", F.lit(INFINITY)).alias("cost"))
    )


def _predecessors(vertices: DataFrame, edges: DataFrame, source: object, slots: TwoSlots) -> DataFrame:
    """(vertex, cost, head) of the reached vertices but the source, stored.

    The rounds carry costs alone. One pass over the edges then picks each vertex's
    predecessor ``head``, the smallest that gives its cost.
    """
    layout = _laid_out(cheapest_edges(edges, positive=True))
    try:
        reached = _relax(_start(vertices, source), layout, ["vertex"])
        arrivals = layout.out_of(reached.withColumnRenamed("cost", "src_cost")).filter(
            F.col("dst") != F.lit(source)
        )
        best = F.min(F.struct((F.col("src_cost") + F.col("edge_cost")).alias("cost"), "src"))
        return slots.write(
            arrivals.groupBy(F.col("dst").alias("vertex"))
            .agg(best.alias("best"))
            .select("vertex", F.col("best.cost").alias("cost"), F.col("best.src").alias("head"))
        )
    finally:
        layout.drop()


def cheapest_paths(vertices: DataFrame, edges: DataFrame, source: object) -> DataFrame:
    """(vertex, cost, path) of the reached vertices; the path runs from the source on.

    The paths are put together from the predecessors by doubling: with each join a
    path's known end grows to twice its length.
    """
    slots = TwoSlots(edges.sparkSession)
    trails = _predecessors(vertices, edges, source, slots).withColumn("trail", F.array("vertex"))
    while True:
        is_open = F.col("head") != F.lit(source)
        if trails.filter(is_open).isEmpty():
            break
        earlier = trails.select(
            F.col("vertex").alias("head"),
            F.col("head").alias("new_head"),
            F.col("trail").alias("earlier_trail"),
        )
        longer = trails.filter(is_open).join(earlier, "head").select(
            "vertex", "cost", F.col("new_head").alias("head"),
            F.concat("earlier_trail", "trail").alias("trail"),
        )
        trails = slots.write(trails.filter(~is_open).unionByName(longer))
    slots.keep_last(edges.sparkSession)
    start = _start(vertices, source).select("vertex", "cost", F.array("vertex").alias("path"))
    return start.unionByName(
        trails.select("vertex", "cost", F.array_prepend("trail", F.col("head")).alias("path"))
    )


def lay_out_backwards(edges: DataFrame) -> EdgeLayout:
    """The cheapest edges turned round, for several calls that go towards landmarks."""
    return _laid_out(cheapest_edges(edges).select(F.col("dst").alias("src"), F.col("src").alias("dst"), "cost"))


def costs_to_landmarks(
    vertices: DataFrame, edges: DataFrame | EdgeLayout, landmarks: Sequence[object]
) -> DataFrame:
    """(vertex, landmark, cost) along the edges' direction; no row where none leads there.

    ``edges`` may be laid out already, by ``lay_out_backwards``; the caller drops these.
    """
    start = (
        vertices.filter(F.col("code").isin(list(landmarks)))
        .select(F.col("code").alias("vertex"), F.col("code").alias("landmark"))
        .distinct()
        .select("vertex", "landmark", F.lit(0.0).alias("cost"), F.lit(True).alias("active"))
    )
    given = isinstance(edges, EdgeLayout)
    layout = edges if given else lay_out_backwards(edges)
    try:
        return _relax(start, layout, ["vertex", "landmark"])
    finally:
        if not given:
            layout.drop()


def landmark_maps(
    vertices: DataFrame, edges: DataFrame | EdgeLayout, landmarks: Sequence[object]
) -> DataFrame:
    """(vertex, costs) with a map from landmark to cost, empty where none is reached.

    A vertex has at most one row a landmark, so a group is no larger than the list.
    ``edges`` as in ``costs_to_landmarks``.
    """
    costs = costs_to_landmarks(vertices, edges, landmarks)
    entries = F.collect_list(F.struct("landmark", "cost"))
    maps = costs.groupBy("vertex").agg(F.map_from_entries(entries).alias("costs"))
    return (
        vertices.select(F.col("code").alias("vertex"))
        .join(maps, "vertex", "left")
        .select(
            "vertex",
            F.coalesce("costs", F.create_map().cast(maps.schema["costs"].dataType)).alias("costs"),
        )
    )


def render_path(path: Column) -> Column:
    """``A->B->C``; codes named nowhere after the first are left out."""
    codes = path.cast("array<string>")
    rest = F.filter(F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0))), lambda c: c != "nowhere")
    return F.concat_ws("->", F.element_at(codes, 1), rest)


def walk_back(ends: DataFrame, before: DataFrame) -> DataFrame:
    """(vertex, path): for each vertex of ``ends`` the path of predecessors that leads to it.

    ``before`` has (vertex, head), a forest; a path begins at a vertex without a head. By
    binary lifting: the ancestors at 1, 2, 4, ... steps are joined from those at half as
    many, until no end has one that far back. Then the known places of the paths double
    from the widest step down. A path of n steps takes about 2 log2(n) joins.
    """
    spark = before.sparkSession
    folders: list[str] = []

    def stored(df: DataFrame) -> DataFrame:
        folders.append(new_folder(spark))
        return write_table(df, folders[-1])

    ends = ends.select("vertex").distinct()
    ancestors = [stored(before.select("vertex", F.col("head").alias("up")))]
    try:
        while True:
            last = ancestors[-1]
            if last.join(ends, "vertex", "left_semi").isEmpty():
                break
            further = last.select(F.col("vertex").alias("up"), F.col("up").alias("next"))
            ancestors.append(stored(last.join(further, "up").select("vertex", F.col("next").alias("up"))))
        known = ends.select("vertex", F.col("vertex").alias("node"), F.lit(0).cast("long").alias("back"))
        for i in range(len(ancestors) - 2, -1, -1):
            step = ancestors[i].select(F.col("vertex").alias("node"), "up")
            far = known.join(step, "node").select("vertex", F.col("up").alias("node"), F.col("back") + (1 << i))
            known = known.unionAll(far)
        places = F.sort_array(F.collect_list(F.struct("back", "node")), asc=False)
        return write_table(known.groupBy("vertex").agg(places["node"].alias("path")))
    finally:
        for folder in folders:
            delete_folder(spark, folder)


def cheapest_multi_hop_paths(graph: RouteGraph, source: object = "LAX", rows: int = 10) -> DataFrame:
    """The ``rows`` cheapest paths of more than two vertices, rendered, with their rank.

    A path has more than two vertices if its last predecessor is not the source, so the
    rows are chosen first and only their paths are walked back.
    """
    kept = TwoSlots(graph.routes.sparkSession)
    before = _predecessors(all_codes(graph), route_costs(graph.routes), source, kept)
    top = before.filter(F.col("head") != F.lit(source)).orderBy("cost", "vertex").limit(rows)
    found = top.join(walk_back(top, before), "vertex")
    # At most ``rows`` rows, which the join may have put out of order.
    rank = F.row_number().over(Window.orderBy("cost", "vertex")).cast("long")
    return found.select(rank.alias("rank"), "vertex", render_path(F.col("path")).alias("path"), "cost")


def cheapest_airports(graph: RouteGraph, source: object = "LAX", rows: int = 10) -> DataFrame:
    """Of the ``rows`` cheapest vertices from the source, those that are known airports,
    with their rank."""
    costs = cheapest_costs(all_codes(graph), route_costs(graph.routes), source)
    cheapest = costs.withColumnRenamed("vertex", "code").orderBy("cost", "code").limit(rows)
    return ranked(known_only(cheapest, graph), F.col("cost"), rows)
