"""Message passing over a graph as a loop of DataFrame jobs.

The state stays in buckets by its keys (``Resident``). A round joins the rows that
changed last to their edges, combines the messages to one vertex on the map side, shuffles
these, and joins them to the resident rows where they lie. Only rows that change are
written, so late rounds shuffle and write what their frontier is, not the graph's size;
each reads the state once.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyroute.functions.resident import Resident
from skyroute.functions.scratch import delete_folder, new_folder, write_bucketed, write_table

SLOT_ROWS = 4_000_000
MAX_HUBS = 100_000
MAX_BUCKETS = 20_000


class EdgeLayout(NamedTuple):
    """Edges laid out by source once, for all rounds.

    ``edges`` are bucketed by source, as the state is by vertex. Sources with too many
    edges for a bucket are kept apart: ``fans(src, fan)`` says in how many slots, and
    ``hubs`` has their edges, bucketed by source and slot. Both are None if there are none.
    """

    edges: DataFrame
    hubs: DataFrame | None
    fans: DataFrame | None
    folder: str
    tables: list[str]

    def drop(self) -> None:
        """Delete the stored edges, once all that reads them has been written."""
        spark = self.edges.sparkSession
        for table in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(spark, self.folder)

    def every(self) -> DataFrame:
        """All edges."""
        return self.edges if self.hubs is None else self.edges.unionByName(self.hubs.drop("slot"))

    def out_of(self, rows: DataFrame) -> DataFrame:
        """Join ``rows``, by their ``vertex``, to the edges that leave it.

        The rows are hashed in memory and the edges stream by, neither shuffled nor
        sorted; rows that are bucketed by vertex aren't shuffled either, but for copies
        of hubs, one for each slot.
        """
        rows = rows.withColumnRenamed("vertex", "src")
        near = rows.hint("shuffle_hash").join(self.edges, "src")
        if self.hubs is None:
            return near
        slots = F.explode(F.sequence(F.lit(0), F.col("fan") - 1))
        spread = rows.join(F.broadcast(self.fans), "src").withColumn("slot", slots).drop("fan")
        far = spread.hint("shuffle_hash").join(self.hubs, ["src", "slot"]).drop("slot")
        return near.unionByName(far)


def lay_out(
    edges: DataFrame,
    slot_rows: int = SLOT_ROWS,
    max_hubs: int = MAX_HUBS,
    max_buckets: int = MAX_BUCKETS,
) -> EdgeLayout:
    """Store (src, dst, ...) edges, bucketed by source, with large sources split.

    No round shuffles edges. A source with more than ``slot_rows`` edges has several
    slots, spread by hash. ``max_hubs`` bounds the broadcast table of such sources, by
    larger slots if need be, and ``max_buckets`` the number of files; past it buckets
    grow. No edge is left out.
    """
    folder = new_folder(edges.sparkSession)
    try:
        return _lay_out(edges, folder, slot_rows, max_hubs, max_buckets)
    except BaseException:
        delete_folder(edges.sparkSession, folder)
        raise


def _lay_out(edges: DataFrame, folder: str, slot_rows: int, max_hubs: int, max_buckets: int) -> EdgeLayout:
    spark = edges.sparkSession
    stored = write_table(edges, f"{folder}/edges")
    by_source = stored.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    total, most = by_source.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    # At most total / slot_rows sources exceed slot_rows, which bounds the broadcast.
    slot_rows = max(slot_rows, math.ceil(total / max_hubs))
    # With fewer buckets than shuffle partitions Spark would shuffle the table after all.
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(min(math.ceil(total / slot_rows), max_buckets), least)
    if most <= slot_rows:
        near, name = write_bucketed(stored, ["src"], buckets, f"{folder}/near")
        delete_folder(spark, f"{folder}/edges")
        return EdgeLayout(near, None, None, folder, [name])
    fan = F.ceil(F.col("n") / slot_rows).cast("int").alias("fan")
    fans = write_table(by_source.filter(F.col("n") > slot_rows).select("src", fan), f"{folder}/fans")
    few = stored.join(F.broadcast(fans), "src", "left_anti")
    near, name = write_bucketed(few, ["src"], buckets, f"{folder}/near")
    others = [c for c in edges.columns if c != "src"]
    slot = F.pmod(F.xxhash64(*others), F.col("fan")).cast("int").alias("slot")
    many = stored.join(F.broadcast(fans), "src").select("src", slot, *others)
    hubs, hub_name = write_bucketed(many, ["src", "slot"], buckets, f"{folder}/hubs")
    delete_folder(spark, f"{folder}/edges")
    return EdgeLayout(near, hubs, fans, folder, [name, hub_name])


def propagate(
    state: DataFrame,
    layout: EdgeLayout,
    send: Mapping[str, Column],
    merge: Mapping[str, Column],
    update: Mapping[str, Column],
    keys: Sequence[str] = ("vertex",),
    changed: Column | None = None,
    max_rounds: int | None = None,
) -> DataFrame:
    """Run rounds until no row changes, and return the final state.

    ``state`` has one row for each value of the ``keys``, ``vertex`` among them, any
    value columns and a boolean ``active``. A round
      - joins the active rows among those changed last to their out-edges and makes a row
        of the ``send`` columns for the vertex at ``dst``; further keys come along;
      - aggregates these by ``keys`` with ``merge``;
      - puts the state's columns beside (null for new keys), keeps the rows that have
        ``changed``, and selects ``update`` as their next state.
    Columns of ``merge`` and of the state need different names.
    """
    keys = list(keys)
    resident = Resident(state, keys)
    try:
        rounds, last = 0, resident.base
        while last and (max_rounds is None or rounds < max_rounds):
            met = next_versions(resident, layout, send, merge)
            met = met if changed is None else met.filter(changed)
            last = resident.append(met.select(*keys, *[c.alias(name) for name, c in update.items()]))
            rounds += 1
        return resident.finish()
    except BaseException:
        resident.drop()
        raise


def next_versions(
    resident: Resident,
    layout: EdgeLayout,
    send: Mapping[str, Column],
    merge: Mapping[str, Column],
    frontier: DataFrame | None = None,
) -> DataFrame:
    """What the ``frontier`` sends, merged, beside the resident rows that it reaches.

    The frontier is by default the active rows among those that changed last.
    """
    if frontier is None:
        frontier = resident.changed().filter("active")
    along = [k for k in resident.keys if k != "vertex"]
    messages = layout.out_of(frontier).select(
        F.col("dst").alias("vertex"), *along, *[c.alias(name) for name, c in send.items()]
    )
    merged = messages.groupBy(*resident.keys).agg(*[c.alias(name) for name, c in merge.items()])
    return resident.join_latest(merged)
