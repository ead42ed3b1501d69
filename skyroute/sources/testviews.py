"""The views ``flights``, ``hops`` and ``scored`` over the supplied test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.functions.ordered import with_successor
from skyroute.functions.scratch import folder_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight per line item; the nations of supplier and customer are the airports.

    The order's and the supplier's nation are looked up first, so the line items,
    the large side, take part in two joins instead of five.
    """
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    dest = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", F.col("n_name").alias("Dest"))
    )
    origin = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("Origin"))
    )
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(dest, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(origin, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    minute = "CAST(floor(l_extendedprice) AS BIGINT) % 1440"
    return joined.selectExpr(
        "CAST(l_orderkey AS INT) AS num",
        "CAST(l_linenumber AS INT) AS no",
        "CAST(year(l_shipdate) AS INT) AS year",
        "CAST(month(l_shipdate) AS INT) AS month",
        "CAST(day(l_shipdate) AS TINYINT) AS dayofmonth",
        "CAST(weekday(l_shipdate) + 1 AS TINYINT) AS dayofweek",
        f"{minute} + l_quantity AS DepTime",
        f"CAST({minute} AS DOUBLE) AS CRSDepTime",
        f"{minute} + 60 + 10 * l_linenumber + l_quantity + round(l_discount * 100) AS ArrTime",
        f"CAST({minute} + 60 + 10 * l_linenumber AS DOUBLE) AS CRSArrTime",
        "concat(l_returnflag, l_linestatus) AS UniqueCarrier",
        "CAST(l_suppkey AS STRING) AS FlightNum",
        "CAST(l_partkey % 500 AS STRING) AS TailNum",
        "60 + 10 * l_linenumber + round(l_discount * 100) AS ActualElapsedTime",
        "CAST(60 + 10 * l_linenumber AS DOUBLE) AS CRSElapsedTime",
        "40 + 10 * l_linenumber + round(l_discount * 100) AS AirTime",
        "l_quantity + round(l_discount * 100) AS ArrDelay",
        "l_quantity AS DepDelay",
        "Origin",
        "Dest",
        "CAST(floor(l_extendedprice / 100) AS DOUBLE) AS Distance",
    )


def dirty_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flights`` where fixed rows miss an end or a distance, or have a bad delay."""
    bad = F.expr("(num * 7 + no) % 23")
    changes = {
        "Origin": F.when(bad != 0, F.col("Origin")),
        "Dest": F.when(bad != 1, F.col("Dest")),
        "Distance": F.when(bad == 3, float("nan")).when(bad != 2, F.col("Distance")),
        "DepDelay": F.when(bad == 4, -F.col("DepDelay")).when(bad == 5, float("nan")).when(bad != 6, F.col("DepDelay")),
    }
    return flights(spark, sf_dir).withColumns(changes)


def hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (src, dst, dist): each part of an order leads to the order's next part.

    The next line is found in the global order of lines, so one huge order spreads
    over many tasks like any other rows. The table's size bounds that of its columns.
    """
    line_order = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_shipdate",
    ]
    lines = table(spark, sf_dir, "lineitem").select(
        *line_order, F.floor(F.col("l_extendedprice") / 100).cast("double").alias("dist")
    )
    size = folder_bytes(spark, f"{sf_dir}/lineitem.parquet")
    followed = with_successor(lines, line_order, keep=["l_orderkey", "l_partkey", "dist"], size=size)
    return (
        followed.filter(F.col("next.l_orderkey") == F.col("l_orderkey"))
        .select(F.col("l_partkey").alias("src"), F.col("next.l_partkey").alias("dst"), "dist")
        .filter(F.col("dst").isNotNull())
        .distinct()
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic stand-in for the output of a classifier."""
    tenths = "l_quantity + round(l_discount * 100)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_quantity >= 40 THEN 1.0D ELSE 0.0D END AS label",
        f"({tenths}) / 100 AS score",
        f"CASE WHEN {tenths} >= 45 THEN 1.0D ELSE 0.0D END AS prediction",
    )
