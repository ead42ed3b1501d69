"""Flights from CSV, from text lines and from the alternative layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyroute import schema

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    layout: T.StructType = schema.FLIGHTS,
    corrupt: bool = False,
    header: bool = True,
) -> DataFrame:
    """Read a CSV with a header line; columns bind by position, bad fields become null.

    With ``corrupt`` a column ``_corrupt_record`` has the line where a field that the query
    uses is bad, or where their number is another one, and is null for other lines.
    """
    reader = spark.read.option("header", header)
    if corrupt:
        layout = T.StructType([*layout.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return reader.schema(layout).csv(path)


def csv_report(flights: DataFrame) -> DataFrame:
    """One row: the lines, the malformed ones among them, and of these the short ones.

    ``flights`` are read with ``corrupt``. Separators inside quotes are no field's end.
    """
    fields = len(flights.columns) - 1
    line = F.col(CORRUPT)
    short = F.size(F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)) < fields
    # Only fields that are used are parsed and judged: use all.
    other = F.coalesce(*[F.col(c).cast("string") for c in flights.columns if c != CORRUPT])
    read = F.count(other) + F.count_if(other.isNull())
    return flights.agg(
        read.alias("n_lines"), F.count(line).alias("malformed"), F.count_if(line.isNotNull() & short).alias("short_lines")
    )


def project(flights: DataFrame) -> DataFrame:
    """The 17 working columns, named in the projection's spelling."""
    return flights.select(*schema.PROJECTION)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def parse_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Split comma-separated ``line`` into the 17 typed fields.

    Strict parsing fails the job on the first bad field or short line. Otherwise bad
    fields are null, and the column ``malformed`` marks the lines to set aside.
    """
    cells = F.split("line", ",", -1)
    if strict:
        return lines.select(
            *[cells[i].cast(f.dataType).alias(f.name) for i, f in enumerate(schema.LINE)]
        )
    fields = [
        F.get(cells, F.lit(i)).try_cast(f.dataType).alias(f.name)
        for i, f in enumerate(schema.LINE)
    ]
    parsed = lines.select("line", *fields)
    bad = reduce(lambda a, b: a | b, [F.col(f.name).isNull() for f in schema.LINE])
    return parsed.select(*schema.LINE.names, bad.alias("malformed"), "line")


def normalize_layout(table: DataFrame) -> DataFrame:
    """Map the 31- or 7-column upper-case layout onto Origin, Dest, Distance."""
    return table.select(
        F.col("ORIGIN_AIRPORT").alias("Origin"),
        F.col("DESTINATION_AIRPORT").alias("Dest"),
        F.col("DISTANCE").cast("double").alias("Distance"),
    )


def preview(flights: DataFrame, rows: int = 50) -> DataFrame:
    """The first ``rows`` flights in the order of all working columns."""
    return project(flights).orderBy(*schema.PROJECTION).limit(rows)


def profile(flights: DataFrame) -> DataFrame:
    """Per column: position, name, type, non-null and distinct count, smallest and largest.

    Values are counted per (column, value) first, so a common value is combined on the
    map side and never gathers in one task. Numbers and text have their own bounds.
    """
    cells = []
    for position, field in enumerate(flights.schema.fields, start=1):
        value = F.col(field.name)
        text = isinstance(field.dataType, T.StringType)
        cells.append(
            F.struct(
                F.lit(position).alias("position"),
                (F.lit(None) if text else value).cast("double").alias("number"),
                (value if text else F.lit(None)).cast("string").alias("text"),
            )
        )
    names = F.array(*[F.lit(f.name) for f in flights.schema.fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in flights.schema.fields])
    counted = (
        flights.select(F.inline(F.array(*cells)))
        .groupBy("position", "number", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.col("number").isNotNull() | F.col("text").isNotNull()
    return (
        counted.groupBy("position")
        .agg(
            F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("non_null"),
            F.count_if(known).alias("distinct_values"),
            F.min("number").alias("min_number"),
            F.max("number").alias("max_number"),
            F.min("text").alias("min_text"),
            F.max("text").alias("max_text"),
        )
        .select(
            "position",
            F.element_at(names, F.col("position")).alias("name"),
            F.element_at(types, F.col("position")).alias("type"),
            "non_null", "distinct_values",
            "min_number", "max_number", "min_text", "max_text",
        )
    )
