"""Schemas of the flights table and its alternative layouts."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPE_NAMES = {
    "int": T.IntegerType(),
    "tinyint": T.ByteType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def _table(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPE_NAMES[kind]) for name, kind in columns])


# Column names, types and order of the flights CSV.
FLIGHTS = _table(
    ("num", "int"),
    ("no", "int"),
    ("year", "int"),
    ("month", "int"),
    ("dayofmonth", "tinyint"),
    ("dayofweek", "tinyint"),
    ("DepTime", "double"),
    ("CRSDepTime", "double"),
    ("ArrTime", "double"),
    ("CRSArrTime", "double"),
    ("UniqueCarrier", "string"),
    ("FlightNum", "string"),
    ("TailNum", "string"),
    ("ActualElapsedTime", "double"),
    ("CRSElapsedTime", "double"),
    ("AirTime", "double"),
    ("ArrDelay", "double"),
    ("DepDelay", "double"),
    ("Origin", "string"),
    ("Dest", "string"),
    ("Distance", "double"),
    ("TaxiIn", "string"),
    ("TaxiOut", "string"),
    ("Cancelled", "string"),
    ("CancellationCode", "string"),
    ("Diverted", "string"),
    ("CarrierDelay", "string"),
    ("WeatherDelay", "string"),
    ("NASDelay", "string"),
    ("SecurityDelay", "string"),
    ("LateAircraftDelay", "string"),
)

# The working projection, in its spelling.
PROJECTION = (
    "No", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "UniqueCarrier", "FlightNum", "TailNum", "ActualElapsedTime", "CRSElapsedTime",
    "AirTime", "ArrDelay", "DepDelay", "Origin", "Dest", "Distance",
)

# The 31-column upper-case layout; every column is text but DISTANCE.
UPPER_COLUMNS = (
    "YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "AIRLINE", "FLIGHT_NUMBER", "TAIL_NUMBER",
    "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE", "DEPARTURE_TIME",
    "DEPARTURE_DELAY", "TAXI_OUT", "WHEELS_OFF", "SCHEDULED_TIME", "ELAPSED_TIME",
    "AIR_TIME", "DISTANCE", "WHEELS_ON", "TAXI_IN", "SCHEDULED_ARRIVAL",
    "ARRIVAL_TIME", "ARRIVAL_DELAY", "DIVERTED", "CANCELLED", "CANCELLATION_REASON",
    "AIR_SYSTEM_DELAY", "SECURITY_DELAY", "AIRLINE_DELAY", "LATE_AIRCRAFT_DELAY",
    "WEATHER_DELAY",
)

# The 7-column layout.
SHORT_COLUMNS = (
    "YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT",
    "DISTANCE",
)


def _upper(columns: tuple[str, ...]) -> T.StructType:
    return _table(*[(c, "int" if c == "DISTANCE" else "string") for c in columns])


UPPER_LAYOUT = _upper(UPPER_COLUMNS)
SHORT_LAYOUT = _upper(SHORT_COLUMNS)

_TYPES = {f.name.lower(): f.dataType for f in FLIGHTS.fields}

# A text line holds the projection's fields, with the table's types.
LINE = T.StructType([T.StructField(c, _TYPES[c.lower()]) for c in PROJECTION])
