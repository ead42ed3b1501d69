import pytest
from pyspark.sql import types as T

from goldens import rows
from skyroute import schema
from skyroute.sources import flights


def write(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_binds_by_position_and_keeps_every_row(spark, tmp_path):
    layout = T.StructType(
        [
            T.StructField("a", T.IntegerType()), T.StructField("b", T.ByteType()),
            T.StructField("c", T.DoubleType()), T.StructField("d", T.StringType()),
        ]
    )
    path = write(
        tmp_path, "bad.csv",
        ["w,x,y,z", "1,5,NA,a", "2,300,1.5,", '3,abc,2,"q,r"', "4", "5,1,1,b,extra"],
    )
    assert sorted(map(tuple, flights.read_csv(spark, path, layout).collect())) == [
        (1, 5, None, "a"), (2, None, 1.5, None), (3, None, 2.0, "q,r"),
        (4, None, None, None), (5, 1, 1.0, "b"),
    ]


def test_schemas():
    assert len(schema.FLIGHTS) == len(schema.UPPER_LAYOUT) == 31
    assert len(schema.PROJECTION) == len(schema.LINE) == 17
    assert len(schema.SHORT_LAYOUT) == 7
    assert schema.UPPER_LAYOUT["DISTANCE"].dataType == T.IntegerType()
    assert schema.LINE["DayOfWeek"].dataType == T.ByteType()


def test_projection_takes_the_spelling_asked_for(spark):
    table = spark.createDataFrame([], schema.FLIGHTS)
    assert tuple(flights.project(table).columns) == schema.PROJECTION


GOOD = "1,3,600.0,555.0,700.0,650.0,WN,12,N1,60.0,55.0,40.0,5.0,45.0,LAX,SFO,337.0"


def test_lines_strict_and_tolerant(spark):
    bad_day = GOOD.replace("1,3,", "1,Wed,", 1)
    short = "1,3,600.0"
    lines = spark.createDataFrame([(GOOD,), (bad_day,), (short,)], "line STRING")
    parsed = flights.parse_lines(lines.limit(1)).first()
    assert (parsed.No, parsed.DayOfWeek, parsed.Origin, parsed.Distance) == (1, 3, "LAX", 337.0)
    for line in (bad_day, short):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|INVALID_ARRAY_INDEX"):
            flights.parse_lines(spark.createDataFrame([(line,)], "line STRING")).collect()
    tolerant = flights.parse_lines(lines, strict=False)
    assert rows(tolerant, "malformed", "line") == sorted(
        [(False, GOOD), (True, bad_day), (True, short)]
    )
    assert tolerant.filter("malformed AND DayOfWeek IS NULL AND Origin = 'LAX'").count() == 1


def test_layouts_agree(spark, tmp_path):
    full = {c: "x" for c in schema.UPPER_COLUMNS}
    full |= {"ORIGIN_AIRPORT": "LAX", "DESTINATION_AIRPORT": "SFO", "DISTANCE": "337"}
    long = write(tmp_path, "long.csv", [",".join(full), ",".join(full.values())])
    short = write(
        tmp_path, "short.csv",
        [",".join(schema.SHORT_COLUMNS), ",".join(full[c] for c in schema.SHORT_COLUMNS)],
    )
    for path, layout in ((long, schema.UPPER_LAYOUT), (short, schema.SHORT_LAYOUT)):
        table = flights.read_csv(spark, path, layout)
        assert rows(flights.normalize_layout(table)) == [("LAX", "SFO", 337.0)]


def test_preview_and_profile(spark):
    table = spark.createDataFrame(
        [(i, float(i % 3) if i % 4 else None, "a" if i < 90 else None) for i in range(100)],
        "n INT, x DOUBLE, s STRING",
    )
    assert rows(flights.profile(table), "position", "name", "type", "non_null", "distinct_values") == [
        (1, "n", "int", 100, 100), (2, "x", "double", 75, 3), (3, "s", "string", 90, 1),
    ]
    bounds = {r.name: r for r in flights.profile(table).collect()}
    assert (bounds["n"].min_number, bounds["n"].max_number, bounds["n"].min_text) == (0.0, 99.0, None)
    assert (bounds["s"].min_text, bounds["s"].max_text, bounds["s"].max_number) == ("a", "a", None)
    empty = spark.createDataFrame([], "n INT, s STRING")
    assert [r.non_null for r in flights.profile(empty).collect()] in ([], [0, 0])
