import os

import pytest

from skyroute import __main__ as job
from skyroute import schema
from skyroute.sources import testviews

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_batch_job(spark, tmp_path):
    view = testviews.flights(spark, SF_DIR)
    known = {c.lower(): c for c in view.columns}
    columns = [
        (view[known[f.name.lower()]] if f.name.lower() in known else job.F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.FLIGHTS
    ]
    view.select(*columns).write.option("header", True).csv(f"{tmp_path}/flights.csv")
    job.run(spark, job.arguments([f"{tmp_path}/flights.csv", f"{tmp_path}/out", "--learner", "Naive Bayes"]))
    read = lambda name: spark.read.option("header", True).csv(f"{tmp_path}/out/{name}")
    assert {r.Name for r in read("metrics").collect()} >= {"Accuracy", "F1-Score"}
    tested = sum(int(r.n) for r in read("splits").collect() if r.part == "test")
    assert tested > 100 and read("predictions").count() == tested == sum(int(r.n) for r in read("confusion").collect())
    assert set(read("predictions").columns) >= {"FlightNum", "label", "prediction", "score"}
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["confusion", "left_out", "metrics", "predictions", "splits"]
    assert {r.n for r in read("left_out").collect()} == {"0"}


HEADER = ",".join(f.name for f in schema.FLIGHTS)


def flight_lines(tmp_path, missing):
    """Lines of a small CSV: some numbers are missing, one line is short, one has a bad field."""
    names = [f.name for f in schema.FLIGHTS]
    numeric = {"dayofweek": 3, "DepTime": 900, "CRSDepTime": 850, "ArrTime": 1000, "CRSArrTime": 990, "DepDelay": 10}
    lines = [HEADER]
    for i in range(400):
        row = dict.fromkeys(names, "") | {k: str(v + i % 7) for k, v in numeric.items()}
        row |= {"FlightNum": str(i % 9), "TailNum": f"N{i % 5}", "UniqueCarrier": "AA", "dayofweek": str(1 + i % 7)}
        row["DepDelay"] = "60" if i % 2 else "5"
        if missing and i % 10 == 3:
            row["ArrTime"] = ""
        lines.append(",".join(row[n] for n in names))
    if missing:
        lines[1] = ",".join(lines[1].split(",")[:20])
        lines[2] = lines[2].replace(",850,", ",x,") if ",850," in lines[2] else lines[2].replace(",851,", ",x,")
    path = tmp_path / "small.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_missing_numbers_fail_or_are_counted(spark, tmp_path):
    path = flight_lines(tmp_path, missing=True)
    with pytest.raises(Exception, match="null"):
        job.run(spark, job.arguments([path, f"{tmp_path}/a", "--learner", "Naive Bayes"]))
    job.run(spark, job.arguments([path, f"{tmp_path}/b", "--learner", "Naive Bayes", "--skip-missing"]))
    left = dict(spark.read.option("header", True).csv(f"{tmp_path}/b/left_out").select("reason", "n").collect())
    assert left["malformed lines"] == "2" and left["of these short lines"] == "1"
    assert int(left["sampled flights with missing numbers"]) >= 40


def test_whole_files_leave_nothing_out(spark, tmp_path):
    job.run(spark, job.arguments([flight_lines(tmp_path, False), f"{tmp_path}/c", "--learner", "Naive Bayes"]))
    assert {r.n for r in spark.read.option("header", True).csv(f"{tmp_path}/c/left_out").collect()} == {"0"}
