import pathlib
import random
import re
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from goldens import rows
from skyroute.functions import ordered
from skyroute.functions.scratch import new_folder, scope, scratch_root, write_table


@pytest.fixture(scope="module", autouse=True)
def several_parts(spark):
    """Small tables would be merged into one part, which has no seams to get wrong."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, and many are exact copies."""
    draw = random.Random(3)
    data = [("hot", 7, 1) for _ in range(700)]
    data += [("hot", draw.randrange(300), draw.randrange(5)) for _ in range(300)]
    data += [(f"k{draw.randrange(50)}", draw.randrange(100), draw.randrange(5)) for _ in range(2000)]
    draw.shuffle(data)
    return data, write_table(spark.createDataFrame(data, "k STRING, v INT, n INT").repartition(8))


def test_row_numbers_cover_all_rows_in_order(skewed):
    data, df = skewed
    found = rows(ordered.number_rows(df, ["k", "v", "n"]), "number", "k", "v", "n")
    assert [r[0] for r in found] == list(range(1, len(data) + 1))
    assert [r[1:] for r in found] == sorted(data)


def test_descending_order(skewed):
    data, df = skewed
    found = rows(ordered.number_rows(df, [F.col("v").desc(), "k", "n"]), "number", "v")
    assert [v for _, v in found] == sorted((d[1] for d in data), reverse=True)


def test_copies_spread_over_parts(skewed):
    data, df = skewed
    sizes = ordered.sort_table(df, ["k", "v", "n"]).groupBy(ordered.PART).count().collect()
    assert len(sizes) > 1
    assert max(r["count"] for r in sizes) < len(data) / 2


def test_running_totals(spark, skewed):
    data, _ = skewed
    counts = {}
    for _, v, n in data:
        counts[v] = counts.get(v, 0) + n
    expected = list(zip(sorted(counts), accumulate(counts[v] for v in sorted(counts))))
    df = spark.createDataFrame(list(counts.items()), "v INT, n LONG").repartition(8)
    assert rows(ordered.running_totals(df, ["v"], {"upto": "n"}), "v", "upto") == expected


def test_successor_within_groups_matches_a_plain_walk(skewed):
    data, df = skewed
    walk = sorted(data)
    expected = sorted((a[0], a[1], b[1]) for a, b in zip(walk, walk[1:]) if a[0] == b[0])
    led = ordered.with_successor(df, ["k", "v", "n"], ["k", "v"])
    same = led.filter(F.col("next.k") == F.col("k")).select("k", "v", F.col("next.v").alias("after"))
    assert rows(same) == expected
    assert led.filter("next IS NULL").count() == 1


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k STRING, v INT, n INT")
    assert ordered.number_rows(empty, ["k"]).count() == 0
    assert ordered.with_successor(empty, ["k"], ["k"]).count() == 0
    assert ordered.running_totals(empty, ["k"], {"t": "n"}).count() == 0


@pytest.mark.parametrize("name", ["running_totals", "with_successor"])
def test_parts_are_read_without_a_second_shuffle(spark, skewed, name):
    _, df = skewed
    few = df.groupBy("v").agg(F.sum("n").alias("n"))
    led = (
        ordered.running_totals(few, ["v"], {"upto": "n"}) if name == "running_totals"
        else ordered.with_successor(df, ["k", "v", "n"], ["k", "v"])
    )
    plan = led._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Bucketed: true" in plan
    assert not re.search(r"Exchange hashpartitioning\(_part#\d+, \d+\), ENSURE_REQUIREMENTS.*\n.*FileScan.*_position.*v#", plan)
    above_window = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in above_window, plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("skyroute_")]


def test_parts_follow_the_bytes(spark, skewed, monkeypatch):
    data, df = skewed
    sizes = []
    for most in (1 << 40, 512):
        monkeypatch.setattr(ordered, "PART_BYTES", most)
        table = ordered.sort_table(df, ["k", "v", "n"], bucketed=True)
        sizes.append(table.select(ordered.PART).distinct().count())
        assert table.count() == len(data)
    assert sizes[0] <= int(spark.conf.get("spark.sql.shuffle.partitions")) < sizes[1]
    found = rows(ordered.number_rows(df, ["k", "v", "n"]), "number", "k", "v", "n")
    assert [r[1:] for r in found] == sorted(data)


def folders(spark):
    path = pathlib.Path(scratch_root(spark).removeprefix("file:")) / "skyroute"
    return {p.name for p in path.iterdir()} if path.exists() else set()


def test_a_scope_leaves_nothing(spark, skewed):
    _, df = skewed
    before = folders(spark)
    kept = new_folder(spark)
    with scope(spark):
        write_table(ordered.number_rows(df, ["k", "v", "n"]), kept)
        with scope(spark):
            ordered.with_successor(df, ["k"], ["k"]).count()
    assert folders(spark) - before == {kept.rsplit("/", 1)[1]}
    assert spark.read.parquet(kept).count() == df.count()
    with pytest.raises(ZeroDivisionError), scope(spark):
        write_table(df)
        1 / 0
    assert folders(spark) - before == {kept.rsplit("/", 1)[1]}


def test_scratch_folder_is_the_session_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("parts", [1, 8, 13, 200])
def test_parts_have_a_bucket_each(spark, parts):
    names = ordered.part_names(parts)
    assert names == sorted(set(names)) and len(names) == parts
    hashed = spark.createDataFrame([(n,) for n in names], "n INT").select(F.expr(f"pmod(hash(n), {parts})"))
    assert sorted(r[0] for r in hashed.collect()) == list(range(parts))


def test_a_task_reads_one_part(spark, skewed):
    """With fewer tasks than parts some tasks would read several and others none."""
    _, df = skewed
    table = ordered.sort_table(df, ["k", "v", "n"], bucketed=True)
    tasks = [set(r.parts) for r in table.groupBy(F.spark_partition_id()).agg(F.collect_set(ordered.PART).alias("parts")).collect()]
    assert all(len(p) == 1 for p in tasks), tasks
