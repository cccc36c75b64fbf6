"""Many requests: slots of time and place, folders of requests, and how they are listed."""

import glob

import pytest
from pyspark.sql import functions as F

import gridsieve as gs
from gridsieve.operators.timeclip import time_slots, within
from gridsieve.plans.many import by_time, read_extract
from gridsieve.sinks.writers import write_parquet
from test_clip import polygon, square

# start and end days of requests; -9 and 99 lie outside of the data, None is open
RANGES = {1: (0, 2), 2: (3, 3), 3: (None, 4), 4: (5, None), 5: (None, None), 6: (-9, -2), 7: (50, 99), 8: (-9, 99), 9: (6, 2)}
DAY = 86_400_000_000


def days(column):
    return F.lit("2000-01-01").cast("timestamp_ntz") + F.make_dt_interval(column)


@pytest.fixture
def cells(spark):
    """Cells of ten days on eight by eight places, one of them without a time."""
    place = F.col("id") % 64
    return spark.range(640).select(
        F.when(F.col("id") != 77, days(F.floor(F.col("id") / 64).cast("int"))).alias("time"),
        (place % 8 + 0.5).cast("double").alias("x"), (F.floor(place / 8) + 0.5).cast("double").alias("y"), F.col("id").alias("v"),
    )


def ranges(spark, key):
    rows = [(k, None if a is None else a * DAY, None if b is None else b * DAY) for k, (a, b) in RANGES.items()]
    return spark.createDataFrame(rows, f"{key} BIGINT, since BIGINT, until BIGINT")


def expected(cells, inside):
    found = []
    for r in cells.collect():
        day = None if r["time"] is None else (r["time"].day - 1)
        for k, (a, b) in RANGES.items():
            kept = a is None and b is None if day is None else (a is None or a <= day) and (b is None or day <= b)
            if kept and inside(k, r["x"], r["y"]):
                found.append((k, r["v"]))
    return sorted(found)


def test_areas_meet_cells_through_slots_of_time(spark, cells):
    # squares of one and a half cells, and one that covers the whole grid
    corner = {k: (k % 6 + 0.25, k % 4 + 0.25, 1.5) for k in RANGES} | {5: (0.25, 0.25, 7.5)}
    edges = gs.area_edges(gs.areas_from_features(spark, [(k, polygon(square(x, y, s, s))) for k, (x, y, s) in corner.items()]))
    micros = F.timestamp_diff("MICROSECOND", days(F.lit(0)), F.col("time"))

    def inside(k, x, y):
        x0, y0, side = corner[k]
        return x0 <= x < x0 + side and y0 <= y < y0 + side

    for limit in (1_000_000, 0):
        clipped = gs.clip_many(cells, edges, 1.0, False, ranges=(ranges(spark, "area_id"), micros), limit=limit)
        assert sorted((r["area_id"], r["v"]) for r in clipped.collect()) == expected(cells, inside)
        # the time is one of the keys, so that cells only meet the areas of about their time
        assert "__slot" in clipped._jdf.queryExecution().optimizedPlan().toString()


def test_requests_without_areas_meet_rows_of_about_their_time(spark, cells):
    bounds = ranges(spark, "request_id").select(
        "request_id", *[days((F.col(c) / DAY).cast("int")).alias(n) for c, n in (("since", "start_date"), ("until", "end_date"))]
    )
    found = by_time(cells, "time", bounds)
    assert sorted((r["request_id"], r["v"]) for r in found.collect()) == expected(cells, lambda *_: True)


def test_slots_are_as_long_as_the_ranges(spark):
    rows = spark.range(10_000).select((F.col("id") * 1000).alias("t"))
    short = spark.range(500).select((F.col("id") * 20_000).alias("since"), (F.col("id") * 20_000 + 40_000).alias("until"))
    slots = time_slots(rows, "t", short)
    listed = slots.listed(short, "slot")
    assert listed.count() <= 3 * 500
    pairs = rows.withColumn("slot", slots.of("t")).join(listed, "slot")
    held = pairs.where(within("t")).count()
    assert held == rows.join(short, within("t")).count() and pairs.count() <= 3 * held
    # nothing to go by
    none = time_slots(rows.where("false"), "t", short)
    assert (none.width, none.last) == (1, 0) and none.listed(short, "slot").count() <= 1


def test_folders_are_rarely_split_over_files(spark, tmp_path):
    rows = spark.range(200_000, numPartitions=8).select((F.col("id") % 300).alias("request_id"), F.rand(1).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_parquet(rows, f"{tmp_path}/few", ["request_id"])
        write_parquet(rows, f"{tmp_path}/many", ["request_id"], parts=300)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    few, many = (len(glob.glob(f"{tmp_path}/{name}/*/*.parquet")) for name in ("few", "many"))
    assert many == 300 < few
    assert spark.read.parquet(f"{tmp_path}/many").count() == 200_000


def test_folders_of_requests_are_listed_by_few_tasks(spark, tmp_path):
    spark.range(150).withColumnRenamed("id", "request_id").withColumn("v", F.lit(1.0)).coalesce(1).write.partitionBy(
        "request_id"
    ).parquet(f"{tmp_path}/datasets/x.parquet")
    tracker = spark.sparkContext.statusTracker()
    seen = set(tracker.getJobIdsForGroup(None))
    read = read_extract(spark, str(tmp_path), "x")
    stages = [s for j in set(tracker.getJobIdsForGroup(None)) - seen for s in tracker.getJobInfo(j).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) < 150
    assert read.agg(F.sum("request_id"), F.count("*")).first()[:] == (150 * 149 // 2, 150)
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism", None) is None
