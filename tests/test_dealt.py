"""Joins whose rows are together by owner: the same rows as other joins, and what they move."""

import contextlib
import glob
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

import gridsieve as gs
from gridsieve.plans.extract import CATALOG
from gridsieve.plans.many import by_time, extract_many, read_extract
from gridsieve.scale import dealt_join, lookup_join, running_total
from test_clip import lattice, polygon, square
from test_extract import request
from test_many_scale import DAY, RANGES, cells, days, expected, ranges  # noqa: F401


def plain(frame):
    names = sorted(frame.columns)
    return sorted(map(str, frame.select(*names).collect()))


@pytest.fixture
def sides(spark):
    """Rows with a hot key, copies and null keys; lookup rows of owners of very different sizes, one of them null."""
    large = spark.range(3000, numPartitions=5).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") % 4).cast("int").alias("b"), F.floor(F.col("id") / 10).cast("double").alias("v.x"),
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("t"), F.col("id") % 6)).alias("t"),
    )
    large = large.unionByName(large.where("k = 7 AND b = 1").limit(200))
    many = spark.range(400).select(
        (F.col("id") % 45).alias("k"), (F.col("id") % 5).cast("int").alias("b"), F.floor(F.col("id") / 7).alias("who"),
        (F.col("id") % 90).cast("double").alias("low"),
    )
    whole = spark.range(45).crossJoin(spark.range(4).withColumnRenamed("id", "b")).select(
        F.col("id").alias("k"), F.col("b").cast("int").alias("b"), F.lit(1000).cast("long").alias("who"), F.lit(0.0).alias("low")
    )
    none = whole.withColumn("who", F.lit(None).cast("long")).where("k < 3")
    return large, many.unionByName(whole).unionByName(none)


@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize(("block", "pairs"), [(2048, 1 << 25), (16, 500), (1, 40)])
def test_dealt_rows_are_those_of_the_join(spark, sides, limit, block, pairs, monkeypatch):
    monkeypatch.setattr("gridsieve.scale.BLOCKS_TOGETHER", 2)
    large, lookup = sides
    near = F.col("`v.x`") >= F.col("low")
    right = lookup_join(large, lookup, ["k", "b"], "inner", lookup.count(), near)
    found = dealt_join(large, lookup, ["k", "b"], "who", near, limit, block, pairs)
    assert found.columns == right.columns and found.dtypes == right.dtypes
    rows = found.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()).collect()
    assert sorted(str(r[:-2]) for r in rows) == sorted(str(r[:]) for r in right.collect()) and len(rows) > 8000
    # owners follow each other in a partition, and only the large ones lie in several
    placed: dict = {}
    for r in sorted(rows, key=lambda r: r["nth"]):
        placed.setdefault(r["part"], []).append(r["who"])
    for owners in placed.values():
        known = [-1 if o is None else o for o in owners]
        assert known == sorted(known)
    if pairs >= 500:
        homes = {o: {p for p, owners in placed.items() if o in owners} for o in {r["who"] for r in rows}}
        small = [o for o in homes if o not in (None, 1000) and len(homes[o]) > 1]
        assert not small and (len(homes[1000]) > 1) == (pairs == 500) and (len(placed) > 1) == (pairs == 500)


def test_dealt_rows_of_empty_sides(spark, sides):
    large, lookup = sides
    for a, b in ((large.where("false"), lookup), (large, lookup.where("false")), (large.where("k = 41"), lookup.where("k = 42"))):
        found = dealt_join(a, b, ["k", "b"], "who")
        assert found.count() == 0 and found.columns == [*large.columns, "who", "low"]


def test_rows_with_maps_are_dealt(spark):
    large = spark.range(60).select((F.col("id") % 3).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    lookup = spark.createDataFrame([(0, "p"), (1, "p"), (1, "q")], "k BIGINT, who STRING")
    found = dealt_join(large, lookup, ["k"], "who", block=4, pairs=10)
    assert sorted((r["who"], r["m"]["a"]) for r in found.collect()) == sorted(
        [("p", i) for i in range(60) if i % 3 < 2] + [("q", i) for i in range(60) if i % 3 == 1]
    )


def test_rows_of_a_block_are_in_order(spark):
    # so that equal values lie together in the files
    large = spark.range(500, numPartitions=3).select(
        F.lit(1).alias("k"), (F.col("id") * 7919 % 500 / 50).cast("int").alias("x"), (F.col("id") * 7919 % 500).alias("v")
    )
    found = dealt_join(large, spark.createDataFrame([(1, 5)], "k INT, who BIGINT"), ["k"], "who").collect()
    assert [(r["x"], r["v"]) for r in found] == [(i // 50, i) for i in range(500)]


def test_running_total_over_partitions(spark):
    rows = spark.range(1000, numPartitions=7).select(F.col("id").alias("n"), (F.col("id") % 5).alias("w"))
    found = running_total(rows, ["n"], "w", "before").collect()
    assert all(r["before"] == sum(i % 5 for i in range(r["n"])) for r in found) and len(found) == 1000


def test_dealt_areas_and_ranges(spark, cells):  # noqa: F811
    corner = {k: (k % 6 + 0.25, k % 4 + 0.25, 1.5) for k in RANGES} | {5: (0.25, 0.25, 7.5)}
    edges = gs.area_edges(gs.areas_from_features(spark, [(k, polygon(square(x, y, s, s))) for k, (x, y, s) in corner.items()]))
    micros = F.timestamp_diff("MICROSECOND", days(F.lit(0)), F.col("time"))

    def inside(k, x, y):
        x0, y0, side = corner[k]
        return x0 <= x < x0 + side and y0 <= y < y0 + side

    for limit in (1_000_000, 0):
        clipped = gs.clip_many(cells, edges, 1.0, False, ranges=(ranges(spark, "area_id"), micros), limit=limit, dealt=True)
        assert sorted((r["area_id"], r["v"]) for r in clipped.collect()) == expected(cells, inside)
        assert clipped.columns == ["area_id", *cells.columns]
    bounds = ranges(spark, "request_id").select(
        "request_id", *[days((F.col(c) / DAY).cast("int")).alias(n) for c, n in (("since", "start_date"), ("until", "end_date"))]
    )
    for time in ("time", None):
        assert plain(by_time(cells, time, bounds, dealt=True)) == plain(by_time(cells, time, bounds))


class Shuffled(threading.Thread):
    """Bytes of the shuffle files that were seen on disk, by name, also of those that are gone by the end."""

    def __init__(self, spark):
        super().__init__(daemon=True)
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        self.dirs, self.over, self.seen = [d.getPath() for d in manager.localDirs()], threading.Event(), {}
        self.look()
        self.before = set(self.seen)

    def look(self):
        for path in (p for d in self.dirs for p in glob.iglob(f"{d}/*/shuffle_*.data")):
            with contextlib.suppress(OSError):
                self.seen[path] = os.path.getsize(path)

    def run(self):
        while not self.over.wait(0.1):
            self.look()

    def end(self):
        self.over.set()
        self.join()
        self.look()
        return sum(size for path, size in self.seen.items() if path not in self.before)


def test_rows_of_many_requests_are_not_shuffled(spark, tmp_path):
    # 300 requests, all for a whole grid and a whole table of numbers that do not compress
    lattice(spark, 40, 40).select("x", "y", F.lit("2000-01-01").cast("timestamp_ntz").alias("time"), F.rand(3).alias("v")).distinct(
    ).write.parquet(f"{tmp_path}/grid.nc")
    spark.read.parquet(f"{tmp_path}/grid.nc").select("time", "v").createOrReplaceTempView("dealt_numbers")
    n = spark.table("dealt_numbers").count()
    catalog = spark.createDataFrame([
        (1, "daily", "air temp", "local", f"{tmp_path}/grid.nc", ["v"], None, ["time"], ["x", "y"], 4326, 1.0, 1.0, None),
        (2, "numbers", "number", "internal", "dealt_numbers", ["v"], None, ["time"], [], None, None, None, None),
    ], CATALOG)
    area = polygon(square(-1, -1, 100, 100))
    documents = [(k, json.dumps(request([1, 2], reference_area=area, cell_touches=k % 2 == 0))) for k in range(300)]
    seen = Shuffled(spark)
    seen.start()
    status = extract_many(spark, spark.createDataFrame(documents, "request_id BIGINT, doc STRING"), catalog, f"{tmp_path}/out")
    moved = seen.end()
    assert {(r["status"], r["n_rows"]) for r in status.collect()} == {("ok", n)}
    for name in ("air_temp_1", "number_2"):
        written = read_extract(spark, f"{tmp_path}/out", name)
        assert written.count() == 300 * n
        assert written.agg(F.round(F.sum("v"), 3)).first() == spark.table("dealt_numbers").agg(F.round(F.sum("v") * 300, 3)).first()
    # a number of each row of the result would be 8 bytes
    assert moved < 600 * n * 8 / 4, moved
