from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import gridsieve as gs
from gridsieve.functions.timestamps import bound, parse_time, utc_wall_clock


def stamps(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )


def times(df):
    return [r["t"] for r in df.collect()]


def test_bounds_are_inclusive_and_nulls_drop(spark):
    data = stamps(spark, "2000-01-01", "2000-01-02", "2000-01-03", None)
    assert gs.time_clip(data, "t", "2000-01-01", "2000-01-02").count() == 2
    assert gs.time_clip(data, "t", None, "2000-01-02").count() == 2
    assert gs.time_clip(data, "t", "2000-01-02", None).count() == 2
    assert gs.time_clip(data, "t").count() == 4
    assert gs.time_clip(data, None, "2000-01-02").count() == 4
    assert gs.time_clip(data, "t", "2000-01-03", "2000-01-01").count() == 0


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2000-01-01T12:00:00+01:00", datetime(2000, 1, 1, 11)),
        ("2000-01-01T12:00:00+01", datetime(2000, 1, 1, 11)),
        ("2000-01-01 12:00:00-0530", datetime(2000, 1, 1, 17, 30)),
        ("2000-01-01T12:00:00Z", datetime(2000, 1, 1, 12)),
        ("2000-01-01T12:00:00", datetime(2000, 1, 1, 12)),
        ("2000-01-01", datetime(2000, 1, 1)),
        # the repeated and the missing hour of a zone with daylight saving
        ("2021-10-31T02:30:00+02:00", datetime(2021, 10, 31, 0, 30)),
        ("2021-10-31T02:30:00+01:00", datetime(2021, 10, 31, 1, 30)),
        ("2021-03-28T02:30:00", datetime(2021, 3, 28, 2, 30)),
        ("soon", None),
    ],
)
def test_offsets_in_any_session_zone(spark, zone, text, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert spark.range(1).select(utc_wall_clock(F.lit(text)).alias("t")).first()["t"] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bounds_of_every_kind(spark):
    aware = datetime(2000, 1, 1, 12, tzinfo=timezone(timedelta(hours=1)))
    row = spark.range(1).select(
        bound(aware).alias("a"), bound(datetime(2000, 1, 1, 11)).alias("b"), bound("2000-01-01T12:00+01").alias("c")
    ).first()
    assert row["a"] == row["b"] == row["c"] == datetime(2000, 1, 1, 11)
    assert bound(None) is None
    with pytest.raises(TypeError):
        bound(5)


def test_bound_folds_to_one_constant_and_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "cells")
    stamps(spark, "2000-01-01", "2000-01-02").write.parquet(path)
    clipped = gs.time_clip(spark.read.parquet(path), "t", "2000-01-01T13:00:00+01:00", None)
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2000-01-01T12:00)" in plan
    assert clipped.count() == 1


def test_columns_with_a_zone_are_compared_in_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        data = spark.sql("SELECT timestamp '2000-01-01 12:00:00' AS t")  # 11:00 UTC
        assert gs.time_clip(data, "t", "2000-01-01T11:00:00Z", "2000-01-01T12:00:00+01:00").count() == 1
        assert gs.time_clip(data, "t", "2000-01-01T11:30:00Z").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_texts(spark):
    texts = ["2000-02-03 04:05:06.5", "20000203", "200002030405", "2/3/2000", "02/03/2000 04:05", "3.2.2000", None]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    found = [r["t"] for r in data.orderBy("i").select("i", parse_time(F.col("t")).alias("t")).orderBy("i").collect()]
    day = datetime(2000, 2, 3)
    assert found == [
        datetime(2000, 2, 3, 4, 5, 6, 500000), day, datetime(2000, 2, 3, 4, 5), day,
        datetime(2000, 2, 3, 4, 5), None, None,
    ]


def test_skipping_files_never_changes_the_clipped_rows(spark):
    data = spark.range(400).select(
        F.floor(F.col("id") / 100).alias("file"),
        (F.lit("2000-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("t"),
    )
    manifest = gs.time_manifest(data, "file", "t")
    # the last day of file 1, the first of file 3: both files stay
    start, end = "2000-07-18", "2000-10-27"
    kept = sorted(r["file"] for r in gs.kept_files(manifest, start, end).collect())
    assert kept == [1, 2, 3]
    for limit in (1_000_000, 0):
        skipped = gs.file_skip(data, manifest, "file", start, end, limit=limit)
        assert skipped.count() == 300
        assert gs.time_clip(skipped, "t", start, end).count() == gs.time_clip(data, "t", start, end).count()
    assert gs.file_skip(data, manifest, "file").count() == 400


def test_file_without_times_is_kept(spark):
    data = spark.sql("SELECT 1 AS file, CAST(NULL AS TIMESTAMP_NTZ) AS t")
    assert gs.kept_files(gs.time_manifest(data, "file", "t"), "2000-01-01", "2001-01-01").count() == 1


def test_sort_puts_nulls_last_and_keeps_ties_in_order(spark):
    data = spark.createDataFrame(
        [("2000-01-02", 1), (None, 2), ("2000-01-01", 3), ("2000-01-02", 4)], "t STRING, i INT"
    ).coalesce(1)
    assert [r["i"] for r in gs.sort_time(data, "t").collect()] == [3, 1, 4, 2]


def test_a_time_held_by_a_third_of_the_rows_is_spread(spark):
    data = spark.range(30_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit("2000-01-01")).otherwise(F.lit("2000-06-01"))
        .cast("timestamp_ntz").alias("t"),
    )
    sizes = gs.sort_time(data, "t").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 10_000 or len(sizes) == 1
