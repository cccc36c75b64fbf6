"""What the spans save: the centre rule per row, per distinct cell, and by spans.

All three give the same rows; prints seconds for a ring of many vertices over the
grid of the test tables (``BENCH_SF_DIR``).
"""

from __future__ import annotations

import json
import math
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import gridsieve as gs  # noqa: E402
from checks import inputs as inp  # noqa: E402

VERTICES = 100


def star() -> dict:
    def at(i: int) -> list[float]:
        a = 2 * math.pi * i / VERTICES
        r = 1.4 + 0.4 * math.sin(9 * a)
        return [10.3 + r * math.cos(a), 48.8 + r * math.sin(a)]

    ring = [at(i) for i in range(VERTICES)]
    return {
        "type": "Feature",
        "properties": {},
        "geometry": {"type": "Polygon", "coordinates": [[*ring, ring[0]]]},
    }


def per_row(cells: DataFrame, feature: dict) -> DataFrame:
    ring = feature["geometry"]["coordinates"][0]
    pairs = [[*a, *b] for a, b in zip(ring, ring[1:], strict=False)]
    edges = F.from_json(F.lit(json.dumps(pairs)), "ARRAY<ARRAY<DOUBLE>>")
    crossings = F.expr(
        "size(filter(e, s -> (s[1] > y) <> (s[3] > y) "
        "AND x < (s[2] - s[0]) * (y - s[1]) / nullif(s[3] - s[1], 0D) + s[0]))"
    )
    return cells.withColumn("e", edges).where(crossings % 2 == 1).drop("e")


def per_cell(cells: DataFrame, feature: dict) -> DataFrame:
    mask = per_row(cells.select("x", "y").distinct(), feature)
    return cells.join(mask, ["x", "y"], "left_semi")


def by_spans(cells: DataFrame, feature: dict) -> DataFrame:
    edges = gs.area_edges(gs.areas_from_features(cells.sparkSession, [(1, feature)]))
    return gs.polygon_clip(cells, edges, inp.RES, touches=False)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cells = inp.grid(spark, sf_dir).select("x", "y", "time", "v")
    for way in (per_row, per_cell, by_spans):
        times = []
        for _ in range(3):
            started = time.perf_counter()
            rows = tuple(way(cells, star()).agg(F.count("*"), F.sum("v")).first())
            times.append(time.perf_counter() - started)
        print(f"{way.__name__}: {min(times):.2f} s, rows and sum {rows}")


if __name__ == "__main__":
    main()
