"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import gridsieve as gs
from checks import inputs as inp
from gridsieve.functions import names
from gridsieve.functions.timestamps import parse_time, utc_wall_clock
from gridsieve.operators import areas
from gridsieve.scale import materialise, scratch_dir
from gridsieve.sinks import rawcopy, writers
from gridsieve.sources import coverage
from gridsieve.sources.paths import expand_path

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- requests, catalog


def request_parse(spark: SparkSession, sf: str) -> DataFrame:
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'12:00:00")
    start = F.when(F.col("o_orderstatus") == "O", "").otherwise(
        F.concat(F.lit(', "start_date": "'), day, F.when(F.col("o_orderstatus") == "P", "+01:00").otherwise(""),
                 F.lit('"'))
    )
    end = F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(
        F.concat(F.lit(', "end_date": "'), day, F.lit('+01"'))
    )
    touches = F.when(cust % 2 == 0, ', "cell_touches": false').otherwise("")
    area = F.concat(
        F.lit(', "reference_area": {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", '
              '"coordinates": [[['),
        (cust % 10).cast("string"),
        F.lit(", 47.5], [9, 48], [8, 48.25], ["),
        (cust % 10).cast("string"),
        F.lit(", 47.5]]]}}"),
    )
    document = F.concat(
        F.lit('{"extractor": {"parameters": {"integration": "spatial", "resolution": 30, "dataset_ids": ['),
        F.concat_ws(", ", order.cast("string"), cust.cast("string"), cust.cast("string")),
        F.lit("]"), start, end, touches, area, F.lit("}}}"),
    )
    text = F.when(cust % 5 == 0, F.concat(F.lit("order "), order.cast("string"))).otherwise(document)
    documents = inp.table(spark, sf, "orders").select(order.alias("request_id"), text.alias("doc"))
    parsed = gs.parse_requests(documents, "doc")
    return parsed.select(
        "request_id",
        "valid",
        F.array_join("dataset_ids", ",").alias("dataset_ids"),
        "start_date",
        "end_date",
        "cell_touches",
        F.size(F.get("reference_area.geometry.coordinates", F.lit(0))).cast("int").alias("n_vertices"),
        F.get(F.get(F.get("reference_area.geometry.coordinates", F.lit(0)), F.lit(0)), F.lit(0)).alias("first_x"),
    )


def catalog_lookup(spark: SparkSession, sf: str) -> DataFrame:
    wanted = gs.requested_ids(inp.requests(spark, sf))
    found = gs.lookup(wanted, inp.catalog(spark, sf))
    return found.select("request_id", "position", "dataset_id", "title", "variable_name", "path")


def catalog_missing(spark: SparkSession, sf: str) -> DataFrame:
    return gs.missing(gs.requested_ids(inp.requests(spark, sf)), inp.catalog(spark, sf))


def catalog_first_match(spark: SparkSession, sf: str) -> DataFrame:
    entries = inp.catalog(spark, sf)
    again = entries.withColumn("title", F.concat(F.lit("old "), "title"))
    first = gs.first_match(entries.unionByName(again), "entry_id", ["title", "path"])
    return first.select("entry_id", "title", "path", "n_matches")


GLOBS = (("title", "small*"), ("title", "*ring"), ("variable_name", "LARGE*#1*"), ("title", "*%*"), ("path", "*_*.N*"))


def catalog_glob(spark: SparkSession, sf: str) -> DataFrame:
    entries = inp.catalog(spark, sf)
    return gs.concat_frames(
        [
            gs.search(entries, column, pattern).select(F.lit(pattern).alias("pattern"), "entry_id", "title")
            for column, pattern in GLOBS
        ]
    )


def catalog_find_or_create(spark: SparkSession, sf: str) -> DataFrame:
    part, customer = inp.table(spark, sf, "part"), inp.table(spark, sf, "customer")
    existing = part.groupBy(F.col("p_type").alias("name")).agg(F.min("p_brand").alias("symbol"))
    candidates = gs.concat_frames(
        [
            customer.select(F.col("c_mktsegment").alias("name"), F.lit("segment").alias("symbol")),
            part.select(F.col("p_type").alias("name"), F.lit("type").alias("symbol")),
            part.select(F.col("p_brand").alias("name"), F.col("p_name").alias("symbol")),
        ]
    )
    return gs.find_or_create(existing, candidates, ["name"])


def request_fanout(spark: SparkSession, sf: str) -> DataFrame:
    nations = inp.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("entry_id"), F.col("n_name").alias("title")
    )
    ids = gs.search(nations, "title", "NATION_1*")
    made = gs.fan_out(
        inp.catchments(spark, sf), "collection_text", "catchment", ids, 1995, 2001, "extractor"
    )
    return made.select("catchment", "request")


def source_route(spark: SparkSession, sf: str) -> DataFrame:
    return inp.catalog(spark, sf).select(
        "entry_id", names.source_route(F.col("ds_type"), F.col("path")).alias("route")
    )


# ---------------------------------------------------------------- sources


def sql_source(spark: SparkSession, sf: str) -> DataFrame:
    inp.grid(spark, sf).createOrReplaceTempView("gridsieve_cells")
    return gs.read_table(
        spark, "gridsieve_cells", ["time"], ["v", "w"], ["x", "y"], inp.START, inp.END
    )


def _station_files(spark: SparkSession, sf: str) -> DataFrame:
    return inp.table(spark, sf, "events").select(
        "ts", F.col("user_id").alias("station"), "value", "event_type"
    )


def path_expand(spark: SparkSession, sf: str) -> DataFrame:
    base, events = scratch_dir(spark), _station_files(spark, sf)
    for extension in ("csv", "DAT", "log"):
        writers.write_csv(events, base, "ts", ["event_type"], extension, mode="append")
    found = expand_path(spark, f"{base}/event_type=*/*", names.CSV_SUFFIXES)
    folder = F.regexp_extract("path", r"event_type=([^/]*)/", 1).alias("event_type")
    return found.select(folder, "suffix").distinct()


def _three_file_sets(spark: SparkSession, sf: str) -> str:
    base, events = scratch_dir(spark), _station_files(spark, sf)
    writers.write_csv(events, base, "ts", ["event_type"], mode="append")
    turned = events.select("value", F.lit("x, y").alias("note"), "ts", "station", "event_type")
    writers.write_csv(turned, base, None, ["event_type"], "txt", mode="append")
    writers.write_csv(events.drop("value"), base, "ts", ["event_type"], mode="append")
    return f"{base}/event_type=*/*"


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Three sets of files with other headers; the one without ``value`` is left out."""
    data, _ = gs.scan_csv(spark, _three_file_sets(spark, sf), ["ts", "value", "station"], "ts")
    return data


def csv_status(spark: SparkSession, sf: str) -> DataFrame:
    """What became of the files of each folder."""
    _, files = gs.scan_csv(spark, _three_file_sets(spark, sf), ["ts", "value", "station"], "ts")
    folder = F.regexp_extract("path", r"event_type=([^/]*)/", 1).alias("event_type")
    kind = F.regexp_extract("path", r"\.(\w+)$", 1).alias("kind")
    return files.select(folder, kind, "status", "detail").distinct()


def csv_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Line breaks and quotes inside fields, and codes that only look like numbers."""
    base = scratch_dir(spark)
    events = inp.table(spark, sf, "events").select(
        "ts",
        F.concat("event_type", F.lit('\nsaid "x"')).alias("note"),
        F.concat((F.col("user_id") % 7).cast("string"), F.lit("F")).alias("code"),
        "value",
    )
    writers.write_csv(events, base, "ts")
    data, _ = gs.scan_csv(spark, base, events.columns, "ts")
    return data


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    target, events = scratch_dir(spark), inp.table(spark, sf, "events")
    writers.write_csv(events, target, "ts")
    data, _ = gs.scan_csv(spark, target, events.columns, "ts", types=dict(events.dtypes))
    return data


def grid_unpack(spark: SparkSession, sf: str) -> DataFrame:
    packed = inp.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("time"),
        F.col("l_orderkey").alias("cell"),
        F.col("l_quantity").cast("smallint").alias("pr"),
        F.col("l_linenumber").alias("tas"),
    )
    return gs.unpack(packed, {"pr": (0.5, 10.0, 13.0), "tas": (0.01, 273.15, None)})


def raster_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return gs.pixel_positions(inp.pixels(spark, sf), inp.tiles(spark, sf))


# Fixed value: key format of one-degree elevation tiles.
TILE_KEY = "Copernicus_DSM_10_N%02d_00_E%03d_00"


def tile_keys(spark: SparkSession, sf: str) -> DataFrame:
    lat, lon = F.lit(47) + F.col("c_custkey") % 9, F.lit(5) + F.col("c_nationkey") % 12
    ranges = inp.table(spark, sf, "customer").groupBy("c_mktsegment").agg(
        F.min(lat).cast("int").alias("lat_min"), F.max(lat).cast("int").alias("lat_max"),
        F.min(lon).cast("int").alias("lon_min"), F.max(lon).cast("int").alias("lon_max"),
    )
    present = inp.table(spark, sf, "supplier").select(
        F.format_string(TILE_KEY, F.lit(47) + F.col("s_suppkey") % 9, F.lit(5) + F.col("s_nationkey") % 12)
        .alias("key")
    )
    return coverage.not_present(coverage.expected_tiles(ranges, TILE_KEY), present).select("key")


# Folder, prefix, resolution and version of the yearly grid files,
# and the format of their names.
YEAR_FILES = (
    ("Precipitation", "pr", 1, "v5-0"),
    ("RadiationGlobal", "rsds", 5, "v3-0"),
    ("Humidity", "hurs", 5, "v5-0"),
    ("TemperatureMean", "tas", 5, "v5-0"),
    ("TemperatureMin", "tasmin", 5, "v5-0"),
    ("TemperatureMax", "tasmax", 5, "v5-0"),
)
YEAR_KEY = "%s_hyras_%d_%d_%s_de.nc"


def year_files(spark: SparkSession, sf: str) -> DataFrame:
    values = ", ".join(f"('{f}', '{p}', {r}, '{v}')" for f, p, r, v in YEAR_FILES)
    variables = spark.sql(f"SELECT * FROM VALUES {values} AS t(folder, prefix, resolution, version)")
    folders = F.array(*[F.lit(f) for f, *_ in YEAR_FILES])
    year = F.year("o_orderdate")
    years = inp.table(spark, sf, "orders").groupBy(
        F.get(folders, (F.col("o_custkey") % 6).cast("int")).alias("folder")
    ).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    at = (F.col("s_suppkey") % 6).cast("int")
    held = inp.table(spark, sf, "supplier").select(
        F.get(folders, at).alias("folder"), (F.lit(1995) + F.col("s_nationkey") % 7).cast("int").alias("year")
    )
    expected = coverage.expected_years(variables, years, YEAR_KEY)
    present = expected.join(held.distinct(), ["folder", "year"], "left_semi")
    return coverage.not_present(expected, present).select("folder", "year", "key")


def file_key(spark: SparkSession, sf: str) -> DataFrame:
    key, pick = F.col("p_partkey").cast("string"), F.col("p_partkey") % 5
    path = (
        F.when(pick == 0, F.concat(F.lit("/data/discharge_sim_DE"), key, F.lit(".csv")))
        .when(pick == 1, F.concat(F.lit("/data/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".csv")))
        .when(pick == 2, F.lit("data.csv"))
        .when(pick == 3, F.concat(F.lit("x_"), key, F.lit(".tsv")))
        .otherwise(F.concat(F.lit("/a_b/"), F.col("p_name"), F.lit("_ "), key, F.lit(" .csv")))
    )
    files = inp.table(spark, sf, "part").select(F.col("p_partkey").alias("entry_id"), path.alias("path"))
    return files.select(
        "entry_id",
        names.station_key(F.col("path")).alias("station"),
        names.station_file(F.col("path")).alias("target"),
    )


# ---------------------------------------------------------------- projection, time


def project_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return gs.project(inp.grid(spark, sf), ["time"], ["v"], ["x", "y"])


def time_clip(spark: SparkSession, sf: str) -> DataFrame:
    return gs.time_clip(inp.grid(spark, sf), "time", inp.START, inp.END)


def time_clip_open(spark: SparkSession, sf: str) -> DataFrame:
    cells = gs.project(inp.grid(spark, sf), ["time"], ["v"], ["x", "y"])
    return gs.concat_frames(
        [
            gs.time_clip(cells, "time", start, end).withColumn("range", F.lit(name))
            for name, start, end in (
                ("from", inp.START, None), ("until", None, inp.END), ("all", None, None),
                ("reversed", inp.END, inp.START),
            )
        ]
    )


def time_normalise(spark: SparkSession, sf: str) -> DataFrame:
    pick = F.col("o_custkey") % 6
    ending = (
        F.when(pick == 0, "T12:00:00").when(pick == 1, "T12:00:00+01:00").when(pick == 2, "T12:00:00+01")
        .when(pick == 3, "T12:00:00Z").when(pick == 4, " 12:00:00.250-05:30").otherwise("")
    )
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), ending)
    return inp.table(spark, sf, "orders").select(
        "o_orderkey", text.alias("bound"), utc_wall_clock(text).alias("utc")
    )


def time_parse(spark: SparkSession, sf: str) -> DataFrame:
    pick = F.col("event_id") % 5
    text = (
        F.when(pick == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(pick == 1, F.date_format("ts", "yyyyMMddHHmmss"))
        .when(pick == 2, F.date_format("ts", "M/d/yyyy HH:mm:ss"))
        .when(pick == 3, F.date_format("ts", "yyyyMMdd"))
        .otherwise("no time")
    )
    return inp.table(spark, sf, "events").select("event_id", parse_time(text).alias("time"))


def file_skip(spark: SparkSession, sf: str) -> DataFrame:
    cells = inp.grid(spark, sf)
    manifest = gs.time_manifest(cells, "file_id", "time")
    kept = gs.file_skip(cells, manifest, "file_id", inp.START, inp.END)
    return kept.select("file_id", "time", "x", "y", "v")


# ---------------------------------------------------------------- spatial clips


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return inp.grid(spark, sf).select("x", "y", "time", "v")


def bbox_clip(spark: SparkSession, sf: str) -> DataFrame:
    return gs.bbox_clip(_cells(spark, sf), inp.edges(spark, "A1"), inp.RES)


def clip_touch(spark: SparkSession, sf: str) -> DataFrame:
    return gs.polygon_clip(_cells(spark, sf), inp.edges(spark, "A1"), inp.RES)


def clip_centre(spark: SparkSession, sf: str) -> DataFrame:
    return gs.polygon_clip(_cells(spark, sf), inp.edges(spark, "A1"), inp.RES, touches=False)


def clip_hole(spark: SparkSession, sf: str) -> DataFrame:
    return gs.polygon_clip(_cells(spark, sf), inp.edges(spark, "A2"), inp.RES, touches=False)


def clip_dense(spark: SparkSession, sf: str) -> DataFrame:
    cells = inp.grid(spark, sf).drop("file_id")
    return gs.polygon_clip(cells, inp.edges(spark, "A1", "A4"), inp.RES, dense=True)


def clip_long_dropna(spark: SparkSession, sf: str) -> DataFrame:
    cells = inp.grid(spark, sf).drop("file_id")
    clipped = gs.polygon_clip(cells, inp.edges(spark, "A1"), inp.RES)
    return gs.drop_incomplete(clipped, ["time", "x", "y", "v", "w"])


def clip_parts(spark: SparkSession, sf: str) -> DataFrame:
    """An area of parts that overlap, by both rules: what two parts cover is covered."""
    area = gs.area_edges(gs.areas_from_features(spark, [("parts", inp.parts_feature("A1", "A2", "A4"))]))
    return gs.concat_frames(
        [
            gs.clip_many(_cells(spark, sf), area, inp.RES, touches).withColumn("touches", F.lit(touches))
            for touches in (True, False)
        ]
    )


def clip_many_areas(spark: SparkSession, sf: str) -> DataFrame:
    return gs.clip_many(_cells(spark, sf), inp.nation_edges(spark, sf), inp.RES)


def coord_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Latitude/longitude names are clipped; unknown names pass through unclipped."""
    cells = _cells(spark, sf)
    parts = []
    for pair in (("lon", "lat"), ("easting", "northing")):
        named = cells.withColumnsRenamed({"x": pair[0], "y": pair[1]})
        resolved, status = gs.resolve_coordinates(named)
        if status != "no_crs":
            resolved = gs.polygon_clip(resolved, inp.edges(spark, "A4"), inp.RES, touches=False)
        parts.append(resolved.withColumn("status", F.lit(status)))
    return gs.concat_frames(parts)


def area_reproject(spark: SparkSession, sf: str) -> DataFrame:
    areas = gs.read_features(inp.catchments(spark, sf), "feature_text", "catchment")
    return gs.concat_frames(
        [
            gs.area_edges(areas, epsg).select(
                "area_id", F.lit(epsg).alias("epsg"), *[F.round(c, 3).alias(c) for c in ("x1", "y1", "x2", "y2")]
            )
            for epsg in (3857, 3034)
        ]
    )


def area_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return gs.area_vertices(gs.read_features(inp.catchments(spark, sf), "feature_text", "catchment"))


# ---------------------------------------------------------------- rasters


def _windows(spark: SparkSession, sf: str, edges: DataFrame) -> DataFrame:
    return materialise(gs.crop_windows(inp.tiles(spark, sf), gs.area_boxes(edges)))


def raster_tile_skip(spark: SparkSession, sf: str) -> DataFrame:
    boxes = gs.area_boxes(inp.nation_edges(spark, sf))
    return gs.skip_tiles(inp.tiles(spark, sf), boxes).select("area_id", "tile_id")


def raster_crop_window(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, inp.nation_edges(spark, sf)).select(
        "area_id", "tile_id", "row_off", "col_off", "new_height", "new_width", "new_x0", "new_y0"
    )


def raster_crop(spark: SparkSession, sf: str) -> DataFrame:
    return gs.raster_crop(inp.pixels(spark, sf), _windows(spark, sf, inp.nation_edges(spark, sf)))


def raster_mask(spark: SparkSession, sf: str) -> DataFrame:
    edges = inp.nation_edges(spark, sf)
    return gs.raster_mask(inp.pixels(spark, sf), _windows(spark, sf, edges), edges)


def raster_mask_centre(spark: SparkSession, sf: str) -> DataFrame:
    edges = inp.nation_edges(spark, sf)
    return gs.raster_mask(inp.pixels(spark, sf), _windows(spark, sf, edges), edges, touches=False)


def raster_mosaic(spark: SparkSession, sf: str) -> DataFrame:
    return gs.raster_mosaic(inp.pixels(spark, sf), inp.tiles(spark, sf), 8.0, 51.0, 0.0625)


def tile_extent(spark: SparkSession, sf: str) -> DataFrame:
    return gs.tile_extent(inp.tiles(spark, sf))


def extent_wkt(spark: SparkSession, sf: str) -> DataFrame:
    return gs.extent_wkt(gs.tile_extent(inp.tiles(spark, sf)))


# ---------------------------------------------------------------- combining


def concat_files(spark: SparkSession, sf: str) -> DataFrame:
    prices = inp.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("price")
    )
    return gs.concat_frames([_cells(spark, sf), prices, prices])


def sort_time(spark: SparkSession, sf: str) -> DataFrame:
    return gs.sort_time(_cells(spark, sf), "time")


def part_names(spark: SparkSession, sf: str) -> DataFrame:
    cust = F.col("o_custkey")
    files = inp.table(spark, sf, "orders").select(
        cust.alias("entry_id"),
        F.concat(F.lit("air temp "), (cust % 3).cast("string")).alias("variable_name"),
        F.when(cust % 2 == 0, "grid").otherwise("raster").alias("route"),
        F.concat(F.lit("/data/"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit(".nc")).alias("path"),
        (F.col("o_orderstatus") != "F").alias("kept"),
    )
    return gs.part_names(files)


# ---------------------------------------------------------------- sinks, reports


def sink_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    route = names.source_route(F.col("ds_type"), F.col("path"))
    kind = (
        F.when(route.isin("sql", "csv"), "frame").when(route == "grid", "grid").otherwise("other")
    )
    name = names.output_name(F.col("variable_name"), F.col("entry_id"))
    target = F.when(route == "csv", names.station_file(F.col("path"))).otherwise(name)
    outputs = inp.catalog(spark, sf).select("entry_id", kind.alias("kind"), target.alias("target"))
    form, final = writers.dispatch(F.col("kind"), F.col("target"))
    return outputs.select("entry_id", "kind", form.alias("format"), final.alias("final_target"))


def output_name(spark: SparkSession, sf: str) -> DataFrame:
    return inp.catalog(spark, sf).select(
        "entry_id", names.output_name(F.col("variable_name"), F.col("entry_id")).alias("name")
    )


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_dir(spark)
    cells = inp.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("entry_id"),
        F.year("l_shipdate").alias("year"),
        F.col("l_shipdate").alias("time"),
        F.col("l_quantity").alias("v"),
    )
    writers.write_parquet(cells, target, ["entry_id", "year"])
    return spark.read.parquet(target).select(
        F.col("entry_id").cast("int").alias("entry_id"), F.col("year").cast("int").alias("year"), "time", "v"
    )


def grid_write_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """The second write finds its target and leaves it alone."""
    target, cells = scratch_dir(spark), _cells(spark, sf)
    writers.write_cells(cells, target)
    writers.write_cells(cells.withColumn("v", F.col("v") + 1), target)
    return spark.read.parquet(target)


def metadata_json(spark: SparkSession, sf: str) -> DataFrame:
    created = F.lit("2020-01-31 06:30:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("p_size"))
    extra = inp.table(spark, sf, "part").select(
        F.col("p_partkey").alias("entry_id"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("support"),
        created.alias("created"),
        F.when(F.col("p_size") > 25, F.col("p_brand")).alias("license"),
    )
    return writers.metadata_json(inp.catalog(spark, sf).join(extra, "entry_id"))


def raw_copy_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Copies have the length and digest of their source in every folder."""
    base, copies = scratch_dir(spark), scratch_dir(spark)
    writers.write_csv(_station_files(spark, sf), base, "ts", ["event_type"])
    folder = F.regexp_extract("path", r"event_type=([^/]*)/", 1)
    files = expand_path(spark, f"{base}/event_type=*/*").withColumn(
        "inner", F.concat_ws("/", F.lit("raw"), folder, "name")
    )
    copied = rawcopy.raw_copy(files, copies, "inner")
    # the copy runs once, before its target is listed
    manifest = copied.withColumn("inner", F.expr(f"substring(target, {len(copies) + 2})")).checkpoint()
    again = (
        spark.read.format("binaryFile").load(f"{copies}/raw/*/*")
        .select(
            F.concat(F.lit("raw"), F.substring_index("path", "/raw", -1)).alias("inner"),
            F.col("length").alias("copy_length"),
            F.sha2("content", 256).alias("copy_sha256"),
        )
    )
    same = (F.col("length") == F.col("copy_length")) & (F.col("sha256") == F.col("copy_sha256"))
    return (
        manifest.join(again, "inner", "left_outer")
        .groupBy(F.split_part("inner", F.lit("/"), F.lit(2)).alias("event_type"))
        .agg(F.bool_and(F.coalesce(same, F.lit(False))).alias("identical"))
    )


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    wanted = gs.requested_ids(inp.requests(spark, sf))
    items = inp.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("entry_id"), F.col("l_shipdate").alias("time")
    )
    stats = gs.time_manifest(gs.time_clip(items, "time", inp.START, inp.END), "entry_id", "time")
    return gs.run_report(wanted, inp.catalog(spark, sf), stats)


def run_report_totals(spark: SparkSession, sf: str) -> DataFrame:
    return gs.totals(run_report(spark, sf))


# ---------------------------------------------------------------- areas of parts, bands, bad requests


def request_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Requests with unreadable bounds and areas of other kinds are kept and marked."""
    documents = inp.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(
            F.lit('{"t": {"parameters": {"dataset_ids": [1], "reference_area": '),
            inp.odd_feature(F.col("o_custkey") % 5),
            F.when(F.col("o_custkey") % 3 == 0, ', "start_date": "2000-13-45"').otherwise(', "start_date": "2000-12-31"'),
            F.when(F.col("o_custkey") % 7 == 0, ', "end_date": "soon"').otherwise(""),
            F.lit("}}}"),
        ).alias("doc"),
    )
    return gs.parse_requests(documents, "doc").select("request_id", "valid")


def request_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Touch flags in several spellings; those that cannot be read make a request invalid."""
    order = F.col("o_orderkey")
    flag = F.element_at(F.array(*[F.lit(f) for f in ("true", "false", '"no"', "1", '"maybe"', "2", "null")]), (order % 7 + 1).cast("int"))
    documents = inp.table(spark, sf, "orders").select(
        order.alias("request_id"),
        F.concat(F.lit('{"t": {"parameters": {"dataset_ids": [1], "cell_touches": '), flag, F.lit("}}}")).alias("doc"),
    )
    return gs.parse_requests(documents, "doc").select("request_id", "valid", "cell_touches")


def _extracted(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Status and folder of one run for all requests, on a grid and a table."""
    folder = scratch_dir(spark)
    writers.write_parquet(_cells(spark, sf), f"{folder}/daily.nc")
    inp.table(spark, sf, "events").select("ts", "value", "user_id").createOrReplaceTempView("extracted_events")
    rows = [
        (1, "daily", "air temp", "local", f"{folder}/daily.nc", ["v"], None, ["time"], ["x", "y"], 4326, inp.RES, inp.RES, None),
        (2, "events", "value", "internal", "extracted_events", ["value"], None, ["ts"], ["user_id"], None, None, None, None),
    ]
    status = gs.extract_many(spark, inp.many_requests(spark, sf), spark.createDataFrame(rows, gs.CATALOG), f"{folder}/out")
    return status, f"{folder}/out"


def extract_many(spark: SparkSession, sf: str) -> DataFrame:
    """The cells of all requests, out of one read of the grid."""
    _, target = _extracted(spark, sf)
    return gs.read_extract(spark, target, "air_temp_1").select(
        F.col("request_id").cast("long").alias("request_id"), "x", "y", "time", "v"
    )


def extract_many_status(spark: SparkSession, sf: str) -> DataFrame:
    status, _ = _extracted(spark, sf)
    return status.select("request_id", "position", "entry_id", "route", "status", "n_rows", "t_min", "t_max")


def extract_parts(spark: SparkSession, sf: str) -> DataFrame:
    """A grid of one file per year: parts of the files that meet the request, in one write."""
    folder = scratch_dir(spark)
    years = inp.grid(spark, sf).select("x", "y", "time", "v", F.concat("file_id", F.lit(".nc")).alias("file"))
    writers.write_parquet(years, f"{folder}/in", ["file"])
    row = (1, "daily", "air temp", "local", f"{folder}/in/file=*.nc", ["v"], {"zones": f"{folder}/in.zones"},
           ["time"], ["x", "y"], 4326, inp.RES, inp.RES, None)
    document = {"extractor": {"parameters": {
        "dataset_ids": [1], "reference_area": inp.feature("A1"), "start_date": inp.START, "end_date": inp.END,
    }}}
    status = gs.extract(spark, document, spark.createDataFrame([row], gs.CATALOG), f"{folder}/out").first()
    return spark.read.parquet(status["target"]).groupBy("target").agg(
        F.lit(status["status"]).alias("status"), F.lit(status["n_rows"]).cast("long").alias("all_rows"),
        F.count("*").alias("n_rows"), F.min("time").alias("t_min"), F.max("time").alias("t_max"), F.sum("v").alias("sum_v"),
    )


def area_status(spark: SparkSession, sf: str) -> DataFrame:
    texts = inp.table(spark, sf, "customer").select("c_custkey", inp.odd_feature(F.col("c_custkey") % 5).alias("text"))
    return areas.area_status(gs.read_features(texts, "text", "c_custkey"))


def area_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Edges and boxes of areas of one and of two parts; other geometries have none."""
    texts = inp.table(spark, sf, "customer").select("c_custkey", inp.odd_feature(F.col("c_custkey") % 5).alias("text"))
    edges = gs.area_edges(gs.read_features(texts, "text", "c_custkey"))
    counted = edges.groupBy("area_id").agg(F.count("*").alias("n_edges"))
    return counted.join(gs.area_boxes(edges), "area_id")


def request_fanout_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse ids far apart still make one request per catchment."""
    ids = inp.table(spark, sf, "nation").select((F.col("n_nationkey").cast("long") * 7919).alias("entry_id"))
    made = gs.fan_out(inp.catchments(spark, sf), "collection_text", "catchment", ids, 1995, 2001, "extractor")
    parsed = gs.parse_requests(made.select("catchment", "request"), "request")
    total = F.aggregate("dataset_ids", F.lit(0).cast("long"), lambda a, b: a + b)
    return parsed.select("catchment", F.size("dataset_ids").cast("long").alias("n_ids"), total.alias("sum_ids"))


def catalog_create_records(spark: SparkSession, sf: str) -> DataFrame:
    """Created records are whole candidates, not mixtures of several."""
    part = inp.table(spark, sf, "part")
    record = ["p_name AS title", "p_size AS size", "p_retailprice AS price"]
    existing = part.where("p_size % 5 = 0").groupBy(F.col("p_type").alias("name")).agg(
        F.min("p_name").alias("title"), F.min("p_size").alias("size"), F.min("p_retailprice").alias("price")
    )
    candidates = part.selectExpr("p_type AS name", *record).unionByName(part.selectExpr("p_brand AS name", *record))
    return gs.find_or_create(existing, candidates, ["name"])


def _two_bands(spark: SparkSession, sf: str) -> DataFrame:
    one = inp.pixels(spark, sf)
    doubled = F.when(F.col("value") == -9999.0, F.col("value")).otherwise(F.col("value") * 2)
    return one.withColumn("band", F.lit(1)).unionByName(
        one.withColumn("value", doubled).withColumn("band", F.lit(2))
    )


def raster_mosaic_bands(spark: SparkSession, sf: str) -> DataFrame:
    return gs.raster_mosaic(_two_bands(spark, sf), inp.tiles(spark, sf), 8.0, 51.0, 0.0625)


def raster_crop_bands(spark: SparkSession, sf: str) -> DataFrame:
    return gs.raster_crop(_two_bands(spark, sf), _windows(spark, sf, inp.nation_edges(spark, sf)))


def raster_mask_bands(spark: SparkSession, sf: str) -> DataFrame:
    edges = inp.nation_edges(spark, sf)
    return gs.raster_mask(_two_bands(spark, sf), _windows(spark, sf, edges), edges)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        request_parse, catalog_lookup, catalog_missing, catalog_first_match, catalog_glob,
        catalog_find_or_create, request_fanout, source_route, sql_source, path_expand, csv_scan,
        csv_status, csv_breaks,
        grid_unpack, raster_pixels, tile_keys, year_files, file_key, project_catalog, time_clip,
        time_clip_open, time_normalise, time_parse, file_skip, bbox_clip, clip_touch, clip_centre,
        clip_hole, clip_dense, clip_long_dropna, clip_many_areas, coord_resolve, area_reproject,
        raster_mask, raster_mask_centre, raster_crop, raster_crop_window, raster_tile_skip,
        concat_files, sort_time, part_names, raster_mosaic, tile_extent, extent_wkt, sink_dispatch,
        output_name, csv_roundtrip, parquet_roundtrip, grid_write_ignore, metadata_json,
        raw_copy_manifest, area_vertices, run_report, run_report_totals, request_valid, area_status,
        area_parts, request_fanout_ids, catalog_create_records, raster_mosaic_bands, raster_crop_bands,
        raster_mask_bands, clip_parts, request_flags, extract_many, extract_many_status, extract_parts,
    )
}
