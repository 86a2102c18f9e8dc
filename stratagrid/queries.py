"""The registered queries: every operator on whole tables derived from the given parquet files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagrid.functions import columns as fn
from stratagrid.operators import cost, fields, ledger as led, lines, nearest, raster, vector, windows
from stratagrid.operators import joins
from stratagrid.operators.components import components, group_components
from stratagrid.plans import batch, classify, crossing, isolated, sinks
from stratagrid.scratch import materialize, scratch_dir
from stratagrid.ship import ship_package
from stratagrid.sources import fixtures as fx
from stratagrid.sources import tables as tab
from stratagrid.sources.tables import append_lines, table_state

RADIUS_A, RADIUS_B = 5.0, 4.0  # buffers round structures on / off a road
KEEP_A, KEEP_B = 2.0, 1.0  # part ranks kept
DARK_A, DARK_B = 30, 5  # darkest regions considered
FRACTION = 0.5  # value threshold
MORE_THAN = 3  # cells a fill zone must exceed
FLOW_RADIUS = 6.0  # circle of the flow targets; the window is twice as wide
STRAIGHT, DIAGONAL = 10.0, 14.0  # integral step weights, exact in any engine
NEAR_K = 5
BATCH = 500
JOIN_SIZE = 25.0

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_terrains: dict[tuple, sinks.Terrain] = {}


def query(run: Query) -> Query:
    def with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = with_code
    return run


def terrain(spark: SparkSession, sf_dir: str) -> sinks.Terrain:
    """The saved rasters of one input, shared by the queries of a session while its files stay the same."""
    files = table_state(spark, f"{sf_dir}/orders.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, files)
    if key not in _terrains:
        _terrains[key] = sinks.Terrain(fx.dem(spark, sf_dir), fx.grid_of(spark, sf_dir))
    return _terrains[key]


def forget_terrains() -> None:
    """Make the next query compute its rasters anew (for benchmarks)."""
    _terrains.clear()


def six(name: str, alias: str | None = None):
    return F.round(name, 6).alias(alias or name)


# ---------------------------------------------------------------- sources, fields, names

@query
def scan_structures(spark, sf):
    return fx.structures(spark, sf).select("id", "x", "y")


@query
def map_algebra(spark, sf):
    z = F.col("z")
    return fx.dem(spark, sf).select(
        "col", "row",
        raster.set_null(z, z < 100).alias("high"),
        raster.set_null(z, z < 100).isNull().alias("was_null"),
        F.abs(z - 250).alias("from_middle"),
        (z / 7.0).cast("int").cast("long").alias("whole"),
    )


@query
def scaled_dem(spark, sf):
    return fx.dem(spark, sf).select("col", "row", (F.col("z") * 1.5).alias("z"))


@query
def fillzone_table(spark, sf):
    table = raster.zonal_table(fx.zones(spark, sf), "z", fx.grid_of(spark, sf))
    return fields.map_fields(
        table, "zone GRIDCODE;count COUNT;area AREA;min MIN_ELE;max FILL_ELE;range FILL_DEP"
    )


@query
def parse_region_key(spark, sf):
    first, _ = fn.part_labels(F.col("id"))
    named = fx.structures(spark, sf).select(
        F.concat(F.lit("Group_"), "id", F.lit("_FID_"), first).alias("name")
    )
    return named.select("name", fn.region_key(F.col("name")).alias("region_key"))


@query
def group_labels(spark, sf):
    part_a, part_b = fn.part_labels(F.col("fid"))
    return fx.ledger(spark, sf).select("fid", part_a.alias("part_a"), part_b.alias("part_b"))


@query
def tile_manifest(spark, sf):
    name = fn.base_name(F.col("ascii_path"))
    return fx.tiles(spark, sf).select(
        "tilename", name.alias("file_name"),
        F.concat(F.lit("store/"), "ascii_path").alias("source_path"),
        F.concat(F.lit("shade/"), fn.hillshade_name(name)).alias("shade_path"),
        F.concat(F.lit("dem"), "tilename", F.lit("_Hillshade.tif")).alias("check_name"),
    ).filter(fn.is_raster_file(F.col("file_name")))


@query
def append_lines_query(spark, sf):
    roads = fx.roads(spark, sf).select("road_id", "ax", "ay", "bx", "by")
    ties = fx.structures(spark, sf).select("id", F.col("x").alias("ax"), F.col("y").alias("ay"))
    return append_lines(roads, ties)


QUERIES["append_lines"] = QUERIES.pop("append_lines_query")


def zone_points(spark, sf):
    """Pour and minimum points of the derived zones; the second raster is the accumulation."""
    grid = fx.grid_of(spark, sf)
    inflow = fx.inflow(spark, sf).withColumnRenamed("fac", "acc")
    return sinks.pour_and_min_points(fx.zones(spark, sf), inflow, grid)


def _joined(spark, sf):
    """Minimum points with the FILLELEV of the pour point whose id equals theirs, else their own."""
    pour, low = zone_points(spark, sf)
    return fields.join_one_field(
        low, "pointid", pour, "pointid", "fillelev", name="elev", salt_by="pointid"
    )


@query
def join_one_field(spark, sf):
    return _joined(spark, sf).select("pointid", "fzone", "elev", "matched")


@query
def join_one_field_counts(spark, sf):
    return fields.match_counts(_joined(spark, sf))


# ---------------------------------------------------------------- ledger and batches

@query
def valid_ledger_ids(spark, sf):
    return led.valid(fx.ledger(spark, sf)).select("fid", "ftp")


@query
def ledger_next_ids(spark, sf):
    return led.next_ids(fx.ledger(spark, sf))


@query
def ledger_latest_batch(spark, sf):
    return led.latest_batch(fx.ledger(spark, sf)).select("fid", "main_file_id", "processed", "ftp")


@query
def ledger_pending(spark, sf):
    return led.pending(
        fx.structures(spark, sf).select("id", "main_file_id"), fx.ledger(spark, sf), "main_file_id"
    ).select("id")


@query
def tiles_pending(spark, sf):
    finished = fx.ledger(spark, sf).select("file_name")
    files = fx.tiles(spark, sf).select(
        "tilename", fn.base_name(F.col("ascii_path")).alias("file_name")
    )
    return led.pending(files, finished, "file_name")


@query
def valid_ledger_points(spark, sf):
    ids = led.valid(fx.ledger(spark, sf)).select(F.col("main_file_id").alias("id")).distinct()
    return fx.structures(spark, sf).join(ids, "id", "left_semi").select("id", "x", "y")


def _young_ledger(spark, sf):
    """A ledger in its first weeks: the points that users 0, 1, 2, ... have had processed."""
    return fx.ledger(spark, sf).groupBy((F.col("main_file_id") + 1).alias("fid")).agg(
        F.max("processed").alias("processed")
    )


@query
def next_batch(spark, sf):
    return led.next_batch(
        fx.structures(spark, sf).select("id", "main_file_id"), _young_ledger(spark, sf), BATCH
    ).select("id", "main_file_id", "fid", "processed")


def _plan(spark, sf):
    return batch.plan_batch(
        classify.on_road(fx.structures(spark, sf), fx.roads(spark, sf), JOIN_SIZE).drop("join_count"),
        _young_ledger(spark, sf), fx.tiles(spark, sf), BATCH, JOIN_SIZE,
    )


@query
def plan_batch(spark, sf):
    return _plan(spark, sf).drop("added")


def _folder(spark, name):
    """A new folder in the shared scratch."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _stored_ledger(spark, sf):
    path = _folder(spark, "ledger")
    old = fx.ledger(spark, sf)
    missing = [f for f in tab.LEDGER_SCHEMA if f.name not in old.columns]
    tab.append_ledger(old.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]), path)
    return path


@query
def ledger_newest_stored(spark, sf):
    """The newest batch of a stored ledger, found from its folders and read alone."""
    newest = led.valid(tab.read_newest(spark, _stored_ledger(spark, sf)))
    return newest.select("fid", "main_file_id", "processed", "ftp")


@query
def ledger_batch_append(spark, sf):
    """Plan a batch, append it to a written ledger, read the ledger back; the time is left out."""
    path = _stored_ledger(spark, sf)
    tab.append_ledger(_plan(spark, sf), path)
    return tab.read_ledger(spark, path).select(
        "fid", "file_name", "file_path", "ftp", "processed", "main_file_id", "x_location", "y_location")


@query
def sheet_ids(spark, sf):
    """Write an interchange sheet with its columns in another order and read it by name."""
    path = _folder(spark, "sheet")
    fx.structures(spark, sf).select(F.col("x").alias("X"), F.col("y").alias("Y"), F.col("id").alias("Id")).write.csv(
        path, header=True)
    return tab.read_sheet(spark, path, ("Id", "X", "Y")).select(
        F.col("Id").alias("id"), F.col("X").alias("x"), F.col("Y").alias("y"))


@query
def sheet_written(spark, sf):
    path = _folder(spark, "sheet")
    tab.write_sheet(fx.structures(spark, sf).select(F.col("id").alias("Id"), F.col("x").alias("X"), F.col("y").alias("Y")),
                    path)
    return tab.read_sheet(spark, path).select(F.col("Id").alias("id"))


@query
def features_written(spark, sf):
    path = _folder(spark, "points")
    tab.write_features(fx.structures(spark, sf).select("id", "x", "y"), path)
    return tab.scan(spark, path, ["id", "x", "y"])


@query
def copied_selection(spark, sf):
    """Points on a road, selected, copied to a table of their own, and read back."""
    path = _folder(spark, "selected")
    tab.write_features(classify.on_road(fx.structures(spark, sf), fx.roads(spark, sf), JOIN_SIZE), path)
    return tab.scan(spark, path, ["id", "join_count"])


@query
def polylines_inserted(spark, sf):
    """Lines of the roads appended to a line table and read back vertex by vertex."""
    path = _folder(spark, "lines")
    ends = F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")),
                   F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))
    tab.append_rows(fx.roads(spark, sf).select(F.col("road_id").alias("id"), ends.alias("line")), path)
    return lines.vertices(spark.read.parquet(path), "id")


@query
def raster_saved(spark, sf):
    """The elevation raster saved by place and read back."""
    path = _folder(spark, "raster")
    tab.save_raster(fx.dem(spark, sf), path, fx.grid_of(spark, sf))
    return tab.read_raster(spark, path).select("col", "row", "z")


@query
def value_at_saved_point(spark, sf):
    """Elevation under each structure, from a raster saved by place."""
    path, grid = _folder(spark, "raster"), fx.grid_of(spark, sf)
    tab.save_raster(fx.dem(spark, sf), path, grid, tile_blocks=1)
    return raster.cell_value_at(
        fx.structures(spark, sf).select("id", "x", "y"), tab.read_raster(spark, path), grid, tile_blocks=1
    ).select("id", "z")


@query
def field_of_type(spark, sf):
    """Fields added with the type that a field of another table has, found without regard to case."""
    points, zones_ = fx.structures(spark, sf), fx.zones(spark, sf)
    kind = fields.field_type(zones_.withColumn("elev", F.col("z").cast("double")), "ELEV")
    return points.select("id", F.col("main_file_id").cast(kind).alias("elev"))


@query
def ledger_append_rows(spark, sf):
    """The ledger after a status row for every structure has been appended."""
    points = fx.structures(spark, sf).withColumn("fid", F.col("id") + 1).withColumn(
        "processed", F.lit(32).cast("long")
    )
    rows = led.status_rows(
        points, joins.locate(points, fx.tiles(spark, sf), JOIN_SIZE), "store", "shade"
    )
    kept = ["fid", "file_name", "ftp", "processed", "main_file_id"]
    return fx.ledger(spark, sf).select(*kept).unionByName(rows.select(*kept))


# ---------------------------------------------------------------- points and spatial joins

@query
def points_wgs84(spark, sf):
    lon, lat = fn.lon_lat(F.col("x") * 1000, F.col("y") * 1000, 3857)
    return fx.structures(spark, sf).select("id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query
def points_utm(spark, sf):
    lon, lat = fn.lon_lat(F.col("x") * 1000 + 450_000, F.col("y") * 1000 + 5_300_000, 32632)
    return fx.structures(spark, sf).select("id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query
def road_join_count(spark, sf):
    points = fx.structures(spark, sf).select("id", "x", "y")
    return joins.join_count(points, fx.roads(spark, sf), JOIN_SIZE).select("id", "join_count")


@query
def points_on_road(spark, sf):
    return classify.on_road(fx.structures(spark, sf), fx.roads(spark, sf), JOIN_SIZE).select(
        "id", "x", "y", "join_count"
    )


@query
def points_off_road(spark, sf):
    return classify.off_road(fx.structures(spark, sf), fx.roads(spark, sf), JOIN_SIZE).select("id", "x", "y")


@query
def classify_structures(spark, sf):
    return classify.classify(fx.structures(spark, sf), fx.roads(spark, sf), JOIN_SIZE).select(
        "id", "x", "y", "join_count", "on_road"
    )


@query
def structures_on_road(spark, sf):
    listed = classify.on_road(fx.structures(spark, sf), fx.roads(spark, sf), JOIN_SIZE).select("id")
    return fx.structures(spark, sf).join(listed, "id", "left_semi").select("id", "main_file_id")


@query
def point_tile(spark, sf):
    return joins.locate(fx.structures(spark, sf), fx.tiles(spark, sf), JOIN_SIZE).select(
        "id", "main_file_id", "tilename", "ascii_path", "x", "y"
    )


@query
def points_in_tiles(spark, sf):
    return joins.in_tiles(fx.structures(spark, sf), fx.tiles(spark, sf), JOIN_SIZE).select("id", "x", "y")


@query
def points_out_of_bounds(spark, sf):
    missing = F.lit("Out of Bounds")
    return joins.out_of_tiles(fx.structures(spark, sf), fx.tiles(spark, sf), JOIN_SIZE).select(
        "id", "main_file_id", missing.alias("file_name"), missing.alias("file_path"), missing.alias("ftp")
    )


# ---------------------------------------------------------------- buffers and parts

def _buffer(spark, sf, radius):
    return vector.buffer_cells(
        fx.structures(spark, sf).select("id", "x", "y"), radius, fx.grid_of(spark, sf)
    ).select("id", "x", "y", "col", "row")


@query
def buffer_cells(spark, sf):
    return _buffer(spark, sf, RADIUS_A).select("id", "col", "row")


@query
def buffer_erased(spark, sf):
    roads = vector.road_cells(fx.roads(spark, sf), fx.grid_of(spark, sf), fx.structures(spark, sf), RADIUS_B)
    return vector.erase(_buffer(spark, sf, RADIUS_A).select("id", "col", "row"), roads)


def _parts(spark, sf, radius=RADIUS_A):
    return crossing.parts_off_road(
        fx.structures(spark, sf), fx.roads(spark, sf), radius, fx.grid_of(spark, sf)
    )


@query
def buffer_parts(spark, sf):
    return _parts(spark, sf)


@query
def part_areas(spark, sf):
    return vector.area(_parts(spark, sf), ["id", "part"], fx.grid_of(spark, sf))


@query
def part_rank(spark, sf):
    return vector.ranked_parts(_parts(spark, sf), fx.grid_of(spark, sf))


@query
def top2_parts(spark, sf):
    return vector.ranked_parts(_parts(spark, sf), fx.grid_of(spark, sf), KEEP_A)


@query
def top1_parts(spark, sf):
    return vector.ranked_parts(_parts(spark, sf, RADIUS_B), fx.grid_of(spark, sf), KEEP_B)


@query
def group_part_ids(spark, sf):
    return vector.end_parts(vector.ranked_parts(_parts(spark, sf), fx.grid_of(spark, sf), KEEP_A))


@query
def region_centroids(spark, sf):
    return vector.centroids(fx.zones(spark, sf), ["zone"], fx.grid_of(spark, sf)).select(
        "zone", six("cx"), six("cy")
    )


# ---------------------------------------------------------------- zonal and map operators

@query
def hillshade(spark, sf):
    return raster.hillshade(fx.dem(spark, sf), fx.grid_of(spark, sf))


@query
def zone_sizes(spark, sf):
    return raster.zone_sizes(fx.zones(spark, sf))


@query
def zonal_max(spark, sf):
    return raster.zonal_statistics(
        fx.zones(spark, sf), zmax=F.max("z"), zmin=F.min("z")
    ).select("col", "row", "zone", "zmax", "zmin")


@query
def zonal_table(spark, sf):
    return raster.zonal_table(fx.zones(spark, sf), "z", fx.grid_of(spark, sf))


@query
def pour_cells(spark, sf):
    zones = fx.zones(spark, sf).join(fx.inflow(spark, sf), ["col", "row"])
    return raster.extreme_cells(zones, "fac", highest=True).select("col", "row", "zone", "fac")


@query
def min_cells(spark, sf):
    return raster.extreme_cells(fx.zones(spark, sf), "z", highest=False).select("col", "row", "zone", "z")


@query
def pour_points(spark, sf):
    return zone_points(spark, sf)[0]


@query
def min_points_per_zone(spark, sf):
    return zone_points(spark, sf)[1].groupBy("fzone").agg(
        F.count(F.lit(1)).alias("frequency"), F.count("fzone").alias("count_fzone")
    )


@query
def zones_with_duplicates(spark, sf):
    return min_points_per_zone(spark, sf).filter("frequency > 1").select("fzone", "frequency")


@query
def masked_cells(spark, sf):
    return vector.extract_by_mask(
        fx.dem(spark, sf), _buffer(spark, sf, RADIUS_B).select("id", "col", "row")
    ).select("id", "col", "row", "z")


def _window_input(spark, sf):
    return fx.structures(spark, sf), fx.dem(spark, sf), fx.zones(spark, sf), FLOW_RADIUS, fx.grid_of(spark, sf)


def _pieces(spark, sf):
    return sinks.flow_windows(*_window_input(spark, sf))


def _windows(spark, sf):
    return windows.window_rows(_pieces(spark, sf))


@query
def window_cells(spark, sf):
    return _windows(spark, sf).select("id", "col", "row", "z")


@query
def circle_cells(spark, sf):
    grid = fx.grid_of(spark, sf)
    return _windows(spark, sf).filter(raster.in_circle(FLOW_RADIUS, grid)).select("id", "col", "row", "z")


@query
def value_at_point(spark, sf):
    return raster.cell_value_at(
        fx.structures(spark, sf).select("id", "x", "y"),
        fx.zones(spark, sf).select("col", "row", "zone"), fx.grid_of(spark, sf),
    ).select("id", "zone")


@query
def outside_zone_cells(spark, sf):
    grid = fx.grid_of(spark, sf)
    return _windows(spark, sf).filter(
        raster.in_circle(FLOW_RADIUS, grid) & ~F.col("zone").eqNullSafe(F.col("own_zone"))
    ).select("id", "col", "row", "z", "zone")


@query
def target_cells(spark, sf):
    return sinks.window_targets(*_window_input(spark, sf)).filter("target").select("id", "col", "row", "z")


# ---------------------------------------------------------------- nearest neighbours

def _near(spark, sf):
    pour, low = map(materialize, zone_points(spark, sf))
    near = nearest.near_table(
        low.select(F.col("pointid").alias("in_id"), "x", "y"),
        pour.select(F.col("pointid").alias("near_id"), F.col("x").alias("nx"), F.col("y").alias("ny")),
        NEAR_K,
    )
    return pour, low, near


def _near_columns(near):
    return near.select("in_id", "near_id", six("near_dist"), F.col("near_rank").cast("long").alias("near_rank"))


@query
def near_table(spark, sf):
    return _near_columns(_near(spark, sf)[2])


@query
def near_table_same_zone(spark, sf):
    pour, low, near = _near(spark, sf)
    return _near_columns(nearest.same_zone(near, low, pour))


def _measured(spark, sf):
    pour, low, near = _near(spark, sf)
    return nearest.with_near_distance(low, nearest.same_zone(near, low, pour))


@query
def min_points_dist(spark, sf):
    return _measured(spark, sf).select("pointid", "fzone", "elev", six("near_dist"))


@query
def min_points_dedup(spark, sf):
    return nearest.first_per_zone(_measured(spark, sf)).select("pointid", "fzone", "elev", six("near_dist"))


# ---------------------------------------------------------------- dark regions and lines

def _shaded(spark, sf, radius):
    """Every shaded buffer cell as a region of its own: ``(id, x, y, fid, gridcode, cx, cy)``."""
    grid = fx.grid_of(spark, sf)
    cells = vector.extract_by_mask(raster.hillshade(fx.dem(spark, sf), grid), _buffer(spark, sf, radius))
    return cells.select(
        "id", "x", "y", "col", "row", "gridcode", grid.cell_id().alias("fid"),
        grid.x().alias("cx"), grid.y().alias("cy"),
    )


@query
def dark_cells(spark, sf):
    return lines.below_threshold(_shaded(spark, sf, RADIUS_B), FRACTION).select(
        "id", "fid", "gridcode", "threshold"
    )


@query
def darkest_regions(spark, sf):
    return lines.darkest(_shaded(spark, sf, RADIUS_A), ["id"], DARK_A).select(
        "id", "fid", "gridcode", F.col("dark_rank").cast("long").alias("dark_rank")
    )


def _sides(spark, sf):
    """The nearest of the darkest cells north (0) and south (1) of each structure."""
    sided = _shaded(spark, sf, RADIUS_A).filter("cy <> y").withColumn(
        "side", F.when(F.col("cy") > F.col("y"), 0).otherwise(1).cast("long")
    )
    return lines.nearest_region(lines.darkest(sided, ["id", "side"], DARK_A), ["id", "side"])


@query
def side_nearest(spark, sf):
    return _sides(spark, sf).select("id", "side", "fid", "gridcode", six("dist"))


@query
def side_lines(spark, sf):
    return lines.vertices(lines.side_lines(_sides(spark, sf), "side"), "id")


def _focus(spark, sf):
    dark = materialize(lines.below_threshold(_shaded(spark, sf, RADIUS_B), FRACTION))
    return dark, lines.nearest_region(lines.darkest(dark, ["id"], DARK_B), ["id"])


@query
def focus_region(spark, sf):
    return _focus(spark, sf)[1].select("id", "fid", "gridcode", six("dist"))


@query
def focus_region_flag(spark, sf):
    dark, focus = _focus(spark, sf)
    return isolated.flag_focus(dark, focus).select("id", "fid", "gridcode", "diss")


def _ends(spark, sf):
    dark, focus = _focus(spark, sf)
    pieces = isolated.flag_focus(dark, focus).withColumnRenamed("fid", "part")
    return lines.opposite_end(pieces.select("id", "part", "diss", "cx", "cy"), fx.structures(spark, sf))


@query
def opposite_end(spark, sf):
    return _ends(spark, sf).select("id", "focus_x", "focus_y", "end_x", "end_y", "found")


@query
def snapped_lines(spark, sf):
    return lines.vertices(_ends(spark, sf).withColumn("line", lines.snapped_line()), "id")


@query
def side_ranking(spark, sf):
    parts = vector.centroids(_parts(spark, sf), ["id", "part"], fx.grid_of(spark, sf))
    return lines.side_ranking(parts.join(fx.structures(spark, sf).select("id", "x", "y"), "id")).select(
        "id", "part", "side", six("dist"), F.col("side_rank").cast("long").alias("side_rank")
    )


# ---------------------------------------------------------------- connected regions

@query
def region_group(spark, sf):
    low = fx.dem(spark, sf).filter("z < 200").select("col", "row")
    return components(low, fx.grid_of(spark, sf)).withColumnRenamed("component", "region")


@query
def value_regions(spark, sf):
    classes = fx.dem(spark, sf).select("col", "row", F.expr("z div 100").alias("gridcode"))
    return raster.value_regions(classes, fx.grid_of(spark, sf), "gridcode").withColumnRenamed(
        "component", "region"
    ).select("col", "row", "gridcode", "region")


@query
def dissolve_parts(spark, sf):
    """Buffer cells of low elevation dissolved per structure; lows below 100 are a class apart."""
    cells = masked_cells(spark, sf).filter("z < 250").select(
        "id", "col", "row", (F.col("z") < 100).alias("diss")
    )
    return group_components(cells, ["id", "diss"], fx.grid_of(spark, sf)).groupBy(
        "id", "diss", F.col("component").alias("part")
    ).agg(F.count(F.lit(1)).alias("n_cells"))


# ---------------------------------------------------------------- terrain

@query
def fill_dem(spark, sf):
    return terrain(spark, sf).filled.select("col", "row", "fill")


@query
def fill_depth(spark, sf):
    t = terrain(spark, sf)
    return raster.combine(
        t.filled.select("col", "row", "fill"), t.dem, "depth", F.col("fill") - F.col("z")
    )


@query
def fill_mask(spark, sf):
    return terrain(spark, sf).filled.filter("z <> fill").select("col", "row")


@query
def fill_zone_count(spark, sf):
    return terrain(spark, sf).fill_regions.agg(F.count_distinct("zone").alias("zones"))


@query
def large_zones(spark, sf):
    return terrain(spark, sf).large_zones(MORE_THAN).select("col", "row", "zone")


@query
def flow_direction(spark, sf):
    return terrain(spark, sf).directions.select("col", "row", "dir")


@query
def flow_accumulation(spark, sf):
    return terrain(spark, sf).accumulation.select("col", "row", "acc")


def _fill_zones(spark, sf):
    return terrain(spark, sf).large_zones(MORE_THAN)


def _sinks(spark, sf):
    t = terrain(spark, sf)
    return sinks.sink_points(_fill_zones(spark, sf), t.accumulation, t.grid, NEAR_K)


@query
def sink_points(spark, sf):
    return _sinks(spark, sf).select(
        "pointid", "x", "y", "fzone", "elev", "mpcount", six("near_dist")
    )


# ---------------------------------------------------------------- cost paths

@query
def cost_distance(spark, sf):
    return cost.cost_distance(_pieces(spark, sf), fx.grid_of(spark, sf), STRAIGHT, DIAGONAL)


@query
def flow_paths(spark, sf):
    return cost.flow_paths(_pieces(spark, sf), fx.grid_of(spark, sf), STRAIGHT, DIAGONAL, radius=FLOW_RADIUS)


@query
def flow_path_lines(spark, sf):
    t = terrain(spark, sf)
    points = _sinks(spark, sf).select(F.col("pointid").alias("id"), "x", "y")
    drawn = sinks.flow_path_lines(
        points, t.dem, _fill_zones(spark, sf), FLOW_RADIUS, t.grid, STRAIGHT, DIAGONAL
    )
    return lines.vertices(drawn, "id", "zone")


# ---------------------------------------------------------------- structure lines

@query
def road_crossing_lines(spark, sf):
    structures, roads = fx.structures(spark, sf), fx.roads(spark, sf)
    drawn = crossing.road_crossing_lines(
        classify.on_road(structures, roads, JOIN_SIZE), roads, terrain(spark, sf).dem,
        fx.grid_of(spark, sf), RADIUS_A, KEEP_A, DARK_A,
    )
    return lines.vertices(drawn, "id", "main_file_id", "one_sided")


@query
def isolated_lines(spark, sf):
    structures, roads = fx.structures(spark, sf), fx.roads(spark, sf)
    drawn = isolated.isolated_lines(
        classify.off_road(structures, roads, JOIN_SIZE), roads, terrain(spark, sf).dem,
        fx.grid_of(spark, sf), RADIUS_B, KEEP_B, DARK_B, FRACTION,
    )
    return lines.vertices(drawn, "id", "main_file_id", "found")
