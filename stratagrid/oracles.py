"""Independent DuckDB SQL for the registered queries, on the same parquet tables."""

from __future__ import annotations

# ---------------------------------------------------------------- derived tables

DEM = """dem as materialized (
  select o_orderkey as cell, o_orderkey % 100 as col, o_orderkey // 100 as row,
         cast(floor(o_totalprice / 1000) as bigint) as z, o_custkey // 10 as fac from orders)"""
SIZE = "size as (select max(o_orderkey) // 100 as last_row from orders)"
ZONES = """zones as materialized (
  select *, ((row // 25) * 4 + col // 25) * 10 + z // 100 as zone from dem)"""
STRUCTURES = """structures as materialized (
  select id, id as main_file_id, cell % 100 as col, cell // 100 as row,
         cell % 100 + 0.5::double as x, -(cell // 100 + 0.5::double) as y
  from (select c_custkey as id, c_custkey * 10 + (c_custkey * 7) % 10 as cell from customer))"""
ROADS = """roads as (
  select s_suppkey as road_id, (s_suppkey * 3) // 2 as road_row, (s_suppkey % 5) * 20 as c0,
         (s_suppkey % 5) * 20 + 19 as c1, (s_suppkey // 5) % 2 as hw from supplier)"""
TILES = """tiles as (
  select tr, tc, tr || '_' || tc as tilename,
         'public/lidar/dem' || tr || '_' || tc || case when summit >= 499 then '.tif' else '.IMG' end as ascii_path
  from (select row // 25 as tr, col // 25 as tc, max(z) as summit from dem group by all)
  where summit >= 498)"""
LEDGER = """ledger as (
  select event_id as fid, user_id as main_file_id, cast(extract(day from ts) as bigint) as processed,
         case event_type when 'error' then 'Invalid' when 'signup' then 'Out of Bounds'
              else 'store/' || event_type end as ftp,
         'dem' || (user_id // 4) || '_' || (user_id % 4) || '.tif' as file_name
  from events)"""
OFFSETS = """steps(code, dc, dr) as (values (1,1,0),(2,1,1),(4,0,1),(8,-1,1),(16,-1,0),(32,-1,-1),(64,0,-1),(128,1,-1))"""

# a strip is the set of points within hw of a horizontal line from c0 to c1
ON_STRIP = """abs({row} - road_row) <= hw and
  (greatest(c0 - {col}, {col} - c1, 0)) * (greatest(c0 - {col}, {col} - c1, 0))
  + ({row} - road_row) * ({row} - road_row) <= hw * hw"""
JOIN_COUNT = f"""counted as materialized (
  select id, count(road_id) as join_count
  from structures s left join roads on {ON_STRIP.format(row='s.row', col='s.col')} group by id)"""
IN_TILE = "s.col >= tc * 25 and s.col < tc * 25 + 26 and s.row >= tr * 25 and s.row < tr * 25 + 26"


def disc(name: str, radius: int) -> str:
    return f"""{name} as materialized (
  select s.id, s.x, s.y, s.col as scol, s.row as srow, s.col + dc as col, s.row + dr as row
  from structures s, range(-{radius}, {radius + 1}) a(dc), range(-{radius}, {radius + 1}) b(dr), size
  where dc * dc + dr * dr <= {radius * radius} and s.col + dc between 0 and 99
    and s.row + dr between 0 and last_row)"""


ROAD_CELLS = f"""road_cells as materialized (
  select distinct col, row from dem, roads where {ON_STRIP.format(row='row', col='col')})"""


def erased(name: str, source: str) -> str:
    return f"{name} as materialized (select * from {source} anti join road_cells using (col, row))"


def labels(name: str, source: str, keys: list[str], value: str | None = None, neighbours: int = 4,
           edges: str | None = None) -> str:
    """Two CTEs: edges and least cell id (``part``) per connected set of (keys, col, row)."""
    k = ", ".join(keys)
    a = "".join(f"a.{c}, " for c in keys)
    same = " and ".join([f"b.{c} = a.{c}" for c in keys] + ([f"b.{value} = a.{value}"] if value else [])) or "true"
    codes = "code in (1, 4, 16, 64)" if neighbours == 4 else "true"
    e_on_w = " and ".join([f"e.{c} = w.{c}" for c in keys] + ["e.s = w.cell"])
    k_on_e = " and ".join([f"k.{c} = e.{c}" for c in keys] + ["k.cell = e.t"])
    head = f"{k}, " if keys else ""
    eh = "".join(f"e.{c}, " for c in keys)
    edges = edges or f"""select {a}a.row * 100 + a.col as s, b.row * 100 + b.col as t
  from (select a.*, dc, dr from {source} a, steps where {codes}) a
  join {source} b on b.col = a.col + a.dc and b.row = a.row + a.dr and {same}"""
    return f"""{name}_edge as materialized (
  {edges}),
{name}({head}cell, part) using key ({head}cell) as (
  select {head}row * 100 + col, row * 100 + col from {source}
  union
  select {eh}e.t, min(w.part) from {name} w join {name}_edge e on {e_on_w}
  join recurring.{name} k on {k_on_e}
  where w.part < k.part group by {eh}e.t)"""




def build(select: str, *ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n" + select


ORACLES: dict[str, str] = {}


def oracle(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = build(select, *ctes) if ctes else select


# ---------------------------------------------------------------- sources, fields, names

oracle("scan_structures", "select id, x, y from structures", STRUCTURES)
oracle("map_algebra", """select col, row, case when z < 100 then null else z end as high, z < 100 as was_null,
  abs(z - 250) as from_middle, cast(trunc(z / 7.0::double) as bigint) as whole from dem""", DEM)
oracle("scaled_dem", "select col, row, z * 1.5::double as z from dem", DEM)
ZONAL = """select zone, count(*) as n, count(*) * 1.0::double as area, min(z) as lo, max(z) as hi,
  max(z) - min(z) as spread from zones group by zone"""
oracle("fillzone_table", f"""select zone as "GRIDCODE", n as "COUNT", area as "AREA", lo as "MIN_ELE",
  hi as "FILL_ELE", spread as "FILL_DEP" from ({ZONAL})""", DEM, ZONES)
oracle("parse_region_key", "select 'Group_' || id || '_FID_' || (2 * id - 2) as name, id as region_key from structures", STRUCTURES)
oracle("group_labels", "select event_id as fid, 2 * event_id - 2 as part_a, 2 * event_id - 1 as part_b from events")
oracle("tile_manifest", """select tilename, split_part(ascii_path, '/', 3) as file_name,
  'store/' || ascii_path as source_path,
  'shade/' || replace(split_part(ascii_path, '/', 3), '.tif', '_Hillshade.tif') as shade_path,
  'dem' || tilename || '_Hillshade.tif' as check_name
  from tiles where lower(right(ascii_path, 4)) in ('.tif', '.img', '.jpg', '.png')""", DEM, TILES)
oracle("append_lines", """select road_id, c0 + 0.5::double as ax, -(road_row + 0.5::double) as ay,
  c1 + 0.5::double as bx, -(road_row + 0.5::double) as "by", null::bigint as id from roads
  union all select null, x, y, null, null, id from structures""", ROADS, STRUCTURES)

LOW = """low as materialized (
  select cell as pointid, col + 0.5::double as x, -(row + 0.5::double) as y, zone as fzone, z::double as elev
  from zones where z = (select min(z) from zones q where q.zone = zones.zone))"""
POUR = """pour as materialized (
  select cell as pointid, col + 0.5::double as x, -(row + 0.5::double) as y, zone as fzone,
         (select max(z) from zones q where q.zone = zones.zone)::double as fillelev
  from zones where fac = (select max(fac) from zones q where q.zone = zones.zone))"""
oracle("join_one_field", """select low.pointid, low.fzone, coalesce(fillelev, elev) as elev, fillelev is not null as matched
  from low left join pour using (pointid)""", DEM, ZONES, LOW, POUR)
oracle("join_one_field_counts", """select count(*) filter (pointid in (select pointid from pour)) as matches,
  count(*) filter (pointid not in (select pointid from pour)) as no_matches from low""", DEM, ZONES, LOW, POUR)

# ---------------------------------------------------------------- ledger and batches

oracle("valid_ledger_ids", "select fid, ftp from ledger where ftp <> 'Invalid'", LEDGER)
oracle("ledger_next_ids", """select coalesce(max(fid) + 1, 1) as next_fid, coalesce(max(processed), 0) as last_batch
  from ledger""", LEDGER)
oracle("ledger_latest_batch", """select fid, main_file_id, processed, ftp from ledger
  where processed = (select max(processed) from ledger) and ftp <> 'Invalid'""", LEDGER)
oracle("ledger_newest_stored", """select fid, main_file_id, processed, ftp from ledger
  where processed = (select max(processed) from ledger) and ftp <> 'Invalid'""", LEDGER)
oracle("ledger_pending", "select id from structures where id not in (select main_file_id from ledger)", STRUCTURES, LEDGER)
oracle("tiles_pending", """select tilename, split_part(ascii_path, '/', 3) as file_name from tiles
  where split_part(ascii_path, '/', 3) not in (select file_name from ledger)""", DEM, TILES, LEDGER)
oracle("valid_ledger_points", """select id, x, y from structures
  where id in (select main_file_id from ledger where ftp <> 'Invalid')""", STRUCTURES, LEDGER)
YOUNG = """young as (select max(user_id) + 1 as used, max(cast(extract(day from ts) as bigint)) as batch from events)"""


def batch_cte(source: str) -> str:
    return f"""batch as materialized (
  select s.*, n as fid, batch + 1 as processed
  from (select *, row_number() over (order by id) as n from {source}) s, young
  where n > used and n <= used + 500)"""


oracle("next_batch", "select id, main_file_id, fid, processed from batch", STRUCTURES, YOUNG, batch_cte("structures"))
TILE_OF = f"""tile_of as materialized (
  select s.id, min(tilename) as tilename, arg_min(ascii_path, tilename) as ascii_path
  from structures s join tiles on {IN_TILE} group by s.id)"""
oracle("plan_batch", """select fid, coalesce(tilename, 'Out of Bounds') as file_name,
  coalesce('shade/' || replace(split_part(ascii_path, '/', 3), '.tif', '_Hillshade.tif'), 'Out of Bounds') as file_path,
  coalesce('store/' || ascii_path, 'Out of Bounds') as ftp, processed, main_file_id,
  case when tilename is not null then x end as x_location, case when tilename is not null then y end as y_location
  from batch left join tile_of using (id)""", DEM, STRUCTURES, ROADS, TILES, TILE_OF, JOIN_COUNT, YOUNG,
       batch_cte("(select structures.* from structures join counted using (id) where join_count > 0)"))
oracle("ledger_batch_append", """select fid, file_name, null as file_path, ftp, processed, main_file_id,
  null::double as x_location, null::double as y_location from ledger union all
  select fid, coalesce(tilename, 'Out of Bounds'),
  coalesce('shade/' || replace(split_part(ascii_path, '/', 3), '.tif', '_Hillshade.tif'), 'Out of Bounds'),
  coalesce('store/' || ascii_path, 'Out of Bounds'), processed, main_file_id,
  case when tilename is not null then x end, case when tilename is not null then y end
  from batch left join tile_of using (id)""", DEM, STRUCTURES, ROADS, TILES, TILE_OF, JOIN_COUNT, YOUNG, LEDGER,
       batch_cte("(select structures.* from structures join counted using (id) where join_count > 0)"))
oracle("sheet_ids", "select id, x, y from structures", STRUCTURES)
oracle("sheet_written", "select id from structures", STRUCTURES)
oracle("features_written", "select id, x, y from structures", STRUCTURES)
oracle("copied_selection", "select id, join_count from counted where join_count > 0", STRUCTURES, ROADS, JOIN_COUNT)
oracle("polylines_inserted", """select road_id as id, 0::bigint as vertex, c0 + 0.5::double as x,
  -(road_row + 0.5::double) as y from roads
  union all select road_id, 1, c1 + 0.5::double, -(road_row + 0.5::double) from roads""", ROADS)
oracle("raster_saved", "select col, row, z from dem", DEM)
oracle("value_at_saved_point", "select id, z from structures join dem using (col, row)", STRUCTURES, DEM)
oracle("field_of_type", "select id, main_file_id::double as elev from structures", STRUCTURES)
oracle("ledger_append_rows", """select fid, file_name, ftp, processed, main_file_id from ledger union all
  select id + 1, coalesce(tilename, 'Out of Bounds'), coalesce('store/' || ascii_path, 'Out of Bounds'), 32, main_file_id
  from structures left join tile_of using (id)""", DEM, STRUCTURES, TILES, TILE_OF, LEDGER)

# ---------------------------------------------------------------- points and spatial joins

oracle("points_wgs84", """select id, round(degrees(x * 1000 / 6378137.0::double), 6) as lon,
  round(degrees(2 * atan(exp(y * 1000 / 6378137.0::double)) - pi() / 2), 6) as lat from structures""", STRUCTURES)
# inverse transverse mercator, series in the third flattening n
oracle("points_utm", """select id, round(degrees(atan2(sinh(e1), cos(x1))) + 9, 6) as lon,
  round(degrees(chi + (2 * n - 2 * n ** 2 / 3 - 2 * n ** 3) * sin(2 * chi) + (7 * n ** 2 / 3 - 8 * n ** 3 / 5) * sin(4 * chi)
    + 56 * n ** 3 / 15 * sin(6 * chi)), 6) as lat
  from (select *, asin(sin(x1) / cosh(e1)) as chi from (
    select id, n, xi - b1 * sin(2 * xi) * cosh(2 * eta) - b2 * sin(4 * xi) * cosh(4 * eta) - b3 * sin(6 * xi) * cosh(6 * eta) as x1,
           eta - b1 * cos(2 * xi) * sinh(2 * eta) - b2 * cos(4 * xi) * sinh(4 * eta) - b3 * cos(6 * xi) * sinh(6 * eta) as e1
    from (select id, n, n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 as b1, n ** 2 / 48 + n ** 3 / 15 as b2, 17 * n ** 3 / 480 as b3,
                 (y * 1000 + 5300000) / k as xi, (x * 1000 + 450000 - 500000) / k as eta
          from structures, (select n, 0.9996::double * 6378137 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) as k
                            from (select 1 / (2 * 298.257223563::double - 1) as n)))))""", STRUCTURES)
oracle("road_join_count", "select id, join_count from counted", STRUCTURES, ROADS, JOIN_COUNT)
oracle("points_on_road", "select id, x, y, join_count from structures join counted using (id) where join_count > 0",
       STRUCTURES, ROADS, JOIN_COUNT)
oracle("points_off_road", "select id, x, y from structures join counted using (id) where join_count = 0",
       STRUCTURES, ROADS, JOIN_COUNT)
oracle("classify_structures", "select id, x, y, join_count, join_count > 0 as on_road from structures join counted using (id)",
       STRUCTURES, ROADS, JOIN_COUNT)
oracle("structures_on_road", """select id, main_file_id from structures
  where id in (select id from counted where join_count > 0)""", STRUCTURES, ROADS, JOIN_COUNT)
oracle("point_tile", "select id, main_file_id, tilename, ascii_path, x, y from structures join tile_of using (id)",
       DEM, STRUCTURES, TILES, TILE_OF)
oracle("points_in_tiles", f"select id, x, y from structures s where exists (select 1 from tiles where {IN_TILE})",
       DEM, STRUCTURES, TILES)
oracle("points_out_of_bounds", f"""select id, main_file_id, 'Out of Bounds' as file_name, 'Out of Bounds' as file_path,
  'Out of Bounds' as ftp from structures s where not exists (select 1 from tiles where {IN_TILE})""", DEM, STRUCTURES, TILES)

# ---------------------------------------------------------------- buffers and parts

BASE_A = (SIZE, DEM, STRUCTURES, ROADS, OFFSETS, disc("disc_a", 5), ROAD_CELLS, erased("erased_a", "disc_a"))
PARTS_A = BASE_A + (labels("parts_a", "erased_a", ["id"]),)
PARTS_B = (SIZE, DEM, STRUCTURES, ROADS, OFFSETS, disc("disc_b", 4), ROAD_CELLS, erased("erased_b", "disc_b"),
           labels("parts_b", "erased_b", ["id"]))


def ranked(parts: str) -> str:
    """Average rank written as the mean position among equal areas."""
    return f"""(select id, part, area, avg(pos) over (partition by id, area) as part_rank from (
    select id, part, count(*) * 1.0::double as area,
           row_number() over (partition by id order by count(*) desc) as pos
    from {parts} group by id, part))"""


oracle("buffer_cells", "select id, col, row from disc_a", SIZE, STRUCTURES, disc("disc_a", 5))
oracle("buffer_erased", "select id, col, row from erased_a", *BASE_A)
oracle("buffer_parts", "select id, cell % 100 as col, cell // 100 as row, part from parts_a", *PARTS_A)
oracle("part_areas", "select id, part, count(*) * 1.0::double as area from parts_a group by id, part", *PARTS_A)
oracle("part_rank", f"select * from {ranked('parts_a')}", *PARTS_A)
oracle("top2_parts", f"select * from {ranked('parts_a')} where part_rank <= 2", *PARTS_A)
oracle("top1_parts", f"select * from {ranked('parts_b')} where part_rank <= 1", *PARTS_B)
oracle("group_part_ids", f"""select id, max(part) as max_part, min(part) as min_part from {ranked('parts_a')}
  where part_rank <= 2 group by id""", *PARTS_A)
oracle("region_centroids", """select zone, round(avg(col + 0.5::double), 6) as cx, round(avg(-(row + 0.5::double)), 6) as cy
  from zones group by zone""", DEM, ZONES)

# ---------------------------------------------------------------- zonal and map operators

GRADIENT = """gradient as (
  select c.col, c.row,
    sum(case when dc <> 0 then dc * (case when dr = 0 then 2 else 1 end) * coalesce(n.z - c.z, 0) else 0 end) / 8.0::double as p,
    sum(case when dr <> 0 then dr * (case when dc = 0 then 2 else 1 end) * coalesce(n.z - c.z, 0) else 0 end) / 8.0::double as q
  from (select dem.*, dc, dr from dem, steps) c left join dem n on n.col = c.col + c.dc and n.row = c.row + c.dr
  group by c.col, c.row)"""
SHADE = """shade as materialized (
  select col, row, cast(floor(round(greatest(0, 255 * (sqrt(0.5::double) + 0.5::double * (p + q))
    / sqrt(1 + p * p + q * q)), 6)) as bigint) as gridcode from gradient)"""
SHADED = (DEM, OFFSETS, GRADIENT, SHADE)
oracle("hillshade", "select col, row, gridcode from shade", *SHADED)
oracle("zone_sizes", "select zone, count(*) as count from zones group by zone", DEM, ZONES)
oracle("zonal_max", """select col, row, zone, max(z) over (partition by zone) as zmax,
  min(z) over (partition by zone) as zmin from zones""", DEM, ZONES)
oracle("zonal_table", f"select zone, n as count, area, lo as min, hi as max, spread as range from ({ZONAL})", DEM, ZONES)
oracle("pour_cells", """select col, row, zone, fac from zones
  where fac = (select max(fac) from zones q where q.zone = zones.zone)""", DEM, ZONES)
oracle("min_cells", """select col, row, zone, z from zones
  where z = (select min(z) from zones q where q.zone = zones.zone)""", DEM, ZONES)
oracle("pour_points", "select pointid, x, y, fzone, fillelev from pour", DEM, ZONES, POUR)
oracle("min_points_per_zone", "select fzone, count(*) as frequency, count(fzone) as count_fzone from low group by fzone",
       DEM, ZONES, LOW)
oracle("zones_with_duplicates", "select fzone, count(*) as frequency from low group by fzone having count(*) > 1",
       DEM, ZONES, LOW)
oracle("masked_cells", "select id, col, row, z from disc_b join dem using (col, row)", SIZE, DEM, STRUCTURES, disc("disc_b", 4))


def windows(points: str, half: int, zones: str) -> str:
    """Window cells round points (id, col, row, own_zone); ``zones`` is (col, row, zone)."""
    return f"""win as materialized (
  select p.id, p.col as scol, p.row as srow, p.own_zone, d.col, d.row, d.z, q.zone,
         (d.col - p.col) * (d.col - p.col) + (d.row - p.row) * (d.row - p.row) <= {half * half} as circle
  from {points} p, range(-{2 * half}, {2 * half + 1}) a(dc), range(-{2 * half}, {2 * half + 1}) b(dr), dem d
  left join {zones} q on q.col = d.col and q.row = d.row
  where d.col = p.col + dc and d.row = p.row + dr)"""


OWN = """own as (select s.id, s.col, s.row, zone as own_zone from structures s join zones z on z.col = s.col and z.row = s.row)"""
TARGETS = """targets as materialized (
  select id, col, row, z from (
    select *, min(z) over (partition by id) as low from win
    where circle and (zone is null or zone <> own_zone)) where abs(z - low) < 0.001)"""
WINDOWS = (DEM, ZONES, STRUCTURES, OWN, windows("own", 6, "zones"))
oracle("window_cells", "select id, col, row, z from win", *WINDOWS)
oracle("circle_cells", "select id, col, row, z from win where circle", *WINDOWS)
oracle("value_at_point", "select id, own_zone as zone from own", DEM, ZONES, STRUCTURES, OWN)
oracle("outside_zone_cells", """select id, col, row, z, zone from win where circle and (zone is null or zone <> own_zone)""", *WINDOWS)
oracle("target_cells", "select id, col, row, z from targets", *WINDOWS, TARGETS)

# ---------------------------------------------------------------- nearest neighbours

NEAR = """near as materialized (
  select * from (
    select l.pointid as in_id, p.pointid as near_id, l.fzone as in_zone, p.fzone as near_zone,
           sqrt((l.x - p.x) * (l.x - p.x) + (l.y - p.y) * (l.y - p.y)) as d,
           row_number() over (partition by l.pointid order by
             (l.x - p.x) * (l.x - p.x) + (l.y - p.y) * (l.y - p.y), p.pointid) as near_rank
    from low l, pour p) where near_rank <= 5)"""
DIST = """dist as materialized (
  select low.*, d from low left join (
    select in_id, min(d) as d from near where in_zone = near_zone group by in_id) on in_id = pointid)"""
DEDUP = """dedup as materialized (
  select * from dist qualify row_number() over (partition by fzone order by d nulls last, pointid) = 1)"""
NEARS = (DEM, ZONES, LOW, POUR, NEAR)
oracle("near_table", "select in_id, near_id, round(d, 6) as near_dist, near_rank from near", *NEARS)
oracle("near_table_same_zone", """select in_id, near_id, round(d, 6) as near_dist, near_rank from near
  where in_zone = near_zone""", *NEARS)
oracle("min_points_dist", "select pointid, fzone, elev, round(d, 6) as near_dist from dist", *NEARS, DIST)
oracle("min_points_dedup", "select pointid, fzone, elev, round(d, 6) as near_dist from dedup", *NEARS, DIST, DEDUP)

# ---------------------------------------------------------------- dark regions and lines


def cells_of(name: str, radius: int) -> str:
    return f"""{name} as materialized (
  select id, x, y, row * 100 + col as fid, gridcode, col + 0.5::double as cx, -(row + 0.5::double) as cy,
         sqrt((scol - col) * (scol - col) + (srow - row) * (srow - row)) as d, srow, row
  from disc_{radius} join shade using (col, row))"""


SHADED_A = (SIZE, STRUCTURES) + SHADED + (disc("disc_5", 5), cells_of("cells_a", 5))
SHADED_B = (SIZE, STRUCTURES) + SHADED + (disc("disc_4", 4), cells_of("cells_b", 4))


def dark(source: str) -> str:
    return f"""dark as materialized (
  select *, cast(round_even((hi - lo) * 0.5::double + lo, 0) as bigint) as threshold from (
    select *, max(gridcode) over (partition by id) as hi, min(gridcode) over (partition by id) as lo from {source})
  where gridcode <= round_even((hi - lo) * 0.5::double + lo, 0))"""


FOCUS = """focus as materialized (
  select * from (select * from dark qualify row_number() over (partition by id order by gridcode, fid) <= 5)
  qualify row_number() over (partition by id order by d, gridcode, fid) = 1)"""
oracle("dark_cells", "select id, fid, gridcode, threshold from dark", *SHADED_B, dark("cells_b"))
oracle("darkest_regions", """select id, fid, gridcode, dark_rank from (
  select *, row_number() over (partition by id order by gridcode, fid) as dark_rank from cells_a) where dark_rank <= 30""",
       *SHADED_A)
SIDES = """sides as materialized (
  select * from (
    select *, case when row < srow then 0 else 1 end::bigint as side from cells_a where row <> srow
    qualify row_number() over (partition by id, row < srow order by gridcode, fid) <= 30)
  qualify row_number() over (partition by id, side order by d, gridcode, fid) = 1)"""
oracle("side_nearest", "select id, side, fid, gridcode, round(d, 6) as dist from sides", *SHADED_A, SIDES)
oracle("side_lines", """select id, row_number() over (partition by id order by side) - 1 as vertex, cx as x, cy as y
  from sides""", *SHADED_A, SIDES)
oracle("focus_region", "select id, fid, gridcode, round(d, 6) as dist from focus", *SHADED_B, dark("cells_b"), FOCUS)
oracle("focus_region_flag", """select id, fid, gridcode, chosen and row_number() over (
    partition by id, chosen order by d, gridcode, fid) = 1 as diss from (
  select *, row_number() over (partition by id order by gridcode, fid) <= 5 as chosen from dark)""",
       *SHADED_B, dark("cells_b"))


def ends(pieces: str, focus: str) -> str:
    """``pieces`` (id, part, cx, cy); ``focus`` (id, cx, cy)."""
    return f"""ends as materialized (
  select s.id, s.main_file_id, s.x, s.y, f.cx as focus_x, f.cy as focus_y, coalesce(e.cx, s.x) as end_x,
         coalesce(e.cy, s.y) as end_y, e.id is not null as found
  from {focus} f join structures s using (id) left join (
    select p.id, p.cx, p.cy from {pieces} p join {focus} f using (id) join structures s using (id)
    where sqrt((p.cx - s.x) * (p.cx - s.x) + (p.cy - s.y) * (p.cy - s.y))
        < sqrt((p.cx - f.cx) * (p.cx - f.cx) + (p.cy - f.cy) * (p.cy - f.cy))
    qualify row_number() over (partition by p.id order by
      sqrt((p.cx - s.x) * (p.cx - s.x) + (p.cy - s.y) * (p.cy - s.y)), p.part) = 1) e on e.id = s.id)"""


def snapped(carried: str) -> str:
    across = "abs(end_x - focus_x) > abs(end_y - focus_y)"
    return f"""select {carried}, 0::bigint as vertex, round(case when {across} then focus_x else x end, 6) as x,
         round(case when {across} then y else focus_y end, 6) as y from ends
  union all select {carried}, 1, round(x, 6), round(y, 6) from ends
  union all select {carried}, 2, round(case when {across} then end_x else x end, 6),
         round(case when {across} then y else end_y end, 6) from ends"""


CELL_ENDS = (*SHADED_B, dark("cells_b"), FOCUS, ends("(select id, fid as part, cx, cy from dark)", "focus"))
oracle("opposite_end", "select id, focus_x, focus_y, end_x, end_y, found from ends", *CELL_ENDS)
oracle("snapped_lines", snapped("id"), *CELL_ENDS)
oracle("side_ranking", """select id, part, side, round(d, 6) as dist,
  row_number() over (partition by id, side order by d, part) as side_rank
  from (select *, unnest([case when cx < x then 'left' else 'right' end, case when cy < y then 'below' else 'above' end]) as side
    from (select id, part, cx, cy, x, y, sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y)) as d from (
      select id, part, avg(cell % 100 + 0.5::double) as cx, avg(-(cell // 100 + 0.5::double)) as cy from parts_a group by id, part)
      join structures using (id)))""", *PARTS_A)

# ---------------------------------------------------------------- connected regions

oracle("region_group", "select cell % 100 as col, cell // 100 as row, part as region from lab", DEM, OFFSETS,
       "low_cells as materialized (select col, row from dem where z < 200)", labels("lab", "low_cells", [], neighbours=8))
oracle("value_regions", """select col, row, gridcode, part as region from lab join classes using (cell)""", DEM, OFFSETS,
       "classes as materialized (select cell, col, row, z // 100 as gridcode from dem)", labels("lab", "classes", [], value="gridcode"))
oracle("dissolve_parts", "select id, diss, part, count(*) as n_cells from lab group by all", SIZE, DEM, STRUCTURES, OFFSETS,
       disc("disc_b", 4), "lows as materialized (select id, col, row, z < 100 as diss from disc_b join dem using (col, row) where z < 250)",
       labels("lab", "lows", ["id", "diss"]))

# ---------------------------------------------------------------- terrain

EDGE = """edge as materialized (
  select a.cell as s, b.cell as t, a.z as za, b.z as zb, code, dc, dr from (select dem.*, code, dc, dr from dem, steps) a
  join dem b on b.col = a.col + a.dc and b.row = a.row + a.dr)"""
FILL = """lev(cell, lv) using key (cell) as (
  select cell, z from dem, size where col in (0, 99) or row in (0, last_row)
     or not exists (select 1 from dem n where n.cell = dem.cell + 101)
  union
  select e.t, min(greatest(w.lv, e.zb)) from lev w join edge e on e.s = w.cell
  left join recurring.lev k on k.cell = e.t
  where k.lv is null or greatest(w.lv, e.zb) < k.lv group by e.t),
fil as materialized (select cell, col, row, z, lv as fill from dem join lev using (cell))"""
TERRAIN = (SIZE, DEM, OFFSETS, EDGE, FILL)
oracle("fill_dem", "select col, row, fill from fil", *TERRAIN)
oracle("fill_depth", "select col, row, fill - z as depth from fil", *TERRAIN)
oracle("fill_mask", "select col, row from fil where fill <> z", *TERRAIN)
REGIONS = ("raised as materialized (select * from fil where fill <> z)", labels("reg", "raised", [], edges="""select s, t from edge
  where s in (select cell from raised) and t in (select cell from raised)"""))
oracle("fill_zone_count", "select count(distinct part) as zones from reg", *TERRAIN, *REGIONS)
LARGE = """fz as materialized (
  select cell, cell % 100 as col, cell // 100 as row, part as zone from reg
  where part in (select part from reg group by part having count(*) > 3))"""
oracle("large_zones", "select col, row, zone from fz", *TERRAIN, *REGIONS, LARGE)
DIRECTION = """fedge as materialized (
  select s, t, code, dc, dr, a.fill as fa, b.fill as fb from edge join fil a on a.cell = s join fil b on b.cell = t),
known as materialized (
  select cell, col, row, fill, coalesce(
    case when col = 0 then 16 when col = 99 then 1 when row = 0 then 64 when row = last_row then 4
         when not exists (select 1 from dem n where n.col = fil.col and n.row = fil.row + 1) then 4
         when not exists (select 1 from dem n where n.cell = fil.cell + 101) then 2 end,
    (select arg_min(code, (-(fa - fb) * (fa - fb) * (case when dc <> 0 and dr <> 0 then 1 else 2 end), code))
     from fedge where s = fil.cell and fb < fa)) as dir
  from fil, size),
hop(cell, n) using key (cell) as (
  select cell, 0 from known where dir is not null
  union
  select e.t, min(w.n + 1) from hop w join fedge e on e.s = w.cell and e.fa = e.fb
  left join recurring.hop k on k.cell = e.t
  where k.n is null or w.n + 1 < k.n group by e.t),
fdir as materialized (
  select cell, col, row, coalesce(dir, (select min(code) from fedge join hop a on a.cell = s join hop b on b.cell = t
    where s = known.cell and fa = fb and b.n = a.n - 1))::bigint as dir from known)"""
oracle("flow_direction", "select col, row, dir from fdir", *TERRAIN, DIRECTION)
ACCUMULATION = """down as materialized (
  select fdir.cell, d.cell as nxt from fdir join steps on code = dir join fdir d on d.col = fdir.col + dc and d.row = fdir.row + dr),
walk(src, pos) as (
  select cell, nxt from down union all select src, nxt from walk join down on cell = pos),
facc as materialized (select fdir.cell, col, row, count(src) as acc from fdir left join walk on pos = fdir.cell group by all)"""
oracle("flow_accumulation", "select col, row, acc from facc", *TERRAIN, DIRECTION, ACCUMULATION)
SINKS = (
    *TERRAIN, DIRECTION, ACCUMULATION, *REGIONS, LARGE,
    """low as materialized (
  select fz.cell as pointid, fz.col + 0.5::double as x, -(fz.row + 0.5::double) as y, zone as fzone, z::double as elev,
         count(*) over (partition by zone) as mpcount
  from (select fz.*, z, min(z) over (partition by zone) as low from fz join dem using (cell)) fz where z = low)""",
    """pour as materialized (
  select cell as pointid, col + 0.5::double as x, -(row + 0.5::double) as y, zone as fzone
  from (select fz.*, acc, max(acc) over (partition by zone) as top from fz join facc using (cell)) where acc = top)""",
    NEAR, DIST, DEDUP,
)
oracle("sink_points", "select pointid, x, y, fzone, elev, mpcount, round(d, 6) as near_dist from dedup", *SINKS)

# ---------------------------------------------------------------- cost paths
# costs are doubled: (za + zb) * weight, integral

COST = """looks as materialized (
  select id, row * 100 + col as s, (row + dr) * 100 + col + dc as t, code, z,
         case when dc <> 0 and dr <> 0 then 14 else 10 end as f
  from win, steps where z > 0 and col + dc between 0 and 99),
heights as materialized (select id, row * 100 + col as t, z as zt from win where z > 0),
step_cost as materialized (select id, s, t, code, (z + zt) * f as w from looks join heights using (id, t)),
cst(id, cell, k) using key (id, cell) as (
  select id, srow * 100 + scol, 0 from win where col = scol and row = srow and z > 0
  union
  select e.id, e.t, min(c.k + e.w) from cst c join step_cost e on e.id = c.id and e.s = c.cell
  left join recurring.cst o on o.id = e.id and o.cell = e.t
  where o.k is null or c.k + e.w < o.k group by e.id, e.t),
costs as materialized (
  select c.id, c.cell, c.k, coalesce(min(e.code), 0)::bigint as back, arg_min(e.t, e.code) as prev
  from cst c left join (select e.*, n.k as nk from step_cost e join cst n on n.id = e.id and n.cell = e.t) e
    on e.id = c.id and e.s = c.cell and e.nk + e.w = c.k
  group by c.id, c.cell, c.k)"""
PATHS = """path(id, cell, back_step, k) as (
  select id, cell, 0, k from (
    select costs.*, row_number() over (partition by costs.id order by k, cell) as n
    from costs join targets on targets.id = costs.id and targets.row * 100 + targets.col = costs.cell) where n = 1
  union all
  select p.id, n.cell, p.back_step + 1, n.k from path p join costs c on c.id = p.id and c.cell = p.cell
  join costs n on n.id = p.id and n.cell = c.prev),
paths as materialized (
  select id, cell, k, max(back_step) over (partition by id) - back_step as step from path)"""
oracle("cost_distance", "select id, cell % 100 as col, cell // 100 as row, k / 2.0::double as cost, back from costs",
       OFFSETS, *WINDOWS, COST)
oracle("flow_paths", """select id, step::bigint as step, cell % 100 as col, cell // 100 as row, k / 2.0::double as cost
  from paths""", OFFSETS, *WINDOWS, TARGETS, COST, PATHS)
oracle("flow_path_lines", """select id, zone, step::bigint as vertex, cell % 100 + 0.5::double as x,
  -(cell // 100 + 0.5::double) as y from paths join (select pointid, fzone as zone from dedup) on pointid = id""",
       *SINKS, "starts as (select pointid as id, pointid % 100 as col, pointid // 100 as row, fzone as own_zone from dedup)",
       windows("starts", 6, "fz"), TARGETS, COST, PATHS)

# ---------------------------------------------------------------- structure lines

CROSSING = (
    *PARTS_A, JOIN_COUNT, GRADIENT, SHADE,
    f"""two as materialized (select id, max(part) as p0, min(part) as p1 from {ranked('parts_a')}
  where part_rank <= 2 group by id)""",
    """sided as materialized (
  select p.id, side, p.cell % 100 as col, p.cell // 100 as row, gridcode
  from two join counted using (id), range(2) r(side), parts_a p, shade
  where join_count > 0 and p.id = two.id and p.part = (case when side = 0 then p0 else p1 end)
    and shade.col = p.cell % 100 and shade.row = p.cell // 100)""",
    labels("reg", "sided", ["id", "side"], value="gridcode"),
    """regions as materialized (
  select r.id, r.side, part as fid, min(gridcode) as gridcode, avg(s.col + 0.5::double) as cx, avg(-(s.row + 0.5::double)) as cy
  from reg r join sided s on s.id = r.id and s.side = r.side and s.row * 100 + s.col = r.cell group by r.id, r.side, part)""",
    """nearest as materialized (
  select * from (select * from regions qualify row_number() over (partition by id, side order by gridcode, fid) <= 30)
  join structures using (id)
  qualify row_number() over (partition by id, side order by sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y)), gridcode, fid) = 1)""",
)
oracle("road_crossing_lines", """select n.id, main_file_id, p0 = p1 as one_sided, side::bigint as vertex,
  round(cx, 6) as x, round(cy, 6) as y from nearest n join two using (id)""", *CROSSING)
ISOLATED = (
    *PARTS_B, JOIN_COUNT, GRADIENT, SHADE,
    f"""one as materialized (select id, max(part) as part from {ranked('parts_b')} where part_rank <= 1 group by id)""",
    """masked as materialized (
  select p.id, p.cell % 100 as col, p.cell // 100 as row, gridcode from one join counted using (id) join parts_b p using (id, part)
  join shade on shade.col = p.cell % 100 and shade.row = p.cell // 100 where join_count = 0)""",
    labels("reg", "masked", ["id"], value="gridcode"),
    """regions as materialized (
  select r.id, part as fid, min(gridcode) as gridcode, avg(m.col + 0.5::double) as cx, avg(-(m.row + 0.5::double)) as cy
  from reg r join masked m on m.id = r.id and m.row * 100 + m.col = r.cell group by r.id, part)""",
    "measured as (select r.*, sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y)) as d from regions r join structures using (id))",
    dark("measured"), FOCUS,
    """soiled as materialized (
  select r.id, r.cell % 100 as col, r.cell // 100 as row, dark.fid = focus.fid as diss
  from reg r join dark on dark.id = r.id and dark.fid = r.part join focus on focus.id = r.id)""",
    labels("diz", "soiled", ["id", "diss"]),
    """pieces as materialized (
  select id, diss, part, avg(cell % 100 + 0.5::double) as cx, avg(-(cell // 100 + 0.5::double)) as cy from diz group by id, diss, part)""",
    ends("pieces", "(select * from pieces where diss)"),
)
oracle("isolated_lines", snapped("id, main_file_id, found"), *ISOLATED)
