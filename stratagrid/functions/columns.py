"""Column expressions: reprojection, distances, names, ranks, line snapping, hillshade."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Fixed value: radius of the sphere of the web-mercator projection, in metres.
EARTH_RADIUS = 6378137.0
# Flattening of the WGS 84 ellipsoid, scale on the central meridian of a UTM zone.
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
# File extensions of rasters.
RASTER_SUFFIXES = ("tif", "img", "jpg", "png")


def lon_lat(x: Column, y: Column, crs: int) -> tuple[Column, Column]:
    """Coordinates in EPSG:4326; EPSG:4326 passes through.

    EPSG:3857 and the zones of the universal transverse mercator grid on WGS 84 (EPSG:32601 to 32660
    north, 32701 to 32760 south) are unprojected.
    """
    if crs == 4326:
        return x, y
    if 32601 <= crs <= 32660 or 32701 <= crs <= 32760:
        return _from_utm(x, y, crs % 100, south=crs > 32700)
    if crs != 3857:
        raise ValueError(f"no closed form for EPSG:{crs}")
    lat = 2 * F.atan(F.exp(y / EARTH_RADIUS)) - F.lit(3.141592653589793 / 2)
    return F.degrees(x / EARTH_RADIUS), F.degrees(lat)


def _from_utm(x: Column, y: Column, zone: int, south: bool) -> tuple[Column, Column]:
    """Inverse transverse mercator by Krueger's series to the third order, below a millimetre in a zone."""
    n = FLATTENING / (2 - FLATTENING)
    radius = EARTH_RADIUS / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    beta = (n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96, n ** 2 / 48 + n ** 3 / 15, 17 * n ** 3 / 480)
    delta = (2 * n - 2 * n ** 2 / 3 - 2 * n ** 3, 7 * n ** 2 / 3 - 8 * n ** 3 / 5, 56 * n ** 3 / 15)
    xi = (y - F.lit(1e7 if south else 0.0)) / F.lit(UTM_SCALE * radius)
    eta = (x - F.lit(5e5)) / F.lit(UTM_SCALE * radius)
    xi1, eta1 = xi, eta
    for j, b in enumerate(beta, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))) + F.lit(6.0 * zone - 183.0), F.degrees(lat)


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Planar distance in the unit of the coordinates."""
    return F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))


def within_segment(px: Column, py: Column, reach: Column | None = None) -> Column:
    """True where a point lies within ``reach`` (the half-width) of the segment a-b (round ends)."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    hw = F.col("half_width") if reach is None else reach
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    along = (px - ax) * dx + (py - ay) * dy
    across = (px - ax) * dy - (py - ay) * dx
    near_a = (px - ax) * (px - ax) + (py - ay) * (py - ay) <= hw * hw
    near_b = (px - bx) * (px - bx) + (py - by) * (py - by) <= hw * hw
    return (
        F.when(along <= 0, near_a).when(along >= length2, near_b)
        .otherwise(across * across <= hw * hw * length2)
    )


def average_rank(keys: list[str], value: str) -> Column:
    """Rank by descending value inside small groups; equal values share their mean rank."""
    ranked = Window.partitionBy(*keys).orderBy(F.desc(value))
    peers = Window.partitionBy(*keys, value)
    return F.rank().over(ranked) + (F.count(F.lit(1)).over(peers) - 1) / F.lit(2.0)


def snap_to_axis(start_x: Column, start_y: Column, x: Column, y: Column, end_x: Column,
                 end_y: Column) -> Column:
    """Vertices start, structure, end with both ends moved to the structure's row or column."""
    across = F.abs(end_x - start_x) > F.abs(end_y - start_y)
    return F.array(
        F.struct(F.when(across, start_x).otherwise(x).alias("x"),
                 F.when(across, y).otherwise(start_y).alias("y")),
        F.struct(x.alias("x"), y.alias("y")),
        F.struct(F.when(across, end_x).otherwise(x).alias("x"),
                 F.when(across, y).otherwise(end_y).alias("y")),
    )


def part_labels(group: Column) -> tuple[Column, Column]:
    """The two mask numbers of group ``g``: ``2(g - 1)`` and the one after."""
    first = (group - 1) * 2
    return first, first + 1


def region_key(name: Column) -> Column:
    """The number between the first two underscores of a region name."""
    return F.split(name, "_")[1].cast("long")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def hillshade_name(file_name: Column) -> Column:
    return F.replace(file_name, F.lit(".tif"), F.lit("_Hillshade.tif"))


def is_raster_file(file_name: Column) -> Column:
    suffix = F.lower(F.regexp_extract(file_name, r"\.([^.]+)$", 1))
    return suffix.isin(*RASTER_SUFFIXES)


def hillshade(p: Column, q: Column) -> Column:
    """Shade for sun azimuth 315, altitude 45 from the eastward and southward gradients.

    For these angles the trigonometric formula reduces to square roots.
    """
    lit = F.lit(255.0) * (F.sqrt(F.lit(0.5)) + F.lit(0.5) * (p + q))
    return F.greatest(F.lit(0.0), lit / F.sqrt(F.lit(1.0) + p * p + q * q))
