"""Points near other points, and regions that contain points.

Every point is hashed to one cell of a latitude/longitude grid; every disc or box is hashed to the cells that it touches. Both
meet in an equi-join on the cell, and the exact test (great-circle distance, box) decides. The cell size follows the radius: a
region uses the level whose cells are about as large as itself, so it touches a handful of cells whatever its size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenfall.runtime import keyed_join

EARTH_KM = 6371.0
KM_PER_DEGREE = math.pi * EARTH_KM / 180
#: Cells of level n are 180 / 2**n degrees high; level 0 is one cell from pole to pole.
FINEST_LEVEL = 24


def usable(lat: Column, lon: Column) -> Column:
    """Null, NaN, out of range and exactly (0, 0) are no points."""
    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180) & ~((lat == 0) & (lon == 0))
    return F.coalesce(ok, F.lit(False))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance on a sphere of EARTH_KM."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def _level(height: Column) -> Column:
    """The finest level whose cells are at least so many degrees high."""
    return F.greatest(F.lit(0), F.least(F.lit(FINEST_LEVEL), F.floor(F.log2(F.lit(180.0) / F.greatest(height, F.lit(1e-9)))).cast("int")))


def _row(lat: Column, level: Column) -> Column:
    return F.least(F.floor((lat + 90) / 180 * F.pow(F.lit(2.0), level)), F.pow(F.lit(2.0), level) - 1).cast("long")


def _columns(row: Column, level: Column) -> Column:
    """How many cells a row has: about square ones where the row is nearest to the equator."""
    high = F.lit(180.0) / F.pow(F.lit(2.0), level)
    south = row * high - 90
    nearest = F.when((south <= 0) & (south + high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(south), F.abs(south + high)))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) * F.cos(F.radians(nearest)) / high)).cast("long")


def _column(lon: Column, count: Column) -> Column:
    return F.least(F.floor((lon + 180) / 360 * count).cast("long"), count - 1)


def with_cells(points: DataFrame, lat: str, lon: str, levels: list[int]) -> DataFrame:
    """One row per point and level, with its cell in _level, _row, _col; rows without a usable point are left out."""
    df = points.where(usable(F.col(lat), F.col(lon)))
    df = df.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels])) if len(levels) != 1 else F.lit(levels[0]))
    df = df.withColumn("_row", _row(F.col(lat), F.col("_level")))
    return df.withColumn("_col", _column(F.col(lon), _columns(F.col("_row"), F.col("_level"))))


def with_cover(boxes: DataFrame) -> DataFrame:
    """One row per cell that a box touches. Boxes have south, west, north, east; west > east crosses the 180th meridian."""
    width = F.when(F.col("west") > F.col("east"), F.col("east") + 360 - F.col("west")).otherwise(F.col("east") - F.col("west"))
    flat = F.cos(F.radians(F.least(F.lit(89.0), F.greatest(F.abs(F.col("south")), F.abs(F.col("north"))))))
    df = boxes.where("south <= north").withColumn("_level", _level(F.greatest(F.col("north") - F.col("south"), width * flat, F.lit(1e-6))))
    df = df.withColumn("_row", F.explode(F.sequence(_row(F.greatest(F.col("south"), F.lit(-90.0)), F.col("_level")), _row(F.least(F.col("north"), F.lit(90.0)), F.col("_level")))))
    n = _columns(F.col("_row"), F.col("_level"))
    wrapped = F.col("west") > F.col("east")
    # a span that crosses the 180th meridian is two spans
    spans = F.when(wrapped, F.array(F.struct(F.col("west").alias("a"), F.lit(180.0).alias("b")), F.struct(F.lit(-180.0).alias("a"), F.col("east").alias("b")))).otherwise(F.array(F.struct(F.col("west").alias("a"), F.col("east").alias("b"))))
    cols = F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(_column(F.greatest(s["a"], F.lit(-180.0)), n), _column(F.least(s["b"], F.lit(180.0)), n)))))
    return df.withColumn("_col", F.explode(cols))


def disc_box(df: DataFrame, lat: str, lon: str, km: Column) -> DataFrame:
    """Adds the box south, west, north, east around the disc of radius km; near a pole the box goes around the earth."""
    slack = 1 + 1e-6
    r = km / F.lit(KM_PER_DEGREE) * slack + 1e-9
    south, north = F.col(lat) - r, F.col(lat) + r
    s = F.sin(F.radians(F.least(r, F.lit(90.0)))) / F.cos(F.radians(F.col(lat)))
    around = (south <= -90) | (north >= 90) | (s >= 1) | (r >= 90)
    dlon = F.degrees(F.asin(F.least(F.lit(1.0), s))) * slack + 1e-9
    west, east = F.col(lon) - dlon, F.col(lon) + dlon
    return (
        df.withColumn("south", F.greatest(south, F.lit(-90.0)))
        .withColumn("north", F.least(north, F.lit(90.0)))
        .withColumn("_w", F.when(around | (dlon >= 180), F.lit(-180.0)).otherwise(F.when(west < -180, west + 360).otherwise(west)))
        .withColumn("_e", F.when(around | (dlon >= 180), F.lit(180.0)).otherwise(F.when(east > 180, east - 360).otherwise(east)))
        .withColumnsRenamed({"_w": "west", "_e": "east"})
    )


def near_points(points: DataFrame, id_: str, lat: str, lon: str, others: DataFrame, other_id: str, other_lat: str, other_lon: str, km: float) -> DataFrame:
    """(id_, near_id): every other point at most km away, limits inclusive.

    Rows without a usable point (see usable) have no rows on either side; repeated input rows give repeated output rows.
    Only the named columns are read, so clashing names of further columns don't matter.
    """
    p = points.select(F.col(id_).alias("_id"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    o = others.select(F.col(other_id).alias("_oid"), F.col(other_lat).cast("double").alias("_olat"), F.col(other_lon).cast("double").alias("_olon"))
    o = o.where(usable(F.col("_olat"), F.col("_olon")))
    level = max(0, min(FINEST_LEVEL, math.floor(math.log2(180 / (2 * km / KM_PER_DEGREE)))))
    boxes = disc_box(o, "_olat", "_olon", F.lit(float(km)))
    cells = with_cover_at(boxes, level).select("_oid", "_olat", "_olon", "_row", "_col")
    joined = keyed_join(with_cells(p, "_lat", "_lon", [level]).drop("_level"), cells, ["_row", "_col"])
    return joined.where(great_circle_km(F.col("_lat"), F.col("_lon"), F.col("_olat"), F.col("_olon")) <= km).select(F.col("_id").alias(id_), F.col("_oid").alias("near_id"))


def with_cover_at(boxes: DataFrame, level: int) -> DataFrame:
    """with_cover at one level for all boxes."""
    df = boxes.withColumn("_level", F.lit(level))
    df = df.withColumn("_row", F.explode(F.sequence(_row(F.col("south"), F.col("_level")), _row(F.col("north"), F.col("_level")))))
    n = _columns(F.col("_row"), F.col("_level"))
    wrapped = F.col("west") > F.col("east")
    one = F.sequence(_column(F.col("west"), n), _column(F.col("east"), n))
    two = F.array_union(F.sequence(_column(F.col("west"), n), n - 1), F.sequence(F.lit(0).cast("long"), _column(F.col("east"), n)))
    return df.withColumn("_col", F.explode(F.when(wrapped, two).otherwise(one)))


def containing_areas(points: DataFrame, id_: str, lat: str, lon: str, areas: DataFrame, area_id: str = "area_id") -> DataFrame:
    """(id_, near_id): every area that contains the point, limits inclusive.

    Areas have lat, lon, radius_km and bbox STRUCT<south, west, north, east>. An area with a bbox is that box (west > east crosses
    the 180th meridian), else the circle around lat/lon (null radius_km means 10 km); with neither, a box with a null side and
    no circle, it contains nothing.
    """
    p = points.select(F.col(id_).alias("_id"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    a = areas.select(F.col(area_id).alias("_aid"), F.col("lat").alias("_alat"), F.col("lon").alias("_alon"), F.coalesce(F.when(~F.isnan("radius_km"), F.col("radius_km")), F.lit(10.0)).alias("_km"), F.col("bbox").alias("_b"))
    sides = [F.col(f"_b.{x}") for x in ("south", "west", "north", "east")]
    whole = F.coalesce(F.col("_b").isNotNull(), F.lit(False))
    for x in sides:
        whole = whole & x.isNotNull() & ~F.isnan(x)
    boxes = a.where(whole).select("_aid", "_alat", "_alon", F.lit(None).cast("double").alias("_km"), *[F.col(f"_b.{x}").alias(x) for x in ("south", "west", "north", "east")])
    discs = disc_box(a.where(F.col("_b").isNull() & usable(F.col("_alat"), F.col("_alon"))), "_alat", "_alon", F.col("_km")).select(*boxes.columns)
    cover = with_cover(boxes.unionByName(discs))
    levels = sorted(r[0] for r in cover.select("_level").distinct().collect())  # at most FINEST_LEVEL + 1
    if not levels:
        levels = [0]
    joined = keyed_join(with_cells(p, "_lat", "_lon", levels), cover, ["_level", "_row", "_col"])
    in_lon = F.when(F.col("west") > F.col("east"), (F.col("_lon") >= F.col("west")) | (F.col("_lon") <= F.col("east"))).otherwise(F.col("_lon").between(F.col("west"), F.col("east")))
    in_box = F.col("_lat").between(F.col("south"), F.col("north")) & in_lon
    in_disc = great_circle_km(F.col("_lat"), F.col("_lon"), F.col("_alat"), F.col("_alon")) <= F.col("_km")
    return joined.where(F.when(F.col("_km").isNull(), in_box).otherwise(in_disc)).select(F.col("_id").alias(id_), F.col("_aid").alias("near_id"))


def near_all(events: DataFrame, areas: DataFrame, seeds: DataFrame, seed_km: float = 0.25) -> DataFrame:
    """(event_id, near_kind, near_id): search areas that contain an event's point, and venue seeds near it."""
    e = events.select("event_id", "location_lat", "location_lon")
    a = containing_areas(e, "event_id", "location_lat", "location_lon", areas).select("event_id", F.lit("area").alias("near_kind"), F.col("near_id").cast("long").alias("near_id"))
    s = near_points(e, "event_id", "location_lat", "location_lon", seeds, "seed_id", "location_lat", "location_lon", seed_km).select("event_id", F.lit("seed").alias("near_kind"), F.col("near_id").cast("long").alias("near_id"))
    return a.unionByName(s)
