"""Tile arithmetic on the orders' made-up places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..session import table
from . import bindings as b


def tile_address(spark, sf_dir):
    t = b.tiles(spark, sf_dir)
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return t.select("z", "x", "y", g.flip_row(y, z).alias("tms_row"), g.ancestor(x, 1).alias("px"), g.ancestor(y, 1).alias("py"), g.quadrant(x, y).alias("quadrant"))


def tile_corners(spark, sf_dir):
    t = b.tiles(spark, sf_dir)
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    r = lambda c, n: F.round(c, 7).alias(n)
    return t.select("z", "x", "y", r(g.x_to_lon(x, z), "west"), r(g.y_to_lat(y, z), "north"), r(g.x_to_lon(x + 0.5, z), "mid_lon"), r(g.y_to_lat(y + 0.5, z), "mid_lat"))


def tile_bbox(spark, sf_dir):
    t = b.tiles(spark, sf_dir)
    box = g.bbox(F.col("z"), F.col("x"), F.col("y"), 2, 1)
    return t.select("z", "x", "y", *[F.round(c, 3).alias(n) for c, n in zip(box, ("west", "south", "east", "north"))])


def pixel_position(spark, sf_dir):
    p = b.places(spark, sf_dir)
    z = F.lit(9)
    return p.select("o_orderkey", F.round(g.pixel_x(F.col("lon"), z), 5).alias("px"), F.round(g.pixel_y(F.col("lat"), z), 5).alias("py"), g.clamped(g.lon_to_x(F.col("lon") * 9, z), z).alias("clamped_x"))


def _areas(spark, sf_dir):
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(k.alias("area"), (k * 1.5 + 3).alias("west"), (k * 0.5 + 50).alias("south"), (k * 1.5 + 9).alias("east"), (k * 0.5 + 54).alias("north"))


_SQL_RECTS = f"""SELECT area, z::INTEGER AS z, greatest(0, least((1 << z) - 1, {b.SQL_X.replace('lon', 'west')}))::INTEGER AS x0, greatest(0, least((1 << z) - 1, {b.SQL_X.replace('lon', 'east')}))::INTEGER AS x1,
  greatest(0, least((1 << z) - 1, {b.SQL_Y.replace('lat', 'north')}))::INTEGER AS y0, greatest(0, least((1 << z) - 1, {b.SQL_Y.replace('lat', 'south')}))::INTEGER AS y1
FROM (SELECT n_nationkey AS area, n_nationkey * 1.5e0 + 3 AS west, n_nationkey * 0.5e0 + 50 AS south, n_nationkey * 1.5e0 + 9 AS east, n_nationkey * 0.5e0 + 54 AS north FROM nation), range(3, 10) AS r(z)"""


def extent_rectangles(spark, sf_dir):
    return g.rectangles(_areas(spark, sf_dir), 3, 9)


def clamped_bounds(spark, sf_dir):
    r = g.rectangles(_areas(spark, sf_dir), 3, 9)
    other = r.select((F.col("area") - 2).alias("area"), "z", "x0", "x1", "y0", "y1")
    return g.overlap(r, other, ["area", "z"])


def rectangle_cells(spark, sf_dir):
    r = g.rectangles(_areas(spark, sf_dir), 6, 7)
    return g.cells(r, ["area", "z"]).groupBy("area", "z").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x") * 1000 + F.col("y")).cast("long").alias("mark"))


def child_tiles(spark, sf_dir):
    return g.children(b.tiles(spark, sf_dir).where("z = 8"))


def footprint_centres(spark, sf_dir):
    f = b.footprint(spark, sf_dir)
    return f.select("x", "y", g.footprint_centre(F.col("x"), 3).alias("cx"), g.footprint_centre(F.col("y"), 3).alias("cy"))


T = f"WITH {b.SQL_TILES} "
QUERIES = {
    "tile_address": (tile_address, T + "SELECT z, x, y, ((1 << z) - 1 - y)::INTEGER AS tms_row, (x >> 1)::INTEGER AS px, (y >> 1)::INTEGER AS py, (x % 2 + y % 2 * 2)::INTEGER AS quadrant FROM t"),
    "tile_corners": (
        tile_corners,
        T + "SELECT z, x, y, round(x / (1 << z) * 360 - 180, 7) AS west, round(degrees(atan(sinh(pi() * (1 - 2 * y / (1 << z))))), 7) AS north, round((x + 0.5e0) / (1 << z) * 360 - 180, 7) AS mid_lon, round(degrees(atan(sinh(pi() * (1 - 2 * (y + 0.5e0) / (1 << z))))), 7) AS mid_lat FROM t",
    ),
    "tile_bbox": (
        tile_bbox,
        T + ", h AS (SELECT z, x, y, pi() * 6378137e0 AS half, 2 * pi() * 6378137e0 / (1 << z) AS size FROM t) SELECT z, x, y, round(x * size - half, 3) AS west, round(half - (y + 1) * size, 3) AS south, round((x + 2) * size - half, 3) AS east, round(half - y * size, 3) AS north FROM h",
    ),
    "pixel_position": (
        pixel_position,
        f"SELECT o_orderkey, round((lon + 180) / 360 * 512 * 256, 5) AS px, round((1 - asinh(tan(radians(lat))) / pi()) / 2 * 512 * 256, 5) AS py, greatest(0, least(511, trunc((lon * 9 + 180) / 360 * 512)))::INTEGER AS clamped_x FROM {b.SQL_PLACES}",
    ),
    "extent_rectangles": (extent_rectangles, _SQL_RECTS),
    "clamped_bounds": (
        clamped_bounds,
        f"WITH r AS ({_SQL_RECTS}) SELECT * FROM (SELECT a.area, a.z, greatest(a.x0, o.x0) AS x0, greatest(a.y0, o.y0) AS y0, least(a.x1, o.x1) AS x1, least(a.y1, o.y1) AS y1 FROM r a JOIN r o ON o.area - 2 = a.area AND o.z = a.z) WHERE x0 <= x1 AND y0 <= y1",
    ),
    "rectangle_cells": (rectangle_cells, f"WITH r AS ({_SQL_RECTS}) SELECT area, z, count(*) AS n, sum(x * 1000 + y)::BIGINT AS mark FROM r, unnest(range(x0, x1 + 1)) AS i(x), unnest(range(y0, y1 + 1)) AS j(y) WHERE z IN (6, 7) GROUP BY area, z"),
    "child_tiles": (child_tiles, T + "SELECT 9 AS z, (2 * x + dx)::INTEGER AS x, (2 * y + dy)::INTEGER AS y FROM t, range(2) AS i(dx), range(2) AS j(dy) WHERE z = 8"),
    "footprint_centres": (footprint_centres, f"WITH {b.SQL_ORDER_TILES}, {b.SQL_FOOTPRINT} SELECT x, y, ((x << 3) + 4)::INTEGER AS cx, ((y << 3) + 4)::INTEGER AS cy FROM f"),
}
