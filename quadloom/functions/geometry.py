"""Web-mercator tile arithmetic as column expressions.

Tiles are (z, x, y) with y counted from the north; archives count rows from the
south, so only their readers and writers flip. Everything stays in whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sphere of EPSG:3857, pixels of a tile, the four sides and eight neighbours.
EARTH_RADIUS = 6378137.0
TILE = 256
SIDES = [(1, 0, "r"), (-1, 0, "l"), (0, 1, "b"), (0, -1, "t")]
AROUND = [*SIDES, (1, 1, "rb"), (1, -1, "rt"), (-1, 1, "lb"), (-1, -1, "lt")]


def span(z: Column) -> Column:
    """Tiles across the world at a zoom."""
    return F.call_function("shiftleft", F.lit(1), z)


def lon_to_x(lon: Column, z: Column) -> Column:
    """Tile column, truncated toward zero."""
    return ((lon + 180) / 360 * span(z)).cast("int")


def lat_to_y(lat: Column, z: Column) -> Column:
    """Tile row from the north, truncated toward zero."""
    return ((1 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2 * span(z)).cast("int")


def clamped(v: Column, z: Column) -> Column:
    return F.greatest(F.lit(0), F.least(span(z) - 1, v))


def x_to_lon(x: Column, z: Column) -> Column:
    """West edge of a column."""
    return x / span(z) * 360 - 180


def y_to_lat(y: Column, z: Column) -> Column:
    """North edge of a row."""
    return F.degrees(F.atan(F.sinh(F.pi() * (1 - 2 * y / span(z)))))


def pixel_x(lon: Column, z: Column) -> Column:
    return (lon + 180) / 360 * span(z) * TILE


def pixel_y(lat: Column, z: Column) -> Column:
    return (1 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2 * span(z) * TILE


def flip_row(row: Column, z: Column) -> Column:
    """Between rows counted from the north and from the south (its own inverse)."""
    return span(z) - 1 - row


def ancestor(v: Column, levels: Column | int) -> Column:
    return F.shiftright(v, levels) if isinstance(levels, int) else F.call_function("shiftright", v, levels)


def quadrant(x: Column, y: Column) -> Column:
    """Place in the parent: 0 nw, 1 ne, 2 sw, 3 se."""
    return x % 2 + y % 2 * 2


def footprint_centre(v: Column, levels: int) -> Column:
    """The middle tile of a footprint cell, ``levels`` zooms deeper."""
    return F.shiftleft(v, levels) + ((1 << levels) >> 1)


def bbox(z: Column, x: Column, y: Column, nx: int = 1, ny: int = 1) -> list[Column]:
    """West, south, east, north of a block of tiles in EPSG:3857 metres."""
    import math

    half = math.pi * EARTH_RADIUS
    size = 2 * half / span(z)
    return [x * size - half, half - (y + ny) * size, (x + nx) * size - half, half - y * size]


def children(df: DataFrame) -> DataFrame:
    """The four tiles below each; ``z, x, y``."""
    four = F.array(*[F.struct((F.col("x") * 2 + dx).alias("x"), (F.col("y") * 2 + dy).alias("y")) for dy in (0, 1) for dx in (0, 1)])
    return df.select((F.col("z") + 1).alias("z"), F.explode(four).alias("c")).select("z", "c.x", "c.y")


def parents(df: DataFrame, levels: int = 1) -> DataFrame:
    """The different tiles ``levels`` above."""
    return df.select((F.col("z") - levels).alias("z"), F.shiftright("x", levels).alias("x"), F.shiftright("y", levels).alias("y")).distinct()


def rectangles(areas: DataFrame, low: int, high: int) -> DataFrame:
    """Per area and zoom the tile rectangle of its ``west, south, east, north``; other columns stay."""
    at = areas.withColumn("z", F.explode(F.sequence(F.lit(low), F.lit(high))))
    z = F.col("z")
    return at.select(
        *[c for c in areas.columns if c not in ("west", "south", "east", "north")], "z", clamped(lon_to_x(F.col("west"), z), z).alias("x0"), clamped(lon_to_x(F.col("east"), z), z).alias("x1"),
        clamped(lat_to_y(F.col("north"), z), z).alias("y0"), clamped(lat_to_y(F.col("south"), z), z).alias("y1"),
    )


def overlap(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Intersection of rectangles per key; empty ones go."""
    o = b.select(*on, *[F.col(c).alias(f"o_{c}") for c in ("x0", "x1", "y0", "y1")])
    cut = a.join(o, on).select(*on, *[F.greatest(c, f"o_{c}").alias(c) for c in ("x0", "y0")], *[F.least(c, f"o_{c}").alias(c) for c in ("x1", "y1")])
    return cut.where("x0 <= x1 AND y0 <= y1")


def cells(rects: DataFrame, keep: list[str]) -> DataFrame:
    """Every tile of every rectangle, a row each."""
    return rects.select(*keep, F.explode(F.sequence("x0", "x1")).alias("x"), "y0", "y1").select(*keep, "x", F.explode(F.sequence("y0", "y1")).alias("y"))
