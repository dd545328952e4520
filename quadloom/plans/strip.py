"""Removing no-data from an archive's deepest zoom."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import STAGES
from ..operators import grid, raster, relations
from ..session import settled

RADIUS, WHITE, LIMIT = 128, 254, 2


class Emptied(RuntimeError):
    """Nothing is left of the deepest zoom."""


def _pixel_pass(tiles: DataFrame, faced: DataFrame, kind: str, radius: int, white: int) -> DataFrame:
    """The tiles after a pixel flood on those in ``faced`` (``x, y, sides``)."""
    want = faced.select("x", "y", F.col("sides").alias("outward"))
    # Only what some candidate is padded with is decoded.
    near = grid.neighbours(want, [*grid.AROUND]).where(~F.array_contains("outward", F.col("side"))).select(F.col("nx").alias("x"), F.col("ny").alias("y")).distinct()
    masks = settled(tiles.join(near, ["x", "y"], "left_semi").select("x", "y", raster.packed_mask(F.col("tile_data"), kind, white).alias("mask")))
    padded = grid.around_payload(want, masks, "mask")
    subject = tiles.select("z", "x", "y", "tile_data").join(padded, ["x", "y"])
    changed = settled(raster.strip_pixels(subject, kind, radius, white))
    return relations.replace(tiles, changed.where("tile_data IS NOT NULL").select(*tiles.columns), unique=True).join(changed.where("tile_data IS NULL"), ["z", "x", "y"], "left_anti")


def stripped(tiles: DataFrame, stages: list[str], radius: int = RADIUS, white: int = WHITE, limit: int = LIMIT) -> DataFrame:
    """One zoom's tiles (``z, x, y, tile_data``) after the stages, which always run in their canonical order.

    The survey is made anew after a stage that drops tiles, since that changes
    what their neighbours face.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    now = tiles.select("z", "x", "y", "tile_data")
    survey = lambda t: settled(raster.surveyed(t, white).drop("tile_data"))
    if "black-tiles" in stages:
        s = survey(now)
        walked = grid.outside(s.withColumn("marked", F.col("chart")))
        now = settled(relations.without(now, s.where("solid").join(walked, ["x", "y"], "left_semi")))
    if "black-pixels" in stages:
        s = survey(now)
        edge = settled(grid.edge_tiles(s))
        grid.refuse_leaks(s.where("solid"), edge)
        now = settled(_pixel_pass(now, edge, "black", radius, white))
    if "white-tiles" in stages or "white-pixels" in stages:
        c = settled(now.select("x", "y", raster.has_marks(F.col("tile_data"), white).alias("marked")))
        held = grid.held(c, limit=limit)
        gone = c.where("NOT marked").join(held, ["x", "y"], "left_anti")
        if "white-tiles" in stages:
            now = settled(now.join(gone, ["x", "y"], "left_anti").select("z", "x", "y", "tile_data"))
        if "white-pixels" in stages:
            walls = c.where("marked").select("x", "y").unionByName(held)
            free = gone.select("x", "y")
            walked = grid.outside(walls.withColumn("marked", F.lit(True)).unionByName(free.withColumn("marked", F.lit(False))))
            now = settled(_pixel_pass(now, grid.facing(walls, walked), "white", radius, white))
    if now.isEmpty():
        raise Emptied("the deepest zoom would be empty")
    return now


def dry_run(tiles: DataFrame, white: int = WHITE) -> DataFrame:
    """How many tiles hold fill, are solid, and would be flooded."""
    s = settled(raster.surveyed(tiles, white).drop("tile_data"))
    edge = grid.edge_tiles(s)
    n = s.agg(F.count(F.lit(1)).alias("tiles"), F.count_if(F.col("fill") > 0).alias("with_fill"), F.count_if("solid").alias("solid"))
    return n.withColumn("candidates", F.lit(edge.count()))
