"""Rebuilding lower zooms from a source zoom."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import png, raster
from ..functions.geometry import quadrant
from ..session import settled
from . import relations


def level_above(tiles: DataFrame) -> DataFrame:
    """The parents of one zoom's tiles: four children at most meet per parent, so nothing is skewed."""

    def build(children: pd.DataFrame) -> pd.DataFrame:
        first = children.iloc[0]
        image = raster.parent_of({int(q): png.decode(b) for q, b in zip(children["q"], children["tile_data"])})
        rows = [] if image is None else [(int(first["z"]) - 1, int(first["px"]), int(first["py"]), png.encode(image))]
        return pd.DataFrame(rows, columns=["z", "x", "y", "tile_data"])

    keyed = tiles.select("z", F.shiftright("x", 1).alias("px"), F.shiftright("y", 1).alias("py"), quadrant(F.col("x"), F.col("y")).alias("q"), "tile_data")
    return keyed.groupBy("z", "px", "py").applyInPandas(build, "z int, x int, y int, tile_data binary")


def rebuilt(tiles: DataFrame, source: int, lowest: int) -> DataFrame:
    """All zooms: ``source`` and deeper as they are, ``lowest`` up to ``source`` made anew, originals where nothing was made."""
    out = relations.kept_levels(tiles, lowest, source)
    level = tiles.where(F.col("z") == source)
    for _ in range(source - lowest):
        level = settled(level_above(level))
        out = out.unionByName(level)
    return relations.filled(out, tiles, lowest, source)


def floor_zoom(zooms: DataFrame, metadata: dict[str, str]) -> DataFrame:
    """The lowest zoom to rebuild: the least of what is there, what is pending or what was stated."""
    stated = F.coalesce(F.lit(metadata.get("pyramid_pending")).try_cast("int"), F.lit(metadata.get("minzoom")).try_cast("int"))
    low = F.min("z")
    return zooms.agg(F.least(low, F.coalesce(stated, low)).alias("floor"))
