"""Mosaics: tiles pasted around a point."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import png
from ..functions.geometry import TILE, pixel_x, pixel_y


def windows(spots: DataFrame, width: int, height: int) -> DataFrame:
    """Per spot (``name, lon, lat, z``) its top left pixel and the tiles that the window meets."""
    z = F.col("z")
    at = spots.select("name", "z", F.floor(pixel_x(F.col("lon"), z) - width / 2).cast("int").alias("left"), F.floor(pixel_y(F.col("lat"), z) - height / 2).cast("int").alias("top"))
    span = lambda c, n: F.sequence(F.floor(F.col(c) / TILE).cast("int"), F.floor((F.col(c) + n - 1) / TILE).cast("int"))
    return at.withColumn("x", F.explode(span("left", width))).withColumn("y", F.explode(span("top", height)))


def mosaics(spots: DataFrame, tiles: DataFrame, width: int, height: int) -> DataFrame:
    """``name, image, got, total``: a PNG per spot, and how many of its tiles were there."""

    def paste(p: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((height, width, 4), dtype=np.uint8)
        out[..., :3] = 255
        got = 0
        for r in p.itertuples(index=False):
            if r.tile_data is None:
                continue
            got += 1
            x, y = r.x * TILE - r.left, r.y * TILE - r.top
            x0, y0, x1, y1 = max(x, 0), max(y, 0), min(x + TILE, width), min(y + TILE, height)
            out[y0:y1, x0:x1] = png.decode(r.tile_data)[y0 - y : y1 - y, x0 - x : x1 - x]
        return pd.DataFrame([(p["name"].iloc[0], png.encode(out), got, len(p))], columns=["name", "image", "got", "total"])

    return windows(spots, width, height).join(tiles.select("z", "x", "y", "tile_data"), ["z", "x", "y"], "left").groupBy("name").applyInPandas(paste, "name string, image binary, got long, total long")


def compared(areas: DataFrame, sources: dict[str, DataFrame], z: int, gap: int = 4) -> DataFrame:
    """Per area one image with a panel for each source, and how complete each panel is.

    ``areas`` has ``name, west, south, east, north``; the panel of an area is all
    its tiles at ``z``, absent ones left blank.
    """
    from functools import reduce

    from ..functions.geometry import cells, rectangles

    rects = rectangles(areas, z, z)
    wanted = cells(rects, ["name", "z"]).join(rects.select("name", F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")), "name")
    panels = [wanted.join(t.select("z", "x", "y", "tile_data"), ["z", "x", "y"], "left").withColumn("panel", F.lit(i)) for i, t in enumerate(sources.values())]
    names = list(sources)

    def draw(p: pd.DataFrame) -> pd.DataFrame:
        r = p.iloc[0]
        x0, y0 = int(r["x0"]), int(r["y0"])
        w, h = (int(r["x1"]) - x0 + 1) * TILE, (int(r["y1"]) - y0 + 1) * TILE
        out = np.full((h, len(names) * (w + gap) - gap, 4), 255, dtype=np.uint8)
        got = [0] * len(names)
        for t in p[p["tile_data"].notna()].itertuples(index=False):
            x, y = t.panel * (w + gap) + (t.x - x0) * TILE, (t.y - y0) * TILE
            out[y : y + TILE, x : x + TILE] = png.decode(t.tile_data)
            got[t.panel] += 1
        total = len(p) // len(names)
        label = "; ".join(f"{n}: {g}/{total}" for n, g in zip(names, got))
        return pd.DataFrame([(r["name"], png.encode(out), label)], columns=["name", "image", "label"])

    return reduce(DataFrame.unionByName, panels).groupBy("name").applyInPandas(draw, "name string, image binary, label string")
