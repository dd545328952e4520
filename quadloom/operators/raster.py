"""Raster kernels on columns of encoded tiles, in Arrow batches.

Blobs are decoded inside the function that consumes them and never collected;
set ``spark.sql.execution.arrow.maxRecordsPerBatch`` to a few dozen rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import png, raster
from ..functions.pixels import DARK, OPAQUE, WHITE

SURVEY = "fill long, other long, opaque long"


def _batched(function: Callable, kind: str) -> Callable[..., Column]:
    """A pandas UDF of a kernel that takes and gives single values; null in, null out."""

    def apply(*columns: pd.Series) -> pd.Series:
        return pd.Series([None if any(v is None for v in row) else function(*row) for row in zip(*columns)], dtype=object)

    def first(a: pd.Series) -> pd.Series:
        return apply(a)

    def second(a: pd.Series, b: pd.Series) -> pd.Series:
        return apply(a, b)

    def fourth(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return apply(a, b, c, d)

    by_count = {1: first, 2: second, 4: fourth}
    return lambda *c: F.pandas_udf(by_count[len(c)], kind)(*c)


def surveyed(tiles: DataFrame, white: int = WHITE) -> DataFrame:
    """Adds ``fill, other, opaque`` pixel counts, ``chart`` and ``solid``."""

    @F.pandas_udf(SURVEY)
    def count(blobs: pd.Series) -> pd.DataFrame:
        rows = []
        for b in blobs:
            a = png.decode(b)
            opaque = a[..., 3] == OPAQUE
            fill = opaque & (a[..., :3].max(axis=2) <= DARK)
            rows.append((int(fill.sum()), int((opaque & ~fill & (a[..., :3].min(axis=2) < white)).sum()), int(opaque.sum())))
        return pd.DataFrame(rows, columns=["fill", "other", "opaque"])

    out = tiles.withColumn("_s", count("tile_data")).select(*tiles.columns, "_s.*")
    return out.withColumns({"chart": F.col("other") > 0, "solid": (F.col("opaque") > 0) & (F.col("fill") == F.col("opaque"))})


def has_marks(blob: Column, white: int = WHITE) -> Column:
    """Whether an opaque pixel is anything but blank paper."""

    def kernel(b: bytes) -> bool:
        a = png.decode(b)
        return bool(((a[..., 3] == OPAQUE) & (a[..., :3].min(axis=2) < white)).any())

    return _batched(kernel, "boolean")(blob)


def packed_mask(blob: Column, kind: str, white: int = WHITE) -> Column:
    """A tile's no-data mask in 8 KB."""
    return _batched(lambda b: np.packbits(raster.no_data(png.decode(b), kind, white)).tobytes(), "binary")(blob)


def alpha_mask(blob: Column, side: int = raster.MASK) -> Column:
    return _batched(lambda b: np.packbits(raster.alpha_mask(png.decode(b), side)).tobytes(), "binary")(blob)


def quadrant_mask(mask: Column, qx: Column, qy: Column, side: Column) -> Column:
    """A quarter of a packed mask, enlarged; null if it is empty."""

    def kernel(m: bytes, x: int, y: int, n: int):
        q = raster.mask_quadrant(np.unpackbits(np.frombuffer(m, np.uint8))[: n * n].reshape(n, n).astype(bool), x, y)
        return np.packbits(q).tobytes() if q.any() else None

    return _batched(kernel, "binary")(mask, qx, qy, side)


def without_solid(blob: Column) -> Column:
    """Null for tiles that are fill and nothing else; otherwise the bytes as they came."""
    return _batched(lambda b: None if raster.all_fill(png.decode(b)) else b, "binary")(blob)


def strip_pixels(tiles: DataFrame, kind: str, radius: int, white: int = WHITE) -> DataFrame:
    """``z, x, y, tile_data, erased``: tiles that lose pixels, null data for those with nothing left.

    ``tiles`` has ``tile_data``, ``around`` (packed masks by side, absent: no-data) and ``outward`` (sides).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                image = png.decode(r.tile_data)
                shape = image.shape[:2]
                pads = {s: np.unpackbits(np.frombuffer(m, np.uint8)).reshape(shape).astype(bool) for s, m in dict(r.around or {}).items()}
                gone = raster.removal(raster.no_data(image, kind, white), pads, radius, set(r.outward))
                if gone.any():
                    left = raster.erased(image, gone)
                    rows.append((r.z, r.x, r.y, None if left is None else png.encode(left), int(gone.sum())))
            yield pd.DataFrame(rows, columns=["z", "x", "y", "tile_data", "erased"])

    return tiles.select("z", "x", "y", "tile_data", "around", "outward").mapInPandas(run, "z int, x int, y int, tile_data binary, erased long")


def novelty_scores(tiles: DataFrame) -> DataFrame:
    """``z, x, y, novelty, same`` for each tile whose parent is there too and that shows something."""
    up = tiles.select((F.col("z") + 1).alias("z"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("tile_data").alias("parent"))
    pair = tiles.withColumns({"px": F.shiftright("x", 1), "py": F.shiftright("y", 1)}).join(up, ["z", "px", "py"])

    @F.pandas_udf("novelty double, same double")
    def score(child: pd.Series, parent: pd.Series, x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = []
        for c, p, i, j in zip(child, parent, x, y):
            a, b = png.decode(c), png.decode(p)
            rows.append((raster.novelty(a, b, i % 2, j % 2), raster.same_share(a, b, i % 2, j % 2)))
        return pd.DataFrame(rows, columns=["novelty", "same"])

    out = pair.withColumn("_s", score("tile_data", "parent", "x", "y")).select("z", "x", "y", "_s.*")
    return out.where(F.col("novelty").isNotNull() & ~F.isnan("novelty"))
