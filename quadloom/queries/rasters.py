"""Pixel tests and raster kernels on the vectors as 8 x 8 images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import pixels as px
from ..functions import png
from ..operators import raster as r
from . import bindings as b


def pixel_survey(spark, sf_dir):
    return b.shades(spark, sf_dir).groupBy("vec_id").agg(*px.survey())


def pixel_classes(spark, sf_dir):
    c = [F.col(k) for k in "rgba"]
    s = b.shades(spark, sf_dir).select(px.is_blank(*c[:3]).alias("blank"), px.is_fill(*c).alias("fill"), px.is_fillable(*c).alias("fillable"), px.is_vacant(*c).alias("vacant"), px.is_nodata(F.when(F.col("vec_id") % 2 == 0, "black").otherwise("white"), *c).alias("nodata"))
    return s.groupBy("blank", "fill", "fillable", "vacant", "nodata").agg(F.count(F.lit(1)).alias("n"))


def halved_pixels(spark, sf_dir):
    """2 x 2 means by integer division."""
    p = b.pixels(spark, sf_dir)
    return p.groupBy("vec_id", F.shiftright("px", 1).alias("px"), F.shiftright("py", 1).alias("py")).agg(F.expr("cast(sum(v) div 4 as int)").alias("v"))


def max_pooled(spark, sf_dir):
    s = b.shades(spark, sf_dir)
    return s.groupBy("vec_id", F.floor(F.col("px") / 4).cast("int").alias("cx"), F.floor(F.col("py") / 4).cast("int").alias("cy")).agg(F.max("a").cast("int").alias("a"))


def nearest_share(spark, sf_dir):
    """Share of a child's pixels that its parent's quarter, doubled, gives exactly; the parent is the vector before."""
    p = b.pixels(spark, sf_dir).withColumn("v", F.expr("v div 8"))
    c = p.select("vec_id", "px", "py", "v", (F.col("vec_id") - 1).alias("up"), F.expr("(vec_id % 2) * 4 + px div 2").alias("ux"), F.expr("(vec_id div 2 % 2) * 4 + py div 2").alias("uy"))
    u = p.select(F.col("vec_id").alias("up"), F.col("px").alias("ux"), F.col("py").alias("uy"), F.col("v").alias("pv"))
    return c.join(u, ["up", "ux", "uy"]).groupBy("vec_id").agg(F.round(F.avg((F.col("v") == F.col("pv")).cast("double")), 9).alias("same"))


def kernel_survey(spark, sf_dir):
    """The survey once more, by the kernel on encoded tiles."""
    s = b.as_bytes(b.shades(spark, sf_dir)).select("vec_id", "px", "py", *"rgba")
    one = s.groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("py", "px", *"rgba"))).alias("p"))

    @F.pandas_udf("binary")
    def drawn(images: pd.Series) -> pd.Series:
        return pd.Series([png.encode(np.array([[q["r"], q["g"], q["b"], q["a"]] for q in p], dtype=np.uint8).reshape(8, 8, 4)) for p in images])

    tiles = one.select("vec_id", drawn("p").alias("tile_data"))
    return r.surveyed(tiles).select("vec_id", "fill", "other", "opaque", "chart", "solid")


Q = f"WITH {b.SQL_PIXELS}, {b.SQL_SHADES}, s AS ({b.SQL_RGBA}) "
_FILL, _BLANK = "(greatest(r, g, b) <= 40 AND a = 255)", "(least(r, g, b) >= 254)"
_COUNTS = f"count(*) FILTER {_FILL} AS fill, count(*) FILTER (a = 255 AND NOT {_FILL} AND NOT {_BLANK}) AS other, count(*) FILTER (a = 255) AS opaque"
QUERIES = {
    "pixel_survey": (
        pixel_survey,
        Q + f", n AS (SELECT vec_id, {_COUNTS}, coalesce(bool_or(a = 255 AND NOT {_BLANK}), false) AS marked, max(a) = 0 AS transparent FROM s GROUP BY vec_id) SELECT vec_id, fill, other, opaque, other > 0 AS chart, opaque > 0 AND fill = opaque AS solid, marked, transparent FROM n",
    ),
    "pixel_classes": (
        pixel_classes,
        Q + f", c AS (SELECT {_BLANK} AS blank, {_FILL} AS fill, {_FILL} OR a = 0 AS fillable, (a = 255 AND {_BLANK}) OR a = 0 AS vacant, vec_id FROM s) SELECT blank, fill, fillable, vacant, CASE WHEN vec_id % 2 = 0 THEN fillable ELSE vacant END AS nodata, count(*) AS n FROM c GROUP BY ALL",
    ),
    "halved_pixels": (halved_pixels, f"WITH {b.SQL_PIXELS} SELECT vec_id, (px >> 1)::INTEGER AS px, (py >> 1)::INTEGER AS py, (sum(v) // 4)::INTEGER AS v FROM p GROUP BY 1, 2, 3"),
    "max_pooled": (max_pooled, Q + "SELECT vec_id, (px // 4)::INTEGER AS cx, (py // 4)::INTEGER AS cy, max(a)::INTEGER AS a FROM s GROUP BY ALL"),
    "nearest_share": (
        nearest_share,
        f"WITH {b.SQL_PIXELS} SELECT c.vec_id, round(avg((c.v // 8 = u.v // 8)::INTEGER::DOUBLE), 9) AS same FROM p c JOIN p u ON u.vec_id = c.vec_id - 1 AND u.px = (c.vec_id % 2) * 4 + c.px // 2 AND u.py = (c.vec_id // 2 % 2) * 4 + c.py // 2 GROUP BY c.vec_id",
    ),
    "kernel_survey": (kernel_survey, Q + f", n AS (SELECT vec_id, {_COUNTS} FROM s GROUP BY vec_id) SELECT *, other > 0 AS chart, opaque > 0 AND fill = opaque AS solid FROM n"),
}
