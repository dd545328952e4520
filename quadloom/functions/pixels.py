"""Tests on pixels in long form (columns r, g, b, a)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The darkest fill, the palest paper, opaque alpha.
DARK, WHITE, OPAQUE = 40, 254, 255


def is_blank(r: Column, g: Column, b: Column, white: int = WHITE) -> Column:
    return F.least(r, g, b) >= white


def is_fill(r: Column, g: Column, b: Column, a: Column) -> Column:
    return (F.greatest(r, g, b) <= DARK) & (a == OPAQUE)


def is_fillable(r: Column, g: Column, b: Column, a: Column) -> Column:
    return is_fill(r, g, b, a) | (a == 0)


def is_vacant(r: Column, g: Column, b: Column, a: Column, white: int = WHITE) -> Column:
    return ((a == OPAQUE) & is_blank(r, g, b, white)) | (a == 0)


def is_nodata(kind: Column, r: Column, g: Column, b: Column, a: Column, white: int = WHITE) -> Column:
    return F.when(kind == "black", is_fillable(r, g, b, a)).otherwise(is_vacant(r, g, b, a, white))


def survey(white: int = WHITE) -> list[Column]:
    """Aggregates per tile: fill, other and opaque pixels, and what follows from them."""
    r, g, b, a = (F.col(c) for c in "rgba")
    opaque = a == OPAQUE
    fill = is_fill(r, g, b, a)
    other = opaque & ~fill & ~is_blank(r, g, b, white)
    n = [F.count_if(c).cast("long") for c in (fill, other, opaque)]
    return [
        n[0].alias("fill"), n[1].alias("other"), n[2].alias("opaque"), (n[1] > 0).alias("chart"), ((n[2] > 0) & (n[0] == n[2])).alias("solid"),
        F.coalesce(F.bool_or(opaque & ~is_blank(r, g, b, white)), F.lit(False)).alias("marked"), (F.max(a) == 0).alias("transparent"),
    ]
