"""Crawls: which tiles to ask for, zoom by zoom.

``fetch`` is any function from candidates (``z, x, y``) to answers (``z, x, y,
status`` and perhaps ``data``); ``sources.service`` makes one for a tile server
and ``from_table`` one from a table. Each step settles its answers in the shared
folder, so a tile is asked for once whatever later steps read. Statuses:
ok (content), empty, err; ``masked`` also tells blank from outside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import grid, relations
from ..operators import raster as r
from ..session import settled

Fetch = Callable[[DataFrame], DataFrame]
KEYS = ["z", "x", "y"]


def from_table(answers: DataFrame, absent: str = "empty") -> Fetch:
    """Answers looked up by place; a place without one is ``absent``."""

    def fetch(candidates: DataFrame) -> DataFrame:
        return candidates.join(answers, KEYS, "left").withColumn("status", F.coalesce("status", F.lit(absent)))

    return fetch


def candidates(frontier: DataFrame | None, limits: DataFrame, z: int, full_until: int = -1) -> DataFrame:
    """The next zoom's candidates: the whole rectangle while ``z <= full_until`` or without a frontier, else the frontier's children inside it."""
    here = limits.where(F.col("z") == z)
    if frontier is None or z <= full_until:
        return g.cells(here, ["z"]).select(*KEYS).distinct()
    inside = F.lit(False)
    for r in here.collect():  # a rectangle or a few: a filter, not a join
        inside = inside | (F.col("x").between(r["x0"], r["x1"]) & F.col("y").between(r["y0"], r["y1"]))
    return g.children(frontier.where(F.col("z") == z - 1)).distinct().where(inside)


def clipped(tiles: DataFrame, limits: DataFrame | None) -> DataFrame:
    """Tiles inside the rectangles of their zoom (a few rows per zoom, so they are broadcast); all of them without limits."""
    if limits is None:
        return tiles
    box = F.broadcast(limits.select(F.col("z").alias("_z"), "x0", "x1", "y0", "y1"))
    return tiles.join(box, (F.col("z") == F.col("_z")) & F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")), "left_semi")


def descent(seed: DataFrame, fetch: Fetch, low: int, high: int, done: DataFrame | None = None, limits: DataFrame | None = None) -> DataFrame:
    """New content tiles: every zoom asks for the children of the last one's content; errors don't hold it up.

    ``done`` is the content that earlier runs stored: it is not asked for
    again, but its children are. ``limits`` clip every zoom.
    """
    found, frontier = None, seed.select(*KEYS)
    for z in range(low, high + 1):
        ask = frontier if z == low else g.children(frontier).distinct()
        ask = clipped(ask, limits)
        ask = ask if done is None else relations.todo(ask, done)
        content = settled(fetch(ask).where("status = 'ok'").select(*KEYS))
        found = content if found is None else found.unionByName(content)
        frontier = content if done is None else settled(content.unionByName(done.where(F.col("z") == z).select(*KEYS)))
        if frontier.isEmpty():
            break
    return found


def flood(seeds: DataFrame, fetch: Fetch, footprint: DataFrame, footprint_z: int, limits: DataFrame | None = None) -> DataFrame:
    """Content tiles of one zoom that 8-connected steps from content to content reach from the seeds, within the footprint."""
    seen = frontier = settled(grid.within_footprint(seeds.select(*KEYS).distinct(), footprint, footprint_z))
    found = None
    while not frontier.isEmpty():
        content = settled(fetch(frontier).where("status = 'ok'").select(*KEYS))
        found = content if found is None else found.unionByName(content)
        step = grid.neighbours(content, g.AROUND).select("z", F.col("nx").alias("x"), F.col("ny").alias("y")).distinct()
        step = clipped(grid.within_footprint(step, footprint, footprint_z), limits)
        frontier = settled(relations.todo(step, seen))
        seen = settled(seen.unionByName(frontier))
    return seen.limit(0) if found is None else found


def fill(footprint_z: int, limits: DataFrame, fetch: Fetch, low: int, high: int) -> DataFrame:
    """The default crawl: rectangles down to ``footprint_z`` give the footprint; deeper, a flood from its cell centres and the last zoom's content."""
    found, content = None, None
    footprint = None
    for z in range(low, high + 1):
        if z <= footprint_z:
            content = settled(fetch(candidates(None, limits, z)).where("status = 'ok'").select(*KEYS))
            if z == footprint_z:
                footprint = content.select("x", "y")
        else:
            s = z - footprint_z
            centres = footprint.select(F.lit(z).alias("z"), g.footprint_centre(F.col("x"), s).alias("x"), g.footprint_centre(F.col("y"), s).alias("y"))
            content = settled(flood(centres.unionByName(g.children(content)).distinct(), fetch, footprint, footprint_z, limits.where(F.col("z") == z)))
        found = content if found is None else found.unionByName(content)
    return found


def eligible(footprint: DataFrame, footprint_z: int, z: int) -> DataFrame:
    """The tiles of a zoom that a footprint allows: what lies under its cells, or over them and next to that."""
    if z < footprint_z:
        up = footprint.select(F.lit(z).alias("z"), *[g.ancestor(F.col(c), footprint_z - z).alias(c) for c in "xy"]).distinct()
        return grid.dilated(up, ["z"])
    out = footprint.select(F.lit(footprint_z).alias("z"), "x", "y").distinct()
    for _ in range(z - footprint_z):
        out = g.children(out)
    return out


def overlap(limits: DataFrame, area: DataFrame) -> DataFrame:
    """The part of each zoom's limits inside an area's rectangles; an area that misses them at the deepest zoom is refused."""
    both = settled(g.overlap(limits, area, ["z"]))
    deepest = [df.agg(F.max("z")).first()[0] for df in (both, limits)]
    if deepest[0] is None or deepest[0] != deepest[1]:
        raise ValueError("the area lies outside what the source covers")
    return both


def checked_area(west: float, south: float, east: float, north: float) -> tuple[float, float, float, float]:
    """The area as it came; one that runs backwards is refused by its numbers, since a coarse tile holds either way round."""
    if west >= east or south >= north:
        raise ValueError(f"an area is west, south, east, north; {west},{south},{east},{north} selects nothing")
    return west, south, east, north


def coverage(footprint: DataFrame, footprint_z: int, fetch: Fetch, low: int, high: int, done: DataFrame | None = None) -> DataFrame:
    """Answers for every tile that the footprint allows; above its zoom it is projected and dilated by a cell."""
    out = None
    for z in range(low, high + 1):
        here = eligible(footprint, footprint_z, z)
        out = here if out is None else out.unionByName(here)
    return settled(fetch(out if done is None else relations.todo(out, done)))


def complete(answers: DataFrame) -> bool:
    """Whether a coverage crawl may mark its zooms as done: nothing failed."""
    return answers.where("status = 'err'").isEmpty()


def masked(seed: DataFrame, fetch: Fetch, low: int, high: int, side: int = 32, limits: DataFrame | None = None) -> DataFrame:
    """Content tiles of a crawl that follows alpha masks.

    ``fetch`` answers content (with ``data``), placeholder, outside or err.
    Content sets the mask for what lies below, a placeholder hands its own
    down (but for the first zoom, where only content is followed), outside
    prunes, and a child is asked for if its quarter of the mask is not empty and
    it lies inside the limits. ``seed`` has ``z, x, y, mask``
    (packed bits).
    """
    found, ask = None, clipped(seed, limits)
    for z in range(low, high + 1):
        got = fetch(ask.select(*KEYS)).join(ask, KEYS).where("status = 'content'" if z == low else "status IN ('content', 'placeholder')")
        got = got.withColumn("mask", F.when(F.col("status") == "content", r.alpha_mask(F.col("data"), side)).otherwise(F.col("mask")))
        got = settled(got.select(*KEYS, "status", "mask"))
        content = got.where("status = 'content'").select(*KEYS)
        found = content if found is None else found.unionByName(content)
        four = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dy in (0, 1) for dx in (0, 1)])
        child = got.select("z", "x", "y", "mask", F.explode(four).alias("c"))
        child = child.withColumn("mask", r.quadrant_mask(F.col("mask"), F.col("c.dx"), F.col("c.dy"), F.lit(side))).where("mask IS NOT NULL")
        child = child.select((F.col("z") + 1).alias("z"), (F.col("x") * 2 + F.col("c.dx")).alias("x"), (F.col("y") * 2 + F.col("c.dy")).alias("y"), "mask")
        ask = settled(clipped(child, limits))
    return found


def retried(answers: DataFrame, fetch: Fetch, rounds: int = 3) -> DataFrame:
    """Answers with the failed ones asked again, at most ``rounds`` times; whatever is no error counts as resolved."""
    good = answers.where("status <> 'err'")
    bad = answers.where("status = 'err'").select(*KEYS)
    for _ in range(rounds):
        if bad.isEmpty():
            break
        again = settled(fetch(bad))
        good = good.unionByName(again.where("status <> 'err'"), allowMissingColumns=True)
        bad = again.where("status = 'err'").select(*KEYS)
    return good.unionByName(bad.withColumn("status", F.lit("err")), allowMissingColumns=True)


def repaired(stored: DataFrame, wanted: DataFrame, fetch: Fetch, rounds: int = 3) -> DataFrame:
    """Answers for the wanted tiles that are not stored."""
    return retried(settled(fetch(relations.todo(wanted, stored))), fetch, rounds)


class Implausible(ValueError):
    """A footprint that can't be right."""


def footprint_cells(samples: DataFrame, width: int, height: int, over: int, low: float = 0.02, high: float = 0.95) -> DataFrame:
    """Footprint cells from a rendered coverage (``px, py, a``; ``over`` pixels a cell), max-pooled, checked and dilated by a cell."""
    pooled = samples.groupBy(F.floor(F.col("px") / over).cast("int").alias("x"), F.floor(F.col("py") / over).cast("int").alias("y")).agg(F.max("a").alias("a"))
    on = settled(pooled.where("a > 0").select("x", "y"))
    s = on.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("x") == 0) | (F.col("y") == 0) | (F.col("x") == width - 1) | (F.col("y") == height - 1)).alias("edge")).first()
    if not low < s["n"] / (width * height) < high:
        raise Implausible(f"{s['n']} of {width * height} cells are covered")
    if s["edge"]:
        raise Implausible("the coverage touches the edge of the extent, which may crop it")
    return grid.dilated(on, width=width, height=height)


def check_options(mode: str, source: str, repair: bool = False, refresh: bool = False, report: bool = False, footprint_z: int = 11, over: int = 16, conditional: bool = True, errors_outside: bool = True) -> None:
    """Refuses combinations that would crawl wrongly."""
    rules = [
        (mode == "coverage" and source != "extent", "coverage needs a source with an extent"),
        (mode in ("mask", "descent") and not errors_outside, f"{mode} prunes on answers that this source doesn't give"),
        (repair and refresh, "repair and refresh exclude each other"),
        (refresh and not conditional, "refresh needs conditional requests"),
        (report and not refresh, "a report is one of a refresh"),
        (not 6 <= footprint_z <= 14, "the footprint's zoom is 6 to 14"),
        (not 1 <= over <= 64, "1 to 64 samples a cell"),
    ]
    for bad, why in rules:
        if bad:
            raise ValueError(why)
