"""Neighbour joins, walks, peels and descents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import grid
from ..plans import crawl
from . import bindings as b


def classified_cells(spark, sf_dir):
    return b.cells(spark, sf_dir).groupBy("marked").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"))


def neighbour_counts(spark, sf_dir):
    c = b.cells(spark, sf_dir)
    return grid.neighbour_counts(c, c.where("marked"))


def walk_outside(spark, sf_dir):
    return grid.outside(b.cells(spark, sf_dir))


def peel_blank(spark, sf_dir):
    return grid.held(b.cells(spark, sf_dir))


def edge_tiles(spark, sf_dir):
    c = b.cells(spark, sf_dir)
    return grid.edge_tiles(c.select("x", "y", F.col("marked").alias("chart"), (F.col("q") % 3).alias("fill"))).select("x", "y", F.array_join("sides", ",").alias("sides"))


def unreached_solid(spark, sf_dir):
    c = b.cells(spark, sf_dir)
    return grid.unreached(c.where("marked AND q % 3 = 0"), grid.facing(c.where("q % 3 = 0"), grid.outside(c)))


def dilated_footprint(spark, sf_dir):
    return grid.dilated(b.footprint(spark, sf_dir), width=150, height=80)


def footprint_levels(spark, sf_dir):
    return grid.footprint_levels(b.footprint(spark, sf_dir), b.COVER, 3)


def leaf_bounds(spark, sf_dir):
    t = b.order_tiles(spark, sf_dir).where("z >= 9 AND (z < 11 OR o_custkey % 4 = 0)").select("z", "x", "y").distinct()
    return grid.leaf_bounds(t).select(*[F.round(c, 7).alias(c) for c in ("west", "south", "east", "north")])


def _answers(spark, sf_dir):
    """What a made-up service answers for every tile that it has."""
    return b.status(b.tiles(spark, sf_dir))


def descent(spark, sf_dir):
    """Zoom by zoom: children of what had content."""
    fetch = crawl.from_table(_answers(spark, sf_dir))
    seed = b.tiles(spark, sf_dir).where(F.col("z") == b.LOW)
    return crawl.descent(seed, fetch, b.LOW, b.HIGH)


def resumed_descent(spark, sf_dir):
    """A descent that goes on where an earlier one stopped that stored a part of the upper zooms: it finds the rest."""
    fetch = crawl.from_table(_answers(spark, sf_dir))
    seed = b.tiles(spark, sf_dir).where(F.col("z") == b.LOW)
    done = crawl.descent(seed, fetch, b.LOW, b.COVER).where("(x + y) % 4 = 0")
    return crawl.descent(seed, fetch, b.LOW, b.HIGH, done)


def fill_flood(spark, sf_dir):
    """An 8-connected flood at one zoom from the footprint's centres, within the footprint, from content to content."""
    fetch = crawl.from_table(_answers(spark, sf_dir))
    f = b.footprint(spark, sf_dir)
    seeds = f.select(F.lit(b.COVER + 2).alias("z"), g.footprint_centre(F.col("x"), 2).alias("x"), g.footprint_centre(F.col("y"), 2).alias("y"))
    return crawl.flood(seeds, fetch, f, b.COVER)


def coverage_requests(spark, sf_dir):
    """Requests that the footprint leaves at each zoom, and what enumerating would ask."""
    f = b.footprint(spark, sf_dir)
    fetch = crawl.from_table(_answers(spark, sf_dir))
    return crawl.coverage(f, b.COVER, fetch, b.LOW, 10).groupBy("z").agg(F.count(F.lit(1)).alias("requested"), F.count_if(F.col("status") == "ok").cast("long").alias("ok"))


W = f"WITH {b.SQL_TILES} "
C = f"WITH {b.SQL_CELLS}"
R = f"WITH RECURSIVE {b.SQL_CELLS}, {b.SQL_SIDES}, {b.SQL_AROUND}, {b.SQL_BOX}, {b.SQL_WALK}"
D = f"WITH RECURSIVE {b.SQL_TILES}, "
_FACING = "h AS (SELECT c.x, c.y, string_agg(side, ',' ORDER BY side) AS sides FROM c, a WHERE q % 3 > 0 AND EXISTS (SELECT 1 FROM w WHERE w.x = c.x + dx AND w.y = c.y + dy) GROUP BY c.x, c.y)"
_LEVELS = f"u AS (SELECT DISTINCT ({b.COVER} - s)::INTEGER AS z, x >> s AS x, y >> s AS y FROM f, range(0, {b.COVER - 2}) AS r(s))"
QUERIES = {
    "classified_cells": (classified_cells, C + " SELECT marked, count(*) AS n, sum(q)::BIGINT AS q FROM c GROUP BY marked"),
    "neighbour_counts": (neighbour_counts, C + f", {b.SQL_SIDES} SELECT c.x, c.y, count(o.x) AS n FROM c CROSS JOIN s LEFT JOIN c o ON o.marked AND o.x = c.x + dx AND o.y = c.y + dy GROUP BY c.x, c.y"),
    "walk_outside": (walk_outside, R + " SELECT x, y FROM w"),
    "peel_blank": (
        peel_blank,
        f"""WITH RECURSIVE {b.SQL_CELLS}, {b.SQL_SIDES}, r(i, x, y, m) AS (
  SELECT 0, x, y, marked FROM c
  UNION ALL
  SELECT i + 1, x, y, m FROM (
    SELECT r.i, r.x, r.y, r.m, count(n.x) AS k FROM r CROSS JOIN s LEFT JOIN r n ON n.x = r.x + dx AND n.y = r.y + dy GROUP BY ALL
  ) WHERE i < 80 AND (m OR k > 2)
) SELECT x, y FROM r WHERE i = 80 AND NOT m""",
    ),
    "edge_tiles": (edge_tiles, R + f", {_FACING} SELECT x, y, sides FROM h"),
    "unreached_solid": (
        unreached_solid,
        R + " SELECT x, y FROM c WHERE marked AND q % 3 = 0 AND NOT EXISTS (SELECT 1 FROM w, a WHERE w.x = c.x + dx AND w.y = c.y + dy)",
    ),
    "dilated_footprint": (dilated_footprint, W + f", {b.SQL_FOOTPRINT} SELECT DISTINCT (x + dx)::INTEGER AS x, (y + dy)::INTEGER AS y FROM f, range(-1, 2) AS i(dx), range(-1, 2) AS j(dy) WHERE x + dx BETWEEN 0 AND 149 AND y + dy BETWEEN 0 AND 79"),
    "footprint_levels": (footprint_levels, W + f", {b.SQL_FOOTPRINT}, {_LEVELS} SELECT DISTINCT z, (x + dx)::INTEGER AS x, (y + dy)::INTEGER AS y FROM u, range(-1, 2) AS i(dx), range(-1, 2) AS j(dy) WHERE z >= 3"),
    "leaf_bounds": (
        leaf_bounds,
        W + """, k AS (SELECT DISTINCT z, x, y FROM ot WHERE z >= 9 AND (z < 11 OR o_custkey % 4 = 0)), l AS (SELECT * FROM k WHERE (z, x, y) NOT IN (SELECT (z - 1, x >> 1, y >> 1) FROM k))
SELECT round(min(x / (1 << z) * 360 - 180), 7) AS west, round(min(degrees(atan(sinh(pi() * (1 - 2 * (y + 1) / (1 << z)))))), 7) AS south,
       round(max((x + 1) / (1 << z) * 360 - 180), 7) AS east, round(max(degrees(atan(sinh(pi() * (1 - 2 * y / (1 << z)))))), 7) AS north FROM l""",
    ),
    "descent": (
        descent,
        D + f"""d(z, x, y, status) AS (
  SELECT z, x, y, {b.SQL_STATUS} FROM t WHERE z = {b.LOW}
  UNION
  SELECT t.z, t.x, t.y, (CASE WHEN (t.x * 7 + t.y * 3 + t.z) % 11 = 0 THEN 'err' WHEN (t.x * 5 + t.y + t.z) % 3 = 0 THEN 'empty' ELSE 'ok' END)
  FROM d JOIN t ON t.z = d.z + 1 AND t.x >> 1 = d.x AND t.y >> 1 = d.y WHERE d.status = 'ok'
) SELECT z, x, y FROM d WHERE status = 'ok'""",
    ),
    "resumed_descent": (
        resumed_descent,
        D + f"""s AS (SELECT z, x, y, {b.SQL_STATUS} AS status FROM t), d(z, x, y, status) AS (
  SELECT z, x, y, status FROM s WHERE z = {b.LOW}
  UNION
  SELECT s.z, s.x, s.y, s.status FROM d JOIN s ON s.z = d.z + 1 AND s.x >> 1 = d.x AND s.y >> 1 = d.y WHERE d.status = 'ok'
) SELECT z, x, y FROM d WHERE status = 'ok' AND NOT (z <= {b.COVER} AND (x + y) % 4 = 0)""",
    ),
    "fill_flood": (
        fill_flood,
        D + f"""{b.SQL_FOOTPRINT}, {b.SQL_AROUND}, k AS (SELECT x, y FROM t WHERE z = {b.COVER + 2} AND {b.SQL_STATUS} = 'ok'), g(x, y) AS (
  SELECT (x << 2) + 2, (y << 2) + 2 FROM f
  UNION
  SELECT g.x + dx, g.y + dy FROM g JOIN k ON k.x = g.x AND k.y = g.y, a WHERE ((g.x + dx) >> 2, (g.y + dy) >> 2) IN (SELECT (x, y) FROM f)
) SELECT {b.COVER + 2} AS z, k.x, k.y FROM g JOIN k ON k.x = g.x AND k.y = g.y""",
    ),
    "coverage_requests": (
        coverage_requests,
        W + f""", {b.SQL_FOOTPRINT}, up AS (SELECT DISTINCT ({b.COVER} - s)::INTEGER AS z, x >> s AS x, y >> s AS y FROM f, range(1, {b.COVER - b.LOW + 1}) AS r(s)),
e AS (SELECT DISTINCT z, x + dx AS x, y + dy AS y FROM up, range(-1, 2) AS i(dx), range(-1, 2) AS j(dy)
  UNION ALL SELECT ({b.COVER} + s)::INTEGER, (x << s) + dx, (y << s) + dy FROM f, range(0, {10 - b.COVER + 1}) AS r(s), range(0, 1 << s) AS i(dx), range(0, 1 << s) AS j(dy))
SELECT e.z, count(*) AS requested, count(*) FILTER (t.x IS NOT NULL AND (CASE WHEN (t.x * 7 + t.y * 3 + t.z) % 11 = 0 THEN 'err' WHEN (t.x * 5 + t.y + t.z) % 3 = 0 THEN 'empty' ELSE 'ok' END) = 'ok') AS ok
FROM e LEFT JOIN t ON t.z = e.z AND t.x = e.x AND t.y = e.y GROUP BY e.z""",
    ),
}
