"""Joins, upserts and set operations on tile keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import grid, relations as r
from ..session import table
from . import bindings as b


def todo_tiles(spark, sf_dir):
    ot = b.order_tiles(spark, sf_dir)
    stored, errors = ot.where("o_custkey % 3 = 0").select("z", "x", "y"), ot.where("o_custkey % 7 = 0").select("z", "x", "y")
    return r.todo(b.tiles(spark, sf_dir), stored, errors)


def footprint_semi(spark, sf_dir):
    return grid.within_footprint(b.tiles(spark, sf_dir).where(F.col("z") >= b.COVER), b.footprint(spark, sf_dir), b.COVER)


def _versions(spark, sf_dir):
    ot = b.order_tiles(spark, sf_dir).where("z = 9")
    pick = lambda m, k: ot.where(f"o_custkey % {m} = {k}").groupBy("z", "x", "y").agg(F.max("o_orderkey").alias("v"))
    return pick(4, 0), pick(3, 0)


_SQL_VERSIONS = f"WITH {b.SQL_ORDER_TILES}, o AS (SELECT z, x, y, max(o_orderkey) AS v FROM ot WHERE z = 9 AND o_custkey % 4 = 0 GROUP BY ALL), n AS (SELECT z, x, y, max(o_orderkey) AS v FROM ot WHERE z = 9 AND o_custkey % 3 = 0 GROUP BY ALL) "


def insert_missing(spark, sf_dir):
    return r.insert_missing(*_versions(spark, sf_dir))


def replace_tiles(spark, sf_dir):
    return r.replace(*_versions(spark, sf_dir))


def delete_tiles(spark, sf_dir):
    return r.without(*_versions(spark, sf_dir))


def full_coverage_diff(spark, sf_dir):
    ot = b.order_tiles(spark, sf_dir)
    return r.difference_report(ot.where("o_custkey % 10 <> 1"), ot.where("o_custkey % 10 <> 2"))


def chunk_symmetric_difference(spark, sf_dir):
    ot = b.order_tiles(spark, sf_dir).where("z = 9")
    return r.symmetric_difference(ot.where("o_custkey % 4 <> 1").select("x", "y").distinct(), ot.where("o_custkey % 4 <> 2").select("x", "y").distinct())


def fill_gaps(spark, sf_dir):
    ot = b.order_tiles(spark, sf_dir)
    made = ot.where("o_custkey % 3 = 0").groupBy("z", "x", "y").agg(F.lit("made").alias("origin"))
    original = ot.groupBy("z", "x", "y").agg(F.lit("original").alias("origin"))
    return r.filled(made, original, 7, 10)


def copy_through(spark, sf_dir):
    return r.kept_levels(b.tiles(spark, sf_dir), 7, 10)


def metadata_merge(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    new = F.create_map(F.lit("segment"), F.concat(F.lit("seg-"), F.lower("c_mktsegment")), F.lit("nation"), F.col("c_nationkey").cast("string"))
    m = c.select("c_custkey", r.merged_metadata(old, new).alias("m"))
    return m.select("c_custkey", F.explode("m").alias("name", "value"))


def newest_edition(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("layer"), F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), F.col("o_orderkey").cast("string")).alias("filename"))
    return r.newest(o, "layer", "filename")


def keyset_page(spark, sf_dir):
    t = b.tiles(spark, sf_dir).where("z = 10")
    return r.page(t.select("x", "y"), ["x", "y"], [570, 290], 200)


def sampled_tiles(spark, sf_dir):
    return r.sample(b.tiles(spark, sf_dir).where("z = 11"), 100, "s", "z", "x", "y")


def sampled_with_replacement(spark, sf_dir):
    f = r.numbered(b.footprint(spark, sf_dir), "x", "y")
    n = f.count()
    return r.picks(spark, 400, "7", F.lit(max(n, 1))).join(f, "at").select("pick", "x", "y")


def repeated_layers(spark, sf_dir):
    return r.repeated(table(spark, sf_dir, "supplier").select(F.concat(F.lit("layer-"), (F.col("s_suppkey") % 37).cast("string")).alias("layer")), "layer")


def disambiguated_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("stem"))
    return r.disambiguated(p, "stem", "pos")


def retired_files(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("layer"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("edition"), F.col("o_orderkey").alias("filename"))
    plan = o.groupBy("layer").agg(F.max("edition").alias("edition"))
    return r.retired(o, plan, o.where("filename % 10 = 0"))


def candidates_by_parent(spark, sf_dir):
    """Children of stored tiles, cut to a rectangle: the next zoom's candidates."""
    stored = b.status(b.tiles(spark, sf_dir).where("z = 9")).where("status = 'ok'").select("z", "x", "y")
    return g.children(stored).where(F.col("x").between(570, 590) & F.col("y").between(250, 300)).distinct()


def novelty_pairs(spark, sf_dir):
    """Children with their parents; children without one drop out."""
    ot = b.order_tiles(spark, sf_dir)
    child, parent = ot.where("z = 11").select("x", "y").distinct(), ot.where("z = 10 AND o_custkey % 2 = 0").select(F.col("x").alias("px"), F.col("y").alias("py")).distinct()
    keyed = child.withColumns({"px": g.ancestor(F.col("x"), 1), "py": g.ancestor(F.col("y"), 1)})
    return keyed.join(parent, ["px", "py"]).select("x", "y", "px", "py", g.quadrant(F.col("x"), F.col("y")).alias("quadrant"))


def box_class_report(spark, sf_dir):
    """Per area how many of its cells the footprint holds, and the class that follows."""
    k = F.col("n_nationkey")
    areas = table(spark, sf_dir, "nation").select(k.alias("area"), (k * 0.4 + 18).alias("west"), (k * 0.2 + 59).alias("south"), (k * 0.4 + 20).alias("east"), (k * 0.2 + 61).alias("north"))
    cells = g.cells(g.rectangles(areas, b.COVER, b.COVER), ["area"])
    n = cells.join(b.footprint(spark, sf_dir).withColumn("hit", F.lit(1)), ["x", "y"], "left").groupBy("area").agg(F.count(F.lit(1)).alias("cells"), F.count("hit").alias("covered"))
    return n.withColumn("class", F.when(F.col("covered") == 0, "outside").when(F.col("covered") == F.col("cells"), "inside").otherwise("straddle"))


W = f"WITH {b.SQL_TILES} "
QUERIES = {
    "todo_tiles": (todo_tiles, W + "SELECT * FROM t WHERE (z, x, y) NOT IN (SELECT (z, x, y) FROM ot WHERE o_custkey % 3 = 0 OR o_custkey % 7 = 0)"),
    "footprint_semi": (footprint_semi, W + f", {b.SQL_FOOTPRINT} SELECT z, x, y FROM t WHERE z >= {b.COVER} AND (x >> (z - {b.COVER}), y >> (z - {b.COVER})) IN (SELECT (x, y) FROM f)"),
    "insert_missing": (insert_missing, _SQL_VERSIONS + "SELECT * FROM o UNION ALL SELECT * FROM n WHERE (z, x, y) NOT IN (SELECT (z, x, y) FROM o)"),
    "replace_tiles": (replace_tiles, _SQL_VERSIONS + "SELECT * FROM n UNION ALL SELECT * FROM o WHERE (z, x, y) NOT IN (SELECT (z, x, y) FROM n)"),
    "delete_tiles": (delete_tiles, _SQL_VERSIONS + "SELECT * FROM o WHERE (z, x, y) NOT IN (SELECT (z, x, y) FROM n)"),
    "full_coverage_diff": (
        full_coverage_diff,
        W + "SELECT z, count(*) FILTER (a AND b) AS shared, count(*) FILTER (a AND NOT b) AS missed, count(*) FILTER (b AND NOT a) AS extra FROM (SELECT z, x, y, bool_or(o_custkey % 10 <> 1) AS a, bool_or(o_custkey % 10 <> 2) AS b FROM ot GROUP BY ALL) GROUP BY z",
    ),
    "chunk_symmetric_difference": (
        chunk_symmetric_difference,
        W + "SELECT x, y FROM (SELECT x, y, bool_or(o_custkey % 4 <> 1) AS a, bool_or(o_custkey % 4 <> 2) AS b FROM ot WHERE z = 9 GROUP BY ALL) WHERE a <> b",
    ),
    "fill_gaps": (
        fill_gaps,
        W + "SELECT z, x, y, CASE WHEN m THEN 'made' ELSE 'original' END AS origin FROM (SELECT z, x, y, bool_or(o_custkey % 3 = 0) AS m FROM ot GROUP BY ALL) WHERE m OR z >= 7 AND z < 10",
    ),
    "copy_through": (copy_through, W + "SELECT * FROM t WHERE z >= 10 OR z < 7"),
    "metadata_merge": (
        metadata_merge,
        "SELECT c_custkey, unnest(['name', 'segment', 'nation']) AS name, unnest([c_name, 'seg-' || lower(c_mktsegment), c_nationkey::VARCHAR]) AS value FROM customer",
    ),
    "newest_edition": (newest_edition, "SELECT o_custkey AS layer, max(strftime(o_orderdate, '%Y-%m-%d') || '-' || o_orderkey::VARCHAR) AS filename FROM orders GROUP BY 1"),
    "keyset_page": (keyset_page, W + "SELECT x, y FROM t WHERE z = 10 AND (x, y) > (570, 290) ORDER BY x, y LIMIT 200"),
    "sampled_tiles": (sampled_tiles, W + "SELECT * FROM t WHERE z = 11 ORDER BY md5('s,' || z::VARCHAR || ',' || x::VARCHAR || ',' || y::VARCHAR), z, x, y LIMIT 100"),
    "sampled_with_replacement": (
        sampled_with_replacement,
        W + f", {b.SQL_FOOTPRINT}, n AS (SELECT x, y, row_number() OVER (ORDER BY x, y) - 1 AS place, count(*) OVER () AS total FROM f), k AS (SELECT i::BIGINT AS pick, ('0x' || md5('7,' || i::VARCHAR)[1:8])::BIGINT AS draw FROM range(400) AS r(i)) SELECT pick, x, y FROM k JOIN n ON draw % total = place",
    ),
    "repeated_layers": (repeated_layers, "SELECT 'layer-' || (s_suppkey % 37)::VARCHAR AS layer, count(*) AS n FROM supplier GROUP BY 1 HAVING count(*) > 1"),
    "disambiguated_names": (
        disambiguated_names,
        "SELECT pos, stem, CASE WHEN n = 1 THEN stem ELSE stem || '-' || n::VARCHAR END AS name FROM (SELECT p_partkey AS pos, lower(replace(p_brand, '#', '-')) AS stem, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)",
    ),
    "retired_files": (
        retired_files,
        "SELECT layer, edition, filename FROM (SELECT DISTINCT o_custkey AS layer, strftime(o_orderdate, '%Y-%m-%d') AS edition, o_orderkey AS filename, max(strftime(o_orderdate, '%Y-%m-%d')) OVER (PARTITION BY o_custkey) AS latest FROM orders) WHERE edition < latest AND filename % 10 <> 0",
    ),
    "candidates_by_parent": (
        candidates_by_parent,
        W + f"SELECT DISTINCT 10 AS z, (2 * x + dx)::INTEGER AS x, (2 * y + dy)::INTEGER AS y FROM t, range(2) AS i(dx), range(2) AS j(dy) WHERE z = 9 AND {b.SQL_STATUS} = 'ok' AND 2 * x + dx BETWEEN 570 AND 590 AND 2 * y + dy BETWEEN 250 AND 300",
    ),
    "novelty_pairs": (
        novelty_pairs,
        W + "SELECT c.x, c.y, (c.x >> 1)::INTEGER AS px, (c.y >> 1)::INTEGER AS py, (c.x % 2 + c.y % 2 * 2)::INTEGER AS quadrant FROM t c JOIN (SELECT DISTINCT x, y FROM ot WHERE z = 10 AND o_custkey % 2 = 0) p ON c.x >> 1 = p.x AND c.y >> 1 = p.y WHERE c.z = 11",
    ),
    "box_class_report": (
        box_class_report,
        f"""WITH {b.SQL_ORDER_TILES}, {b.SQL_FOOTPRINT}, r AS (
  SELECT area, {b.SQL_X.replace('lon', 'west')} AS x0, {b.SQL_X.replace('lon', 'east')} AS x1, {b.SQL_Y.replace('lat', 'north')} AS y0, {b.SQL_Y.replace('lat', 'south')} AS y1
  FROM (SELECT n_nationkey AS area, n_nationkey * 0.4e0 + 18 AS west, n_nationkey * 0.2e0 + 59 AS south, n_nationkey * 0.4e0 + 20 AS east, n_nationkey * 0.2e0 + 61 AS north, {b.COVER} AS z FROM nation)
), n AS (SELECT area, count(*) AS cells, count(f.x) AS covered FROM r, unnest(range(x0, x1 + 1)) AS i(cx), unnest(range(y0, y1 + 1)) AS j(cy) LEFT JOIN f ON f.x = cx AND f.y = cy GROUP BY area)
SELECT area, cells, covered, CASE WHEN covered = 0 THEN 'outside' WHEN covered = cells THEN 'inside' ELSE 'straddle' END AS class FROM n""",
    ),
}
