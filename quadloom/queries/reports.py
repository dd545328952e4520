"""Counts, extents, estimates, refresh routing and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import summary
from ..plans import decide, refresh, verify
from ..session import table
from . import bindings as b


def level_counts(spark, sf_dir):
    return summary.levels(b.tiles(spark, sf_dir))


def totals(spark, sf_dir):
    return summary.totals(b.tiles(spark, sf_dir))


def status_report(spark, sf_dir):
    return summary.status_report(b.status(b.tiles(spark, sf_dir)), *b.STATES)


def centre_tile(spark, sf_dir):
    return summary.centre(b.tiles(spark, sf_dir))


def byte_counts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    k = F.col("page_id") % 7
    return p.groupBy(k.cast("int").alias("z")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).cast("long").alias("bytes"))


def _events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    return e.withColumn("status", F.when(t.isin("view", "purchase"), "ok").when(t == "signup", "empty").when(t == "error", "err").otherwise("notmodified"))


_SQL_EVENTS = "e AS (SELECT *, CASE WHEN event_type IN ('view', 'purchase') THEN 'ok' WHEN event_type = 'signup' THEN 'empty' WHEN event_type = 'error' THEN 'err' ELSE 'notmodified' END AS status FROM events)"


def refresh_report(spark, sf_dir):
    return refresh.report(_events(spark, sf_dir))


def refresh_by_day(spark, sf_dir):
    routed = _events(spark, sf_dir).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), refresh.route(F.col("status")).alias("action"))
    return routed.groupBy("day", "action").agg(F.count(F.lit(1)).alias("n"))


def _answers(spark, sf_dir):
    """The last answer for each place."""
    e = _events(spark, sf_dir).select(F.lit(9).alias("z"), (F.col("user_id") % 64).cast("int").alias("x"), (F.col("user_id") % 48).cast("int").alias("y"), "status", F.col("event_id").alias("data"))
    return e.groupBy("z", "x", "y").agg(F.max_by(F.struct("status", "data"), "data").alias("a")).select("z", "x", "y", "a.*")


_SQL_ANSWERS = f"{_SQL_EVENTS}, n AS (SELECT 9 AS z, (user_id % 64)::INTEGER AS x, (user_id % 48)::INTEGER AS y, arg_max(status, event_id) AS status, max(event_id) AS data FROM e GROUP BY ALL)"


def refresh_applied(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.lit(9).alias("z"), (F.col("c_custkey") % 64).cast("int").alias("x"), (F.col("c_custkey") % 48).cast("int").alias("y"), (-F.col("c_custkey")).alias("tile_data"))
    old = old.groupBy("z", "x", "y").agg(F.min("tile_data").alias("tile_data"))
    return refresh.applied(old, _answers(spark, sf_dir))


def retry_queue(spark, sf_dir):
    queue = table(spark, sf_dir, "supplier").select(F.lit(9).alias("z"), (F.col("s_suppkey") % 64).cast("int").alias("x"), (F.col("s_suppkey") % 48).cast("int").alias("y"))
    return refresh.failed(queue, _answers(spark, sf_dir))


def edition_extent(spark, sf_dir):
    e = _events(spark, sf_dir).where("status <> 'err'").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return summary.edition_extent(e, ("2024-01-15", None), "user_id")


def cost_estimate(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select((F.col("page_id") % 5 + 11).cast("int").alias("z"), F.when(F.col("page_id") % 3 == 0, 0).otherwise(F.octet_length("html")).alias("bytes"))
    implied = spark.range(11, 16).select(F.col("id").cast("int").alias("z"), (F.shiftleft(F.lit(1).cast("long"), 10) * (F.col("id") - 9)).alias("tiles"))
    c = summary.cost(p, implied, 8.0)
    return c.select("z", "sampled", "hits", *[F.round(c, n).alias(c) for c, n in (("mean", 6), ("sd", 6), ("rate", 9), ("error", 9), ("bytes", 3), ("hours", 9), ("running_bytes", 3))])


def novelty_levels(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("z"), (F.col("value") / 5000).alias("novelty"), (F.col("user_id") % 3 == 0).cast("double").alias("same"))
    out = summary.novelty_levels(e)
    return out.select("z", "n", *[F.round(c, 9).alias(c) for c in ("median", "mean", "p90", "same")], "verdict")


def native_zoom(spark, sf_dir):
    o = b.order_tiles(spark, sf_dir).groupBy("z").agg(F.median(F.col("o_totalprice") / F.pow(F.lit(4.0), F.col("z")) / 100).alias("m"))
    return summary.native_zoom(o.select("z", summary.verdict(F.col("m")).alias("verdict")), b.LOW)


def novelty_extremes(spark, sf_dir):
    s = b.order_tiles(spark, sf_dir).groupBy("z", "x", "y").agg(F.min("o_totalprice").alias("novelty"))
    e = summary.extremes(s)
    return e.select("z", F.col("low.x").alias("low_x"), F.col("low.y").alias("low_y"), F.col("low.novelty").alias("low"), F.col("high.x").alias("high_x"), F.col("high.y").alias("high_y"), F.col("high.novelty").alias("high"))


def savings(spark, sf_dir):
    s = b.status(b.tiles(spark, sf_dir)).groupBy("z").agg(F.count_if(F.col("status") == "ok").alias("asked"), F.count(F.lit(1)).alias("n"))
    return s.select("z", F.round(summary.saved_percent(F.col("asked"), F.col("n")), 9).alias("saved"))


def top_missed(spark, sf_dir):
    ot = b.order_tiles(spark, sf_dir)
    return verify.first_missed(ot, ot.where("o_custkey % 10 <> 2 OR z < 8"), 5).select("z", "x", "y", F.col("rank").cast("long").alias("rank"))


def box_verdicts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    relation = F.element_at(F.array(F.lit("inside"), F.lit("straddle"), F.lit("outside")), (k % 3 + 1).cast("int"))
    return c.select("c_custkey", verify.box_verdict(relation, (k % 19 == 0).cast("int"), k % 7, k % 5, F.lit(3), k % 4, k % 6 - 3).alias("verdict"))


def footprint_checks(spark, sf_dir):
    f = b.footprint(spark, sf_dir)
    fine = b.order_tiles(spark, sf_dir).where("z = 10 AND o_custkey % 5 < 2").select("x", "y").distinct()
    return verify.footprint_checks(f, f.where("x % 9 <> 0"), fine, 2).select("chunking", "uncontained", F.round("slack", 9).alias("slack"), "ok")


def rebuild_reason(spark, sf_dir):
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("s"), F.count(F.lit(1)).alias("n"))
    c = table(spark, sf_dir, "customer").join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    k = F.col("c_custkey")
    day = F.date_format("d", "yyyy-MM-dd")
    why = decide.reason(
        k % 50 == 0, F.when(F.col("n").isNotNull(), F.lit("file")), (day, F.when(k % 3 > 0, day).otherwise("2020-01-01")), (F.col("s"), F.when(k % 5 > 0, F.col("s"))), (F.lit(12), F.when(k % 7 > 1, 12).when(k % 7 == 1, 11)), (k % 4, k % 8)
    )
    return c.select("c_custkey", why.alias("reason"))


def build_findings(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    text = lambda v: v.cast("string")
    meta = F.create_map(
        F.lit("source_layer"), F.col("c_name"), F.lit("source_updated"), F.when(k % 11 > 0, "2026-06-02").otherwise(""), F.lit("bounds"), F.lit("1,2,3,4"), F.lit("minzoom"), F.lit("3"),
        F.lit("maxzoom"), F.when(k % 13 > 0, "15"), F.lit("nodata_stripped"), F.when(k % 5 > 0, F.lit("r128")), F.lit("downscale_source_zoom"), text(12 + F.when(k % 9 == 0, 1).otherwise(0)),
    )
    builds = c.select(F.col("c_custkey").alias("layer"), (k % 100).alias("tiles"), (k % 60 + 1).alias("baseline"), meta.alias("metadata"), F.lit("r128").alias("stamp"), F.lit(12).alias("zoom"))
    return decide.findings(builds).select("layer", F.array_join("problems", "; ").alias("problems"))


def tile_loss(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.where(summary.too_few(F.col("c_acctbal"), F.lit(2000.0))).select("c_custkey")


def listing_totals(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


W = f"WITH {b.SQL_TILES} "
QUERIES = {
    "level_counts": (level_counts, W + "SELECT z, count(*) AS n FROM t GROUP BY z"),
    "totals": (totals, W + "SELECT count(DISTINCT z) AS levels, count(*) AS tiles FROM t"),
    "status_report": (
        status_report,
        W + f", s AS (SELECT z, {b.SQL_STATUS} AS status FROM t) SELECT z, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'empty') AS empty, count(*) FILTER (status = 'err') AS err, count(*) AS requested FROM s GROUP BY ROLLUP (z)",
    ),
    "centre_tile": (
        centre_tile,
        W + ", n AS (SELECT z, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM t GROUP BY z), k AS (SELECT coalesce(min(z) FILTER (n >= 16), max(z)) AS z FROM n) SELECT t.z, t.x, t.y FROM t JOIN n USING (z) JOIN k USING (z) ORDER BY (t.x - mx) * (t.x - mx) + (t.y - my) * (t.y - my), t.x, t.y LIMIT 1",
    ),
    "byte_counts": (byte_counts, "SELECT (page_id % 7)::INTEGER AS z, count(*) AS n, coalesce(sum(octet_length(encode(html))), 0)::BIGINT AS bytes FROM pages GROUP BY 1"),
    "refresh_report": (refresh_report, f"WITH {_SQL_EVENTS} SELECT count(*) AS checked, count(*) FILTER (status = 'ok') AS updated, count(*) FILTER (status = 'empty') AS removed, count(*) FILTER (status = 'err') AS errors FROM e"),
    "refresh_by_day": (
        refresh_by_day,
        f"WITH {_SQL_EVENTS} SELECT strftime(ts, '%Y-%m-%d') AS day, CASE status WHEN 'ok' THEN 'updated' WHEN 'empty' THEN 'removed' WHEN 'err' THEN 'errors' ELSE 'unchanged' END AS action, count(*) AS n FROM e GROUP BY ALL",
    ),
    "refresh_applied": (
        refresh_applied,
        f"""WITH {_SQL_ANSWERS}, o AS (SELECT 9 AS z, (c_custkey % 64)::INTEGER AS x, (c_custkey % 48)::INTEGER AS y, min(-c_custkey) AS tile_data FROM customer GROUP BY ALL)
SELECT z, x, y, data AS tile_data FROM n WHERE status = 'ok' UNION ALL SELECT z, x, y, tile_data FROM o WHERE (x, y) NOT IN (SELECT (x, y) FROM n WHERE status IN ('ok', 'empty'))""",
    ),
    "retry_queue": (
        retry_queue,
        f"WITH {_SQL_ANSWERS} SELECT z, x, y FROM n WHERE status = 'err' UNION SELECT 9 AS z, (s_suppkey % 64)::INTEGER AS x, (s_suppkey % 48)::INTEGER AS y FROM supplier WHERE (s_suppkey % 64, s_suppkey % 48) NOT IN (SELECT (x, y) FROM n WHERE status <> 'err')",
    ),
    "edition_extent": (
        edition_extent,
        f"WITH {_SQL_EVENTS} SELECT user_id, greatest(max(strftime(ts, '%Y-%m-%d')), '2024-01-15') AS source_updated, min(strftime(ts, '%Y-%m-%d')) AS source_updated_oldest FROM e WHERE status <> 'err' GROUP BY user_id",
    ),
    "cost_estimate": (
        cost_estimate,
        """WITH p AS (SELECT (page_id % 5 + 11)::INTEGER AS z, CASE WHEN page_id % 3 = 0 THEN 0 ELSE octet_length(encode(html)) END AS bytes FROM pages),
s AS (SELECT z, count(*) AS sampled, count(*) FILTER (bytes > 0) AS hits, avg(bytes) FILTER (bytes > 0) AS mean, stddev_samp(bytes) FILTER (bytes > 0) AS sd FROM p GROUP BY z),
j AS (SELECT *, hits / sampled AS rate, 1024 * (z - 9) AS tiles FROM s), k AS (SELECT *, tiles * rate * mean AS b FROM j)
SELECT z, sampled, hits, round(mean, 6) AS mean, round(sd, 6) AS sd, round(rate, 9) AS rate, round(sd / mean / sqrt(hits), 9) AS error, round(b, 3) AS bytes, round(tiles / 8e0 / 3600, 9) AS hours, round(sum(b) OVER (ORDER BY z), 3) AS running_bytes FROM k""",
    ),
    "novelty_levels": (
        novelty_levels,
        """WITH s AS (SELECT event_type AS z, value / 5000 AS v, (user_id % 3 = 0)::INTEGER::DOUBLE AS same FROM events),
a AS (SELECT z, count(*) AS n, median(v) AS median, avg(v) AS mean, quantile_cont(v, 0.9) AS p90, avg(same) AS same FROM s GROUP BY z)
SELECT z, n, round(median, 9) AS median, round(mean, 9) AS mean, round(p90, 9) AS p90, round(same, 9) AS same, CASE WHEN median >= 0.03 THEN 'genuine' WHEN median < 0.01 THEN 'upscaled' ELSE 'marginal' END AS verdict FROM a""",
    ),
    "native_zoom": (native_zoom, W + f", m AS (SELECT z, median(o_totalprice / pow(4, z) / 100) AS m FROM ot GROUP BY z) SELECT coalesce(max(z) FILTER (m >= 0.01), {b.LOW})::INTEGER AS native_zoom FROM m"),
    "novelty_extremes": (
        novelty_extremes,
        W + """, s AS (SELECT z, x, y, min(o_totalprice) AS v FROM ot GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY z ORDER BY v, x, y) AS lo, row_number() OVER (PARTITION BY z ORDER BY v DESC, x DESC, y DESC) AS hi FROM s)
SELECT l.z, l.x AS low_x, l.y AS low_y, l.v AS low, h.x AS high_x, h.y AS high_y, h.v AS high FROM r l JOIN r h ON l.z = h.z AND l.lo = 1 AND h.hi = 1""",
    ),
    "savings": (savings, W + f", s AS (SELECT z, {b.SQL_STATUS} AS status FROM t) SELECT z, round(100e0 * (1 - count(*) FILTER (status = 'ok') / count(*)), 9) AS saved FROM s GROUP BY z"),
    "top_missed": (
        top_missed,
        W + ", p AS (SELECT DISTINCT z, x, y FROM ot WHERE o_custkey % 10 <> 2 OR z < 8), g AS (SELECT *, row_number() OVER (PARTITION BY z ORDER BY x, y) AS rank FROM (SELECT * FROM t EXCEPT SELECT * FROM p)) SELECT * FROM g WHERE rank <= 5",
    ),
    "box_verdicts": (
        box_verdicts,
        """WITH k AS (SELECT c_custkey, ['inside', 'straddle', 'outside'][c_custkey % 3 + 1] AS rel, c_custkey % 19 = 0 AS failed, c_custkey % 7 AS content, c_custkey % 5 AS asked, c_custkey % 4 AS missed, c_custkey % 6 - 3 AS extra FROM customer)
SELECT c_custkey, CASE WHEN failed THEN 'errors' WHEN rel = 'outside' AND asked > 0 THEN 'requests outside' WHEN rel <> 'outside' AND content = 0 THEN 'no content' WHEN rel = 'straddle' AND asked >= 3 THEN 'nothing pruned'
  WHEN rel = 'inside' AND asked < 3 THEN 'pruned inside' WHEN extra > 0 THEN 'extra' WHEN missed > 0 THEN 'missed' ELSE 'pass' END AS verdict FROM k""",
    ),
    "footprint_checks": (
        footprint_checks,
        W + f""", {b.SQL_FOOTPRINT}, u AS (SELECT DISTINCT x >> 2 AS x, y >> 2 AS y FROM ot WHERE z = 10 AND o_custkey % 5 < 2),
n AS (SELECT (SELECT count(*) FROM f WHERE x % 9 = 0) AS chunking, (SELECT count(*) FROM u WHERE (x, y) NOT IN (SELECT (x, y) FROM f)) AS uncontained, (SELECT count(*) FROM f) / (SELECT count(*) FROM u) - 1 AS slack)
SELECT chunking, uncontained, round(slack, 9) AS slack, chunking = 0 AND uncontained = 0 AND slack <= 0.25 AS ok FROM n""",
    ),
    "rebuild_reason": (
        rebuild_reason,
        """WITH l AS (SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS day, arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS s FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'forced' WHEN day IS NULL THEN 'nothing published' WHEN c_custkey % 3 = 0 AND day <> '2020-01-01' THEN 'edition 2020-01-01 -> ' || day WHEN c_custkey % 5 = 0 THEN 'other processing'
  WHEN c_custkey % 7 = 0 THEN 'never downscaled' WHEN c_custkey % 7 = 1 THEN 'other source zoom' WHEN c_custkey % 4 <> c_custkey % 8 THEN 'archive changed' END AS reason
FROM customer LEFT JOIN l ON o_custkey = c_custkey""",
    ),
    "build_findings": (
        build_findings,
        """SELECT c_custkey AS layer, concat_ws('; ', CASE WHEN c_custkey % 100 < (c_custkey % 60 + 1) * 0.5e0 THEN format('{} tiles of {} before', c_custkey % 100, c_custkey % 60 + 1) END,
  CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN 'missing ' || concat_ws(', ', CASE WHEN c_custkey % 11 = 0 THEN 'source_updated' END, CASE WHEN c_custkey % 13 = 0 THEN 'maxzoom' END) END,
  CASE WHEN c_custkey % 5 = 0 THEN 'other processing than asked for' END, CASE WHEN c_custkey % 9 = 0 THEN 'other source zoom than asked for' END) AS problems FROM customer""",
    ),
    "tile_loss": (tile_loss, "SELECT c_custkey FROM customer WHERE c_acctbal < 1000"),
    "listing_totals": (listing_totals, "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)"),
}
