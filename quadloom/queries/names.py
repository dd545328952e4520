"""Names, stamps, sizes, dates, pages and capabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..session import table
from ..sources import service


def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", t.slug(F.initcap("p_name"), " the", "ring").alias("slug"))


def labels(spark, sf_dir):
    names = F.create_map(F.lit("BUILDING"), F.lit("Buildings"), F.lit("MACHINERY"), F.lit(""))
    return table(spark, sf_dir, "customer").select("c_custkey", t.label(F.col("c_mktsegment"), names).alias("label"))


def published_names(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    layer = t.layer_prefix(F.when(k % 3 == 0, "").when(k % 3 == 1, F.lower("o_orderstatus")), F.when(k % 5 > 0, F.lit("orders")), F.lit("Other Layer"))
    return o.select("o_orderkey", t.published_name(layer, F.when(k % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("")).alias("name"))


def processing_stamps(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    stages = F.filter(F.array(F.when(k % 2 == 0, "white-pixels"), F.when(k % 3 == 0, "black-tiles"), F.when(k % 5 == 0, "black-pixels"), F.when(k % 7 == 0, "white-tiles")), lambda s: s.isNotNull())
    stamp = t.processing_stamp(F.lit(128), F.lit(254), k % 4, stages)
    return p.select("p_partkey", stamp.alias("stamp"), t.processing_text(F.when(k % 3 > 0, stamp), F.when(k % 4 == 0, "halved").otherwise("")).alias("processing"), t.fingerprint(k, F.col("p_brand"), F.when(k % 2 == 0, F.col("p_size"))).alias("shape"))


def human_sizes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).otherwise(F.col("o_orderkey") * F.col("o_orderkey") * 37).alias("n"))
    return o.select("o_orderkey", t.human_size(F.col("n")).alias("size"))


def durations(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", t.duration(F.col("o_orderkey") * 15).alias("took"))


def edition_days(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.unix_timestamp("o_orderdate") + F.col("o_orderkey") % 86400).alias("s"))
    http = lambda s: F.date_format(F.timestamp_seconds(s), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    o = o.select("o_orderkey", http(F.col("s")).alias("modified"), http(F.col("s") + F.col("o_orderkey") % 90).alias("served"))
    day = t.edition_day(F.when(F.col("o_orderkey") % 17 > 0, F.col("modified")).otherwise("yesterday"), F.col("served"))
    return o.select("o_orderkey", day.alias("day"), t.modified_since(day).alias("since"))


def request_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("done: requested "), F.format_number(F.col("o_orderkey") * 1001, 0), F.lit(" tiles")).alias("summary"))
    return o.select("o_orderkey", t.requested_count(F.col("summary")).alias("requested"))


def revisions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    raw = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.concat(k.cast("string"), F.lit("x")))
    return o.select("o_orderkey", t.revision(raw).alias("revision"), t.is_counter(raw).alias("counter"))


def bounds(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    box = t.bounds_text(k / 8, k / 16, k / 4, (k / 2).cast("double"))
    return c.select("c_custkey", box.alias("bounds"), F.element_at(t.bounds_parts(box), 3).alias("east"))


def tile_urls(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    wmts = t.tile_url("https://tiles.example/wmts", F.lower("c_mktsegment"), F.lit(7), k.cast("int"), (k + 1).cast("int"), "M")
    wms = t.map_url("https://tiles.example/wms", F.lit("cells"), k / 8, k / 16, k / 4, k / 2, F.lit(256), F.lit(512))
    return c.select("c_custkey", wmts.alias("wmts"), wms.alias("wms"))


def html_digests(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.sha2(t.escape_html(F.col("html")), 256).alias("sha256"), F.octet_length("html").cast("long").alias("bytes"))


def capabilities_limits(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.concat(*[c if not isinstance(c, str) else F.lit(c) for c in ("<Layer><ows:Identifier>", F.col("n_name"), "</ows:Identifier>", "<TileMatrixLimits><TileMatrix>M:", F.col("n_nationkey").cast("string"), "</TileMatrix><MinTileRow>1</MinTileRow><MaxTileRow>", (F.col("n_nationkey") * 3).cast("string"), "</MaxTileRow><MinTileCol>2</MinTileCol><MaxTileCol>9</MaxTileCol></TileMatrixLimits></Layer>")]).alias("part"), "n_name")
    one = n.agg(F.array_join(F.array_sort(F.collect_list("part")), "").alias("xml"), F.min("n_name").alias("first"))
    first = table(spark, sf_dir, "nation").agg(F.min("n_name")).first()[0]
    return service.limits(one, first)


def answer_states(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.element_at(F.array(*[F.lit(s) for s in ("ok", "blank", "outside", "err", "notmodified")]), (F.col("event_id") % 5 + 1).cast("int")).alias("status"))
    m = service.masked(e).select("event_id", F.col("status").alias("masked"))
    return service.narrowed(e).join(m, "event_id")


QUERIES = {
    "slugs": (slugs, "SELECT p_partkey, split_part(replace(replace(lower(p_name), ' the', ''), ' ', ''), 'ring', 1) AS slug FROM part"),
    "labels": (labels, "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Buildings' ELSE c_mktsegment END AS label FROM customer"),
    "published_names": (
        published_names,
        r"""WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN lower(o_orderstatus) WHEN o_orderkey % 5 > 0 THEN 'orders' ELSE 'Other Layer' END AS l, CASE WHEN o_orderkey % 7 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS e FROM orders)
SELECT o_orderkey, CASE WHEN regexp_full_match('fi-' || l || '-' || e || '.mbtiles', 'fi-[a-z0-9]+-\d{4}-\d{2}-\d{2}\.mbtiles') THEN 'fi-' || l || '-' || e || '.mbtiles' END AS name FROM n""",
    ),
    "processing_stamps": (
        processing_stamps,
        """WITH s AS (SELECT p_partkey AS k, p_brand, p_size, 'nodata-r128-w254-n' || (p_partkey % 4)::VARCHAR || ':' || concat_ws('+', CASE WHEN p_partkey % 3 = 0 THEN 'black-tiles' END, CASE WHEN p_partkey % 5 = 0 THEN 'black-pixels' END, CASE WHEN p_partkey % 7 = 0 THEN 'white-tiles' END, CASE WHEN p_partkey % 2 = 0 THEN 'white-pixels' END) AS stamp FROM part)
SELECT k AS p_partkey, stamp, coalesce(nullif(concat_ws('; ', CASE WHEN k % 3 > 0 THEN stamp END, CASE WHEN k % 4 = 0 THEN 'halved' END), ''), 'none') AS processing, k::VARCHAR || '|' || p_brand || '|' || CASE WHEN k % 2 = 0 THEN p_size::VARCHAR ELSE 'None' END AS shape FROM s""",
    ),
    "human_sizes": (
        human_sizes,
        """WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE o_orderkey * o_orderkey * 37 END AS n FROM orders)
SELECT o_orderkey, CASE WHEN n >= 1073741824 THEN printf('%.1f GiB', n / 1073741824) WHEN n >= 1048576 THEN printf('%.1f MiB', n / 1048576) WHEN n >= 1024 THEN printf('%.1f KiB', n / 1024) ELSE n::VARCHAR || ' B' END AS size FROM n""",
    ),
    "durations": (
        durations,
        "WITH m AS (SELECT o_orderkey, round_even(o_orderkey * 15 / 60, 0)::BIGINT AS m FROM orders) SELECT o_orderkey, CASE WHEN m < 60 THEN m::VARCHAR || ' min' ELSE (m // 60)::VARCHAR || ' h ' || (m % 60)::VARCHAR || ' min' END AS took FROM m",
    ),
    "edition_days": (
        edition_days,
        """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 90 >= 60 AND o_orderkey % 17 > 0 THEN (o_orderdate + to_seconds(o_orderkey % 86400))::DATE END AS d FROM orders)
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day, strftime(d + 1, '%a, %d %b %Y 00:00:00 GMT') AS since FROM d""",
    ),
    "request_counts": (request_counts, "SELECT o_orderkey, o_orderkey * 1001 AS requested FROM orders"),
    "revisions": (
        revisions,
        "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE 0 END::INTEGER AS revision, CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 1 THEN false END AS counter FROM orders",
    ),
    "bounds": (bounds, "SELECT c_custkey, printf('%.5f,%.5f,%.5f,%.5f', c_custkey / 8, c_custkey / 16, c_custkey / 4, c_custkey / 2) AS bounds, c_custkey / 4 AS east FROM customer"),
    "tile_urls": (
        tile_urls,
        """SELECT c_custkey, 'https://tiles.example/wmts?service=WMTS&request=GetTile&version=1.0.0&style=default&format=image/png&tilematrixset=M&layer=' || lower(c_mktsegment) || printf('&tilematrix=M:7&tilerow=%d&tilecol=%d', c_custkey, c_custkey + 1) AS wmts,
  'https://tiles.example/wms?service=WMS&request=GetMap&version=1.3.0&crs=EPSG:3857&format=image/png&transparent=true&exceptions=XML&styles=&layers=cells&bbox=' || printf('%.6f,%.6f,%.6f,%.6f', c_custkey / 8, c_custkey / 16, c_custkey / 4, c_custkey / 2) || '&width=256&height=512' AS wms FROM customer""",
    ),
    "html_digests": (html_digests, "SELECT page_id, sha256(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS sha256, octet_length(encode(html))::BIGINT AS bytes FROM pages"),
    "capabilities_limits": (capabilities_limits, "SELECT n_nationkey AS z, 2 AS x0, 9 AS x1, 1 AS y0, n_nationkey * 3 AS y1 FROM nation WHERE n_name = (SELECT min(n_name) FROM nation)"),
    "answer_states": (
        answer_states,
        "SELECT event_id, ['ok', 'empty', 'empty', 'err', 'notmodified'][event_id % 5 + 1] AS status, ['content', 'placeholder', 'outside', 'err', 'notmodified'][event_id % 5 + 1] AS masked FROM events",
    ),
}
