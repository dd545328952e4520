"""Archives, strips, pyramids, mosaics, crawls and refreshes end to end on small tiles."""

import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadloom.functions import png, text
from quadloom.operators import grid, mosaic, pyramid, raster, relations
from quadloom.plans import crawl, refresh, strip
from quadloom.sources import files, mbtiles, service

PAPER, SEA, BLACK, WHITE = (236, 228, 205, 255), (198, 226, 240, 255), (0, 0, 0, 255), (255, 255, 255, 255)
SCHEMA = "z int, x int, y int, tile_data binary"


def image(colour, **boxes):
    a = np.empty((256, 256, 4), np.uint8)
    a[:] = colour
    for where, c in boxes.values():
        a[where] = c
    return png.encode(a)


CONTENT = image(PAPER, sea=(np.s_[10:60], SEA), line=(np.s_[100:103, 20:230], BLACK))
FILL, BLANK = image(BLACK), image(WHITE)
HALF = image(PAPER, fill=(np.s_[:, :90], BLACK))


def tiles(spark, rows):
    return spark.createDataFrame([(z, x, y, bytearray(b)) for z, x, y, b in rows], SCHEMA)


def places(df):
    return {(r.x, r.y) for r in df.select("x", "y").collect()}


def test_archive_round_trip(spark, tmp_path):
    spark.dataSource.register(mbtiles.MBTiles)
    path = str(tmp_path / "a?b#c.mbtiles")
    want = tiles(spark, [(3, 1, 2, FILL), (3, 5, 7, BLANK), (4, 9, 0, CONTENT)])
    want.repartition(3).write.format("mbtiles").option("path", path).mode("overwrite").save()
    rows = sqlite3.connect(mbtiles.uri(path), uri=True).execute("SELECT zoom_level, tile_column, tile_row FROM tiles ORDER BY 1, 2").fetchall()
    assert rows == [(3, 1, 5), (3, 5, 0), (4, 9, 15)]
    got = spark.read.format("mbtiles").option("path", path).option("tilesperpartition", "1").load()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.format("mbtiles").option("path", path).option("zooms", "4").load().count() == 1
    tiles(spark, [(3, 1, 2, BLANK), (3, 0, 0, FILL)]).write.format("mbtiles").option("path", path).mode("append").save()
    again = spark.read.format("mbtiles").option("path", path).load()
    assert again.count() == 4 and bytes(again.where("x = 1").first().tile_data) == FILL
    files.check_intact(path)
    assert [p.name for p in tmp_path.iterdir()] == ["a?b#c.mbtiles"]


def test_damaged_files_are_refused(spark, tmp_path):
    path = tmp_path / "a.mbtiles"
    mbtiles.set_metadata(path, {"source": "s", "source_layer": "l"})
    files.check_intact(path)
    path.write_bytes(path.read_bytes()[:-100])
    with pytest.raises(files.Damaged):
        files.check_intact(path)
    path.write_bytes(b"tile")
    with pytest.raises(files.Damaged):
        files.check_intact(path)


def test_metadata_defaults_and_provenance(tmp_path):
    path = tmp_path / "a.mbtiles"
    mbtiles.set_metadata(path, {"source": "s"}, {"name": "first"})
    mbtiles.set_metadata(path, {"source": "s"}, {"name": "second"})
    assert mbtiles.read_metadata(path) == {"source": "s", "name": "first"}
    with sqlite3.connect(path) as db:
        db.execute("INSERT INTO tiles VALUES (1, 0, 0, x'00')")
    with pytest.raises(mbtiles.MixedSources):
        mbtiles.set_metadata(path, {"source": "other"})


def test_archives_are_found_by_layer(tmp_path):
    mbtiles.set_metadata(tmp_path / "a.mbtiles", {"source_layer": "one"})
    (tmp_path / "b.mbtiles").write_bytes(b"x" * 200)
    assert list(files.find_archives(tmp_path)) == ["one"]
    mbtiles.set_metadata(tmp_path / "c.mbtiles", {"source_layer": "one"})
    with pytest.raises(ValueError):
        files.find_archives(tmp_path)


def test_walk_and_peel_across_blocks(spark):
    rng = np.random.default_rng(5)
    cells = [(int(x), int(y), bool(m)) for (x, y), m in zip(np.ndindex(23, 19), rng.random(23 * 19) < 0.35) if rng.random() < 0.9]
    df = spark.createDataFrame(cells, "x int, y int, marked boolean")
    assert places(grid.outside(df, side=5)) == places(grid.outside(df, side=64))
    assert places(grid.held(df, side=4)) == places(grid.held(df, side=64))


def test_a_corridor_and_enclosed_water_stay(spark):
    ring = {(x, y) for x in range(5) for y in range(5) if x in (0, 4) or y in (0, 4)}
    rows = [(x, y, (x, y) in ring) for x in range(5) for y in range(5)] + [(5, 2, False)]
    assert places(grid.held(spark.createDataFrame(rows, "x int, y int, marked boolean"))) == {(x, y) for x in (1, 2, 3) for y in (1, 2, 3)}


def test_floods_keep_groups_apart(spark):
    rows = [("a", 0, 0, True), ("b", 5, 5, False)]
    got = grid.outside(spark.createDataFrame(rows, "layer string, x int, y int, marked boolean"), ["layer"])
    assert {r.layer: n for r, n in [(r, r["count"]) for r in got.groupBy("layer").count().collect()]} == {"a": 8, "b": 9}


def test_strip_drops_fill_and_clears_the_edge(spark):
    rows = [(10, x, y, FILL) for x in (0,) for y in range(3)] + [(10, 1, y, HALF) for y in range(3)] + [(10, x, y, CONTENT) for x in (2, 3) for y in range(3)]
    out = strip.stripped(tiles(spark, rows), ["black-tiles", "black-pixels"], radius=16)
    got = {(r.x, r.y): png.decode(bytes(r.tile_data)) for r in out.collect()}
    assert set(got) == {(x, y) for x in (1, 2, 3) for y in range(3)}
    assert (got[1, 1][:, :60, 3] == 0).all() and (got[1, 1][:, 90:] == PAPER).all()
    assert (got[2, 1] == png.decode(CONTENT)).all()


def test_strip_refuses_to_empty_the_zoom(spark):
    with pytest.raises(strip.Emptied):
        strip.stripped(tiles(spark, [(10, 0, 0, FILL)]), ["black-tiles"])
    with pytest.raises(ValueError):
        strip.stripped(tiles(spark, [(10, 0, 0, CONTENT)]), ["green-tiles"])


def test_white_stages_peel_and_flood(spark):
    open_ = image(WHITE, mark=(np.s_[120:130, 120:130], BLACK))
    rows = [(10, 0, y, BLANK) for y in range(3)] + [(10, x, y, open_) for x in (1, 2) for y in range(3)]
    out = strip.stripped(tiles(spark, rows), ["white-tiles", "white-pixels"], radius=16)
    got = {(r.x, r.y): png.decode(bytes(r.tile_data)) for r in out.collect()}
    assert (0, 1) not in got and (got[1, 1][125, 125] == BLACK).all() and got[1, 1][5, 2, 3] == 0


def test_dry_run_counts(spark):
    r = strip.dry_run(tiles(spark, [(10, 0, 0, FILL), (10, 1, 0, HALF), (10, 2, 0, CONTENT)])).first()
    assert (r.tiles, r.with_fill, r.solid) == (3, 3, 1)


def test_leaks_are_named(spark):
    with pytest.raises(grid.Leaked, match=r"\(1, 2\)"):
        grid.refuse_leaks(spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([], "x int, y int"))


def test_pyramid_is_rebuilt_and_gaps_are_filled(spark):
    rows = [(12, x, y, image((x * 10 % 250, y * 10 % 250, 0, 255))) for x in range(2048, 2052) for y in range(1200, 1204)] + [(10, 5, 5, CONTENT), (3, 0, 0, SEA_TILE := image(SEA))]
    out = pyramid.rebuilt(tiles(spark, rows), 12, 9)
    n = {r.z: r["count"] for r in out.groupBy("z").count().collect()}
    assert n == {12: 16, 11: 4, 10: 2, 9: 1, 3: 1}
    z11 = png.decode(bytes(out.where("z = 11 AND x = 1024 AND y = 600").first().tile_data))
    assert z11[0, 0].tolist() == [230, 0, 0, 255] and z11[0, 200].tolist() == [240, 0, 0, 255]
    assert bytes(out.where("z = 3").first().tile_data) == SEA_TILE


@pytest.mark.parametrize(("meta", "want"), [({}, 7), ({"minzoom": "5"}, 5), ({"minzoom": "x"}, 7), ({"pyramid_pending": "4", "minzoom": "5"}, 4), ({"minzoom": "9"}, 7)])
def test_floor_zoom(spark, meta, want):
    assert pyramid.floor_zoom(spark.createDataFrame([(7,), (9,)], "z int"), meta).first().floor == want


def test_novelty_and_masks_of_tiles(spark):
    df = tiles(spark, [(5, 0, 0, CONTENT), (6, 0, 0, CONTENT), (6, 9, 9, CONTENT)])
    r = raster.novelty_scores(df).collect()
    assert len(r) == 1 and 0 <= r[0].novelty <= 1
    m = df.select(raster.alpha_mask(F.col("tile_data")).alias("m")).first().m
    assert len(m) == 128
    assert df.where(raster.without_solid(F.col("tile_data")).isNull()).count() == 0


def test_mosaic(spark):
    spots = spark.createDataFrame([("s", 0.0, 0.0, 1)], "name string, lon double, lat double, z int")
    r = mosaic.mosaics(spots, tiles(spark, [(1, 0, 0, FILL), (1, 1, 1, image(SEA))]), 100, 60).first()
    a = png.decode(bytes(r.image))
    assert (r.got, r.total) == (2, 4) and a[0, 0].tolist() == list(BLACK) and a[59, 99].tolist() == list(SEA) and a[0, 99, 3] == 0


def world(spark, low, high):
    """Content along a diagonal, hollow at zoom 4: nothing is drawn there, but below there is."""
    rows = [(z, x, y, "ok" if abs(x - y) <= 1 and (z != 4 or (x + y) % 3) else "empty") for z in range(low, high + 1) for x in range(1 << z) for y in range(1 << z)]
    return spark.createDataFrame(rows, "z int, x int, y int, status string")


def test_coverage_finds_what_full_enumeration_finds(spark):
    answers = world(spark, 2, 6)
    fetch = crawl.from_table(answers)
    foot = answers.where("z = 5 AND status = 'ok'").select("x", "y")
    found = crawl.coverage(foot, 5, fetch, 2, 6)
    full = answers.where("status = 'ok'")
    assert relations.difference_report(full, found.where("status = 'ok'")).agg(F.sum("missed")).first()[0] == 0
    assert found.count() < answers.count() and crawl.complete(found)


def test_fill_is_complete_where_descent_is_not(spark):
    answers = world(spark, 2, 6)
    limits = spark.createDataFrame([(z, 0, (1 << z) - 1, 0, (1 << z) - 1) for z in range(2, 7)], "z int, x0 int, x1 int, y0 int, y1 int")
    fetch = crawl.from_table(answers)
    want = answers.where("status = 'ok'").count()
    assert crawl.fill(3, limits, fetch, 2, 6).count() == want
    assert crawl.descent(answers.where("z = 2"), fetch, 2, 6).count() < want


def test_candidates(spark):
    limits = spark.createDataFrame([(3, 2, 3, 4, 5)], "z int, x0 int, x1 int, y0 int, y1 int")
    frontier = spark.createDataFrame([(2, 1, 2), (2, 0, 0)], "z int, x int, y int")
    assert places(crawl.candidates(None, limits, 3)) == {(2, 4), (2, 5), (3, 4), (3, 5)}
    assert places(crawl.candidates(frontier, limits, 3)) == {(2, 4), (2, 5), (3, 4), (3, 5)}
    assert crawl.candidates(frontier, limits, 3, full_until=3).count() == 4


def test_masked_crawl_follows_quadrants(spark):
    spot = image((0, 0, 0, 0), spot=(np.s_[:8, :8], SEA))
    rows = [(3, 0, 0, "content", spot), (4, 0, 0, "placeholder", None), (5, 0, 0, "content", spot), (4, 1, 1, "content", spot)]
    answers = spark.createDataFrame([(z, x, y, s, None if b is None else bytearray(b)) for z, x, y, s, b in rows], "z int, x int, y int, status string, data binary")
    seed = spark.createDataFrame([(3, 0, 0, bytearray(b"\xff" * 128))], "z int, x int, y int, mask binary")
    got = crawl.masked(seed, crawl.from_table(answers, "outside"), 3, 5)
    assert {(r.z, r.x, r.y) for r in got.collect()} == {(3, 0, 0), (5, 0, 0)}


def test_retry_and_repair(spark):
    answers = spark.createDataFrame([(1, 0, 0, "ok"), (1, 1, 0, "err")], "z int, x int, y int, status string")
    later = crawl.from_table(spark.createDataFrame([(1, 1, 0, "empty")], "z int, x int, y int, status string"))
    assert {(r.x, r.status) for r in crawl.retried(answers, later).collect()} == {(0, "ok"), (1, "empty")}
    never = crawl.from_table(spark.createDataFrame([], "z int, x int, y int, status string"), "err")
    assert {(r.x, r.status) for r in crawl.retried(answers, never).collect()} == {(0, "ok"), (1, "err")}
    assert crawl.repaired(answers.where("x = 0"), answers.select("z", "x", "y"), later).count() == 1


def test_footprint_cells(spark):
    px = spark.createDataFrame([(x, y, 255 if 8 <= x < 12 and 8 <= y < 12 else 0) for x in range(20) for y in range(20)], "px int, py int, a int")
    assert places(crawl.footprint_cells(px, 5, 5, 4)) == {(x, y) for x in (1, 2, 3) for y in (1, 2, 3)}
    with pytest.raises(crawl.Implausible):
        crawl.footprint_cells(px.withColumn("a", F.lit(0)), 5, 5, 4)
    with pytest.raises(crawl.Implausible):
        crawl.footprint_cells(px.withColumn("a", F.when(F.col("px") < 4, 1).otherwise(0)), 5, 5, 4)


@pytest.mark.parametrize("options", [{"mode": "coverage", "source": "limits"}, {"mode": "mask", "source": "extent", "errors_outside": False}, {"mode": "fill", "source": "x", "repair": True, "refresh": True}, {"mode": "fill", "source": "x", "over": 65}, {"mode": "fill", "source": "x", "report": True}])
def test_bad_options(options):
    with pytest.raises(ValueError):
        crawl.check_options(**options)


def answers(spark, rows):
    return spark.createDataFrame([(8, x, 73, s, None if b is None else bytearray(b), None, None) for x, s, b in rows], service.ANSWERS)


def test_refresh_routes_and_is_idempotent(spark):
    old = tiles(spark, [(8, 147, 73, b"tile"), (8, 148, 73, b"tile"), (8, 200, 73, b"tile")])
    a = answers(spark, [(147, "ok", b"new"), (148, "empty", None), (200, "notmodified", None), (201, "err", None)])
    once = refresh.applied(old, a)
    want = {(147, b"new"), (200, b"tile")}
    assert {(r.x, bytes(r.tile_data)) for r in once.collect()} == want
    assert {(r.x, bytes(r.tile_data)) for r in refresh.applied(once, a).collect()} == want
    assert tuple(refresh.report(a).first()) == (4, 1, 1, 1)
    assert places(refresh.failed(spark.createDataFrame([(8, 148, 73), (8, 5, 73)], "z int, x int, y int"), a)) == {(201, 73), (5, 73)}


def test_watermark_progress_and_revision():
    assert refresh.watermark("2026-01-01", "2026-02-01", 0) == "2026-02-01" and refresh.watermark("2026-01-01", "2026-02-01", 1) == "2026-01-01"
    p = refresh.Progress(9, "a|b")
    assert p.resume_after("a|b") == 9 and p.resume_after("a|c") is None
    assert refresh.revised(4, 0, 0) == 4 and refresh.revised(4, 0, 2) == 5


def test_editions(spark):
    rows = [("Tue, 02 Jun 2026 07:08:09 GMT", "Wed, 03 Jun 2026 07:08:09 GMT"), ("Tue, 02 Jun 2020 07:08:09 GMT", "Tue, 02 Jun 2020 07:08:20 GMT"), ("bad", None), (None, None)]
    df = spark.createDataFrame(rows, "last_modified string, served_at string")
    assert tuple(refresh.edition_extent(df, "2026-01-01", None).first()) == ("2026-06-02", "2026-06-02")
    assert tuple(refresh.edition_extent(df.limit(0), "2026-01-01", "2025-01-01").first()) == ("2026-01-01", "2025-01-01")


def test_stamp_is_in_canonical_order(spark):
    stages = F.array(*[F.lit(s) for s in ("white-pixels", "black-pixels", "white-tiles", "black-tiles")])
    got = spark.range(1).select(text.processing_stamp(F.lit(128), F.lit(254), F.lit(2), stages).alias("s")).first().s
    assert got == "nodata-r128-w254-n2:black-tiles+black-pixels+white-tiles+white-pixels"


def test_a_summary_without_a_count_fails(spark):
    from pyspark.errors import PySparkException

    df = spark.createDataFrame([("requested 1,234",)], "s string")
    assert df.select(text.requested_count(F.col("s")).alias("n")).first().n == 1234
    with pytest.raises(PySparkException):
        df.select(text.requested_count(F.lit("nothing")).alias("n")).collect()


def test_fetcher_retries_and_classifies(spark):
    from pyspark import cloudpickle

    calls, bodies = {}, {0: CONTENT, 2: CONTENT, 5: image((1, 2, 3, 0))}

    def transport(url, headers):
        col = int(url.rsplit("tilecol=", 1)[1])
        calls[col] = calls.get(col, 0) + 1
        code = {0: 200, 1: 404, 2: 503 if calls[col] < 3 else 200, 3: 500, 4: 304, 5: 200}[col]
        return code, bodies.get(col) if code == 200 else None, {"Date": "d"}

    assert cloudpickle.dumps(transport)
    source = service.Source("wmts", "https://tiles.example", "a b", "M")
    fetch = service.fetcher(source, transport, wait=lambda s: None)
    got = fetch(spark.createDataFrame([(3, x, 0) for x in range(6)], "z int, x int, y int").coalesce(1))
    assert {r.x: r.status for r in got.collect()} == {0: "ok", 1: "outside", 2: "ok", 3: "err", 4: "notmodified", 5: "blank"}
    assert {r.x: r.status for r in service.narrowed(got).collect()}[5] == "empty"


def test_streamed_answers_reach_the_archive(spark, tmp_path):
    from quadloom.streaming import editions

    folder = str(tmp_path / "in")
    answers(spark, [(1, "ok", b"a"), (2, "empty", None)]).write.parquet(folder)
    state = {"tiles": tiles(spark, [(8, 2, 73, b"x"), (8, 3, 73, b"y")]), "reports": []}
    run = lambda: editions.ingest(editions.answers(spark, folder), str(tmp_path / "c"), lambda: state["tiles"], lambda df: state.update(tiles=spark.createDataFrame(df.collect(), SCHEMA)), state["reports"].append).awaitTermination()
    run()
    assert {(r.x, bytes(r.tile_data)) for r in state["tiles"].collect()} == {(1, b"a"), (3, b"y")}
    run()
    assert state["reports"] == [{"checked": 2, "updated": 1, "removed": 1, "errors": 0}]


def test_streamed_extents(spark, tmp_path):
    from quadloom.streaming import editions

    rows = [(8, 1, 1, "ok", None, "Tue, 02 Jun 2026 07:08:09 GMT", "Wed, 03 Jun 2026 07:08:09 GMT"), (8, 2, 1, "ok", None, "Mon, 01 Jun 2026 07:08:09 GMT", "Wed, 03 Jun 2026 07:08:09 GMT")]
    spark.createDataFrame(rows, service.ANSWERS).write.parquet(str(tmp_path / "in"))
    q = editions.extents(editions.answers(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("extents").trigger(availableNow=True).start()
    q.awaitTermination()
    assert tuple(spark.table("extents").first()) == (8, "2026-06-02", "2026-06-01")


def test_a_resumed_descent_goes_below_what_is_stored(spark):
    answers = spark.createDataFrame([(z, x, 0, "ok") for z in (1, 2, 3) for x in range(1 << z)], "z int, x int, y int, status string")
    fetch = crawl.from_table(answers)
    seed, done = answers.where("z = 1 AND x = 0"), answers.where("z = 1 AND x = 0")
    assert {(r.z, r.x) for r in crawl.descent(seed, fetch, 1, 3, done).collect()} == {(2, 0), (2, 1), (3, 0), (3, 1), (3, 2), (3, 3)}
    limits = spark.createDataFrame([(z, 0, 1, 0, 0) for z in (1, 2, 3)], "z int, x0 int, x1 int, y0 int, y1 int")
    assert {(r.z, r.x) for r in crawl.descent(seed, fetch, 1, 3, done, limits).collect()} == {(2, 0), (2, 1), (3, 0), (3, 1)}


def test_limits_of_one_matrix_set(spark):
    row = lambda s, z, n: f"<TileMatrixLimits><TileMatrix>{s}:{z}</TileMatrix><MinTileRow>0</MinTileRow><MaxTileRow>{n}</MaxTileRow><MinTileCol>1</MinTileCol><MaxTileCol>{n}</MaxTileCol></TileMatrixLimits>"
    link = lambda s, n: f"<TileMatrixSetLink><TileMatrixSet>{s}</TileMatrixSet><TileMatrixSetLimits>{row(s, 5, n)}</TileMatrixSetLimits></TileMatrixSetLink>"
    caps = spark.createDataFrame([(f"<Layer><ows:Identifier>a</ows:Identifier>{link('M', 7)}{link('Other', 9)}</Layer>",)], "xml string")
    assert [tuple(r) for r in service.stated_limits(caps, service.Source("wmts", "", "a", "M")).collect()] == [(5, 1, 7, 0, 7)]
    for layer, matrix in (("b", "M"), ("a", "N")):
        with pytest.raises(LookupError):
            service.stated_limits(caps, service.Source("wmts", "", layer, matrix))


def test_archives_are_read_pruned(spark, tmp_path):
    path = str(tmp_path / "p.mbtiles")
    rows = [(z, x, y, bytearray(b"blob")) for z in (3, 4, 5) for x in range(4) for y in range(3)]
    spark.dataSource.register(mbtiles.MBTiles)
    spark.createDataFrame(rows, mbtiles.SCHEMA).write.format("mbtiles").option("path", path).mode("overwrite").save()
    from quadloom.plans import build

    keys, tiles, one = build.load(spark, path, keys=True), build.load(spark, path), build.load(spark, path, zooms=[4])
    assert keys.columns == ["z", "x", "y"] and keys.count() == 36 and tiles.rdd.getNumPartitions() == 3
    assert one.rdd.getNumPartitions() == 1 and {r.z for r in one.collect()} == {4}
    assert build.load(spark, path, keys=True, zooms=[9]).count() == 0
    both = tiles.where("z = 3").unionByName(tiles.where("z > 3"))
    assert both.count() == 36 and tiles.where("z = 3").join(tiles.where("z = 5"), ["x", "y"]).count() == 12


def test_replacing_leaves_one_row_a_key(spark):
    old = spark.createDataFrame([(1, 0, 0, "a"), (1, 0, 1, "b")], "z int, x int, y int, v string")
    new = spark.createDataFrame([(1, 0, 0, "c"), (1, 0, 0, "c"), (2, 0, 0, "d")], old.schema)
    assert sorted(tuple(r) for r in relations.replace(old, new).collect()) == [(1, 0, 0, "c"), (1, 0, 1, "b"), (2, 0, 0, "d")]
