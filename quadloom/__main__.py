"""python -m quadloom COMMAND: archives from the command line.

crawl       ask a tile service for an area and store what it has
refresh     ask again for what is held, apply and record the answers
strip       remove no-data from the deepest zoom
rebuild     make the lower zooms anew from a source zoom
novelty     how much each zoom adds to the one above
inspect     zooms, tiles, centre, bounds and metadata
diff        tiles that one archive has and another lacks, per zoom
preview     a mosaic around a point
publish     stage, verify, rename, retire, manifest
run         refresh, decide, strip, rebuild, verify and publish every layer
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import functions as F

from . import session
from .functions import text
from .functions.geometry import rectangles
from .operators import grid, mosaic, pyramid, raster, relations, summary
from .plans import build, crawl, ledger, publish, strip
from .sources import mbtiles, service

AREA = "west double, south double, east double, north double"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quadloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", help="the Spark master; default: the one that spark-submit gives, or local[*]")
    s = p.add_subparsers(dest="command", required=True)

    def command(name: str, *paths: str) -> argparse.ArgumentParser:
        c = s.add_parser(name)
        for path in paths:
            c.add_argument(path)
        return c

    for name in ("crawl", "refresh"):
        c = command(name, "archive")
        c.add_argument("--kind", choices=["wmts", "wms"], default="wmts")
        c.add_argument("--base", required=True)
        c.add_argument("--layer", required=True)
        c.add_argument("--matrix", default="")
        if name == "refresh":
            c.add_argument("--today", required=True)
            continue
        c.add_argument("--mode", choices=["full", "descent", "fill", "mask", "coverage"], default="fill")
        c.add_argument("--bbox", type=lambda v: [float(x) for x in v.split(",")], required=True, help="west,south,east,north")
        c.add_argument("--zmin", type=int, default=0)
        c.add_argument("--zmax", type=int, required=True)
        c.add_argument("--extent", type=lambda v: [float(x) for x in v.split(",")], help="what the service covers, west,south,east,north; coverage needs it")
        c.add_argument("--repair", action="store_true", help="ask only for what the archive lacks")
        c.add_argument("--coverage-layer", default="", help="coverage: the layer that is rendered for the footprint")
        c.add_argument("--coverage-zoom", type=int, default=11)
        c.add_argument("--oversample", type=int, default=16)
        c.add_argument("--solid", type=int, default=11, help="fill: the last zoom asked for whole")
    c = command("strip", "archive", "out")
    c.add_argument("--stages", default="black-tiles,black-pixels,white-tiles")
    c.add_argument("--radius", type=int, default=strip.RADIUS)
    c.add_argument("--white", type=int, default=strip.WHITE)
    c.add_argument("--limit", type=int, default=strip.LIMIT)
    c.add_argument("--scan", action="store_true", help="count only")
    c = command("rebuild", "archive", "out")
    c.add_argument("--source", type=int)
    command("novelty", "archive")
    command("inspect", "archive")
    command("diff", "archive", "other")
    c = command("preview", "archive", "out")
    c.add_argument("--at", type=lambda v: [float(x) for x in v.split(",")], required=True, help="lon,lat")
    c.add_argument("--z", type=int, required=True)
    c.add_argument("--size", type=lambda v: [int(x) for x in v.split("x")], default=[512, 512])
    c = s.add_parser("publish")
    c.add_argument("sources", nargs="+")
    c.add_argument("--out", required=True)
    c = command("run", "archives", "work", "out")
    c.add_argument("--layer", action="append", required=True, help="NAME or NAME=stage,stage")
    c.add_argument("--force", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    return p


def show(value) -> None:
    print(json.dumps(value, default=str, ensure_ascii=False))


def _footprint(spark, a, book: ledger.Ledger):
    """The cells that the coverage layer draws in the service's extent, kept under all they depend on."""
    area = spark.createDataFrame([tuple(a.extent)], AREA)
    rect = rectangles(area, a.coverage_zoom, a.coverage_zoom)

    def made():
        r = rect.first()
        samples = service.rendered(rect, a.base, a.coverage_layer or a.layer, a.oversample, service.over_http())
        cells = crawl.footprint_cells(samples, r["x1"] - r["x0"] + 1, r["y1"] - r["y0"] + 1, 1)
        return cells.select((F.col("x") + r["x0"]).alias("x"), (F.col("y") + r["y0"]).alias("y"))

    return book.footprint(ledger.shape(a.base, a.coverage_layer or a.layer, a.coverage_zoom, a.oversample, a.extent), made)


def _crawl(spark, a) -> None:
    crawl.check_options(a.mode, "extent" if a.extent else "limits", a.repair, footprint_z=a.coverage_zoom, over=a.oversample, errors_outside=a.kind == "wmts")
    source = service.Source(a.kind, a.base, a.layer, a.matrix, empty_on_4xx=a.kind == "wmts")
    raw = service.fetcher(source, service.over_http())
    limits = session.settled(rectangles(spark.createDataFrame([crawl.checked_area(*a.bbox)], AREA), a.zmin, a.zmax))
    if a.extent:
        limits = crawl.overlap(rectangles(spark.createDataFrame([crawl.checked_area(*a.extent)], AREA), a.zmin, a.zmax), limits)
    book = ledger.Ledger(spark, f"{session.shared_dir(spark)}/crawl-{Path(a.archive).stem}")
    held = build.load(spark, a.archive, keys=True).select("z", "x", "y") if Path(a.archive).exists() else None
    answers: list = []

    def asked(df):
        got = session.settled(service.narrowed(raw(df)))
        answers.append(got)
        return got

    def store(found) -> None:
        tiles = found.where("status = 'ok'").select("z", "x", "y", raster.without_solid(F.col("data")).alias("tile_data")).where("tile_data IS NOT NULL")
        tiles.write.format("mbtiles").option("path", a.archive).mode("append").save()

    if a.mode == "coverage" and not a.repair:
        run = ledger.shape(a.mode, a.base, a.layer, a.bbox, a.extent, a.zmin, a.zmax, a.coverage_zoom, a.oversample)
        fetch = lambda df: service.narrowed(raw(df))
        answers = ledger.coverage(book, run, _footprint(spark, a, book), a.coverage_zoom, fetch, a.zmin, a.zmax, store, limits, held)
    elif a.repair:
        footprint, frontier = _footprint(spark, a, book) if a.mode == "coverage" else None, None
        for z in range(a.zmin, a.zmax + 1):
            ask = crawl.candidates(frontier, limits, z, a.solid) if footprint is None else crawl.clipped(crawl.eligible(footprint, a.coverage_zoom, z), limits)
            stored = spark.createDataFrame([], "z int, x int, y int") if held is None else held.where(F.col("z") == z)
            answers.append(session.settled(crawl.repaired(stored, ask, lambda df: service.narrowed(raw(df)))))
            frontier = session.settled(stored.unionByName(answers[-1].where("status = 'ok'").select("z", "x", "y")))
            book.record(answers[-1])
    elif a.mode == "full":
        for z in range(a.zmin, a.zmax + 1):
            asked(crawl.candidates(None, limits, z))
    elif a.mode == "descent":
        crawl.descent(crawl.candidates(None, limits, a.zmin), asked, a.zmin, a.zmax, held, limits)
    elif a.mode == "mask":
        side = raster.raster.MASK
        seed = crawl.candidates(None, limits, a.zmin).withColumn("mask", F.lit(bytes([255] * (side * side // 8))))

        def masks(df):
            got = session.settled(raw(df))
            answers.append(service.narrowed(got))
            return service.masked(got)

        crawl.masked(seed, masks, a.zmin, a.zmax, side, limits)
    else:
        crawl.fill(min(a.solid, a.zmax), limits, asked, a.zmin, a.zmax)
    if not answers:
        show({"complete": a.zmax})
        return
    found = answers[0]
    for other in answers[1:]:
        found = found.unionByName(other, allowMissingColumns=True)
    # Of several answers for a place one that isn't an error counts.
    found = session.settled(found.groupBy("z", "x", "y").agg(*[F.min_by(c, F.struct(F.col("status") == "err", F.col("status") != "ok")).alias(c) for c in ("status", "data")]))
    if a.mode != "coverage" or a.repair:  # a coverage crawl stores and records each zoom
        store(found)
        book.record(found)
    keys = build.load(spark, a.archive, keys=True)
    b = grid.leaf_bounds(keys).select(text.bounds_text(*[F.col(c) for c in ("west", "south", "east", "north")]).alias("b")).first()["b"]
    z = keys.agg(F.min("z"), F.max("z")).first()
    mbtiles.set_metadata(a.archive, {"source": a.base, "source_layer": a.layer, "bounds": b or "", "minzoom": str(z[0]), "maxzoom": str(z[1])}, {"name": a.layer, "format": "png", "type": "overlay"})
    for r in summary.status_report(found, "ok", "empty", "err").orderBy("z").collect():
        show(r.asDict())


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "publish":  # files only
        show(publish.publish(a.sources, a.out))
        return 0
    spark = session.build(a.master)
    spark.dataSource.register(mbtiles.MBTiles)
    if a.command == "crawl":
        _crawl(spark, a)
    elif a.command == "refresh":
        since = spark.range(1).select(text.modified_since(F.lit(mbtiles.read_metadata(a.archive).get("downloaded"))).alias("s")).first()["s"]
        source = service.Source(a.kind, a.base, a.layer, a.matrix, conditional=True)
        fetch = service.fetcher(source, service.over_http(), since)
        show(build.refreshed(spark, Path(a.archive), lambda df: service.narrowed(fetch(df)), a.today))
    elif a.command == "strip":
        span = build.load(spark, a.archive, keys=True).agg(F.min("z"), F.max("z")).first()
        top = build.load(spark, a.archive, zooms=[span[1]])
        if a.scan:
            show(strip.dry_run(top, a.white).first().asDict())
        else:
            layer = build.Layer("", tuple(a.stages.split(",")), a.radius, a.white, a.limit)
            out = strip.stripped(top, list(layer.stages), a.radius, a.white, a.limit)
            out.write.format("mbtiles").option("path", a.out).mode("overwrite").save()
            meta = mbtiles.read_metadata(a.archive)
            mbtiles.set_metadata(a.out, meta | {"nodata_stripped": layer.stamp, "minzoom": str(span[1]), "pyramid_pending": meta.get("pyramid_pending") or meta.get("minzoom") or str(span[0])})
    elif a.command == "rebuild":
        tiles, meta = build.load(spark, a.archive), mbtiles.read_metadata(a.archive)
        zooms = build.load(spark, a.archive, keys=True).select("z").distinct()
        source = a.source if a.source is not None else zooms.agg(F.max("z")).first()[0]
        low = pyramid.floor_zoom(zooms, meta).first()["floor"]
        pyramid.rebuilt(tiles, source, low).write.format("mbtiles").option("path", a.out).mode("overwrite").save()
        meta = {k: v for k, v in meta.items() if k != "pyramid_pending"}
        mbtiles.set_metadata(a.out, meta | {"minzoom": str(low), "downscaled": "1", "downscale_source_zoom": str(source), "downscale_filter": "box"})
    elif a.command == "novelty":
        levels = session.settled(summary.novelty_levels(raster.novelty_scores(build.load(spark, a.archive))))
        for r in levels.orderBy("z").collect():
            show(r.asDict())
        lowest = build.load(spark, a.archive, keys=True).agg(F.min("z")).first()[0]
        show(summary.native_zoom(levels, lowest).first().asDict())
    elif a.command == "inspect":
        tiles = build.load(spark, a.archive, keys=True)
        show({"levels": {r.z: r.n for r in summary.levels(tiles).orderBy("z").collect()}, "centre": summary.centre(tiles).first().asDict(), "bounds": grid.leaf_bounds(tiles).first().asDict(), "metadata": mbtiles.read_metadata(a.archive)})
    elif a.command == "diff":
        for r in relations.difference_report(build.load(spark, a.archive, keys=True), build.load(spark, a.other, keys=True)).orderBy("z").collect():
            show(r.asDict())
    elif a.command == "preview":
        spots = spark.createDataFrame([("spot", *a.at, a.z)], "name string, lon double, lat double, z int")
        r = mosaic.mosaics(spots, build.load(spark, a.archive), *a.size).first()
        Path(a.out).write_bytes(bytes(r["image"]))
        show({"got": r["got"], "total": r["total"]})
    elif a.command == "run":
        layers = [build.Layer(n, tuple(s.split(",")) if s else ()) for n, _, s in (v.partition("=") for v in a.layer)]
        done = build.run(spark, layers, a.archives, a.work, a.out, forced=a.force, dry=a.dry_run)
        show(vars(done))
        return int(bool(done.failed))
    return 0


if __name__ == "__main__":
    sys.exit(main())
