"""The whole run on small archives, and previews."""

import numpy as np
import pytest

from quadloom.functions import png, raster
from quadloom.operators import mosaic
from quadloom.plans import build
from quadloom.sources import mbtiles

PAPER, BLACK = (236, 228, 205, 255), (0, 0, 0, 255)
SCHEMA = "z int, x int, y int, tile_data binary"


def image(colour):
    a = np.empty((256, 256, 4), np.uint8)
    a[:] = colour
    a[100:103, 20:230] = (10, 90, 200, 255)
    return png.encode(a)


@pytest.fixture
def folders(tmp_path):
    for n in ("archives", "work", "out"):
        (tmp_path / n).mkdir()
    return tmp_path / "archives", tmp_path / "work", tmp_path / "out"


def archive(spark, path, layer, rows, **meta):
    spark.dataSource.register(mbtiles.MBTiles)
    df = spark.createDataFrame([(z, x, y, bytearray(b)) for z, x, y, b in rows], SCHEMA)
    df.write.format("mbtiles").option("path", str(path)).mode("overwrite").save()
    mbtiles.set_metadata(path, {"source": "s", "source_layer": layer, "source_updated": "2026-06-02", "minzoom": "4"} | meta)


def test_a_run_builds_then_rests_then_rebuilds(spark, folders):
    fill = np.empty((256, 256, 4), np.uint8)
    fill[:] = BLACK
    rows = [(6, x, y, image(PAPER)) for x in (9, 10) for y in (9, 10)] + [(6, 8, 9, png.encode(fill))]
    archive(spark, folders[0] / "a.mbtiles", "one", rows)
    layers = [build.Layer("one", ("black-tiles",), radius=16), build.Layer("absent")]
    first = build.run(spark, layers, *folders)
    assert [f[0] for f in first.failed] == ["absent"] and first.published == ["one: nothing published (1 charts)"]
    path = folders[2] / "fi-one-2026-06-02.mbtiles"
    n = {r.z: r["count"] for r in build.load(spark, path).groupBy("z").count().collect()}
    assert n == {6: 4, 5: 4, 4: 1}
    assert mbtiles.read_metadata(path)["nodata_stripped"] == "nodata-r16-w254-n2:black-tiles"
    assert build.run(spark, layers[:1], *folders).current == ["one"]
    mbtiles.set_metadata(folders[0] / "a.mbtiles", {"pipeline_revision": "1"})
    assert build.run(spark, layers[:1], *folders, dry=True).published == ["one: archive changed"]
    assert build.run(spark, layers[:1], *folders, forced=True).published == ["one: forced (1 charts)"]
    assert not list(folders[1].glob("*.partial"))


def test_refresh_within_a_run(spark, folders):
    archive(spark, folders[0] / "a.mbtiles", "one", [(6, x, 9, image(PAPER)) for x in range(4)], downloaded="2026-01-01")
    new = image((1, 200, 3, 255))
    answer = spark.createDataFrame([(6, 0, 9, "ok", bytearray(new), "Wed, 03 Jun 2026 07:08:09 GMT", "Thu, 04 Jun 2026 07:08:09 GMT"), (6, 1, 9, "empty", None, None, None)], "z int, x int, y int, status string, data binary, last_modified string, served_at string")

    def fetch(asked):
        from pyspark.sql import functions as F

        return asked.join(answer, ["z", "x", "y"], "left").withColumn("status", F.coalesce("status", F.lit("notmodified")))

    done = build.run(spark, [build.Layer("one")], *folders, fetch=fetch, today="2026-07-01")
    assert not done.failed and len(done.published) == 1
    meta = mbtiles.read_metadata(folders[0] / "a.mbtiles")
    assert (meta["downloaded"], meta["pipeline_revision"], meta["source_updated"]) == ("2026-07-01", "1", "2026-06-03")
    assert build.load(spark, folders[0] / "a.mbtiles").count() == 3
    assert (folders[2] / "fi-one-2026-06-03.mbtiles").exists()


def test_losses_and_locks_stop_a_layer(spark, folders, tmp_path):
    archive(spark, tmp_path / "t.mbtiles", "one", [(6, 0, 0, image(PAPER))], maxzoom="6")
    with pytest.raises(build.Failed, match="1 tiles of 3"):
        build.verify(spark, tmp_path / "t.mbtiles", build.Layer("one"), 3)
    with build.locked(folders[0]), pytest.raises(build.Failed, match="another run"), build.locked(folders[0]):
        pass


def test_side_by_side(spark):
    t = spark.createDataFrame([(1, 0, 0, bytearray(image(PAPER)))], SCHEMA)
    areas = spark.createDataFrame([("a", -170.0, 10.0, 170.0, 80.0)], "name string, west double, south double, east double, north double")
    r = mosaic.compared(areas, {"old": t, "new": t.limit(0)}, 1).first()
    a = png.decode(bytes(r.image))
    assert r.label == "old: 1/2; new: 0/2" and a.shape == (256, 2 * 512 + 4, 4) and a[0, 0].tolist() == list(PAPER) and (a[:, 516:] == 255).all()


def test_palettes_and_strips():
    rng = np.random.default_rng(0)
    few = rng.integers(0, 256, (20, 4), dtype=np.uint8)[rng.integers(0, 20, (16, 16))]
    assert (png.decode(png.encode_palette(few)) == few).all()
    many = rng.integers(0, 256, (32, 32, 4), dtype=np.uint8)
    out = png.decode(png.encode_palette(many, 64))
    assert len(np.unique(out.reshape(-1, 4), axis=0)) <= 64 and np.abs(out.astype(int) - many).mean() < 40
    parent = rng.integers(0, 256, (256, 256, 4), dtype=np.uint8)
    strip = raster.example_strip(raster.doubled(parent, 0, 0), parent, 0, 0)
    assert strip.shape == (256, 768, 4) and not strip[:, 512:, :3].any()


def test_command_line(spark, tmp_path, capsys):
    import json

    from quadloom.__main__ import main

    a, b, c = (str(tmp_path / n) for n in ("a.mbtiles", "b.mbtiles", "c.mbtiles"))
    archive(spark, a, "one", [(6, x, y, image(PAPER)) for x in (9, 10) for y in (9, 10)])
    assert main(["strip", a, b, "--stages", "black-tiles", "--radius", "16"]) == 0
    assert main(["rebuild", b, c]) == 0
    assert main(["inspect", c]) == 0
    said = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert said["levels"] == {"4": 1, "5": 4, "6": 4} and "pyramid_pending" not in said["metadata"]
    assert main(["diff", c, a]) == 0 and main(["preview", c, str(tmp_path / "p.png"), "--at=-128,78", "--z", "6", "--size", "64x64"]) == 0
    assert main(["novelty", c]) == 0 and main(["strip", a, b, "--scan"]) == 0
    (tmp_path / "out").mkdir()
    assert main(["publish", c, "--out", str(tmp_path / "out")]) == 0 and (tmp_path / "out" / "manifest.json").exists()
    assert png.decode((tmp_path / "p.png").read_bytes()).shape == (64, 64, 4)


def test_crawl_and_refresh_over_http(spark, tmp_path, capsys):
    import json
    import re
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    from quadloom.__main__ import main

    state = {"body": image(PAPER)}

    class Tiles(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            z, y, x = map(int, re.search(r"tilematrix=M:(\d+)&tilerow=(\d+)&tilecol=(\d+)", self.path).groups())
            code = 200 if x == y else 404
            if self.headers.get("If-Modified-Since") and x != 4:
                code = 304
            self.send_response(code)
            self.send_header("Last-Modified", "Tue, 02 Jun 2026 07:08:09 GMT")
            self.send_header("Content-Length", str(len(state["body"]) if code == 200 else 0))
            self.end_headers()
            if code == 200:
                self.wfile.write(state["body"])

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Tiles)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        a = str(tmp_path / "a.mbtiles")
        base = f"http://127.0.0.1:{server.server_port}/wmts"
        assert main(["crawl", a, "--base", base, "--layer", "one", "--matrix", "M", "--bbox=-179,-80,179,80", "--zmin", "1", "--zmax", "3", "--solid", "2"]) == 0
        assert {(r.z, r.x, r.y) for r in build.load(spark, a).collect()} == {(z, x, x) for z in (1, 2, 3) for x in range(1 << z)}
        mbtiles.set_metadata(a, {"downloaded": "2026-06-03"})
        state["body"] = image((1, 2, 200, 255))
        assert main(["refresh", a, "--base", base, "--layer", "one", "--matrix", "M", "--today", "2026-07-01"]) == 0
        assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"checked": 14, "updated": 1, "removed": 0, "errors": 0}
        assert mbtiles.read_metadata(a)["downloaded"] == "2026-07-01"
    finally:
        server.shutdown()
