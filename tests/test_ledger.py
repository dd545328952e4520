"""What crawls keep between runs, areas that are refused and rendered footprints."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadloom.functions import geometry as g
from quadloom.functions import png
from quadloom.plans import crawl, ledger
from quadloom.sources import service

PLACES = "z int, x int, y int"


def places(df):
    return {(r.z, r.x, r.y) for r in df.select("z", "x", "y").collect()}


def test_a_ledger_outlives_its_object(spark, tmp_path):
    book = ledger.Ledger(spark, f"file://{tmp_path}/book")
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([(3, 4)], "x int, y int")

    assert book.footprint("a|1", build).collect() == ledger.Ledger(spark, f"file://{tmp_path}/book").footprint("a|1", build).collect()
    assert len(built) == 1 and book.footprint("a|2", build).count() == 1 and len(built) == 2
    assert book.progress().resume_after("s") is None
    book.mark(3, "s")
    book.mark(4, "s")
    assert book.progress().resume_after("s") == 4 and book.progress().resume_after("t") is None
    book.record(spark.createDataFrame([(1, 0, 0, "err"), (1, 1, 0, "ok")], f"{PLACES}, status string"))
    book.record(spark.createDataFrame([(1, 0, 0, "empty"), (2, 0, 0, "err")], f"{PLACES}, status string"))
    assert places(book.failed()) == {(2, 0, 0)}


def test_coverage_resumes_after_the_last_whole_zoom(spark, tmp_path):
    book = ledger.Ledger(spark, f"file://{tmp_path}/book")
    cells = spark.createDataFrame([(2, 2), (3, 2)], "x int, y int")
    asked, stored = [], []

    def service_that(fails):
        def fetch(df):
            rows = df.collect()
            asked.extend((r.z, r.x, r.y) for r in rows)
            return spark.createDataFrame([(r.z, r.x, r.y, "err" if (r.z, r.x, r.y) in fails else "ok") for r in rows], f"{PLACES}, status string")

        return fetch

    def store(df):
        stored.extend((r.z, r.x, r.y) for r in df.where("status = 'ok'").collect())

    run = lambda fetch: ledger.coverage(book, "s", cells, 3, fetch, 3, 5, store)
    run(service_that({(4, 5, 5)}))
    assert book.progress().completed_zoom == 3 and places(book.failed()) == {(4, 5, 5)} and len(stored) == 2 + 7 + 32
    asked.clear()
    run(service_that(()))
    assert (3, 2, 2) not in asked and asked[0] == (4, 5, 5)
    assert book.progress().completed_zoom == 5 and book.failed().isEmpty() and (4, 5, 5) in stored
    asked.clear()
    assert run(service_that(())) == [] and asked == []


def test_areas_that_select_nothing_are_refused(spark):
    for backwards in ((5, 1, 4, 2), (1, 2, 3, 2)):
        with pytest.raises(ValueError):
            crawl.checked_area(*backwards)
    box = lambda *b: g.rectangles(spark.createDataFrame([tuple(map(float, b))], "west double, south double, east double, north double"), 0, 6)
    assert crawl.overlap(box(10, 50, 30, 60), box(20, 55, 40, 70)).count() == 7
    with pytest.raises(ValueError):
        crawl.overlap(box(10, 50, 30, 60), box(100, 55, 120, 70))


def test_rendered_coverage(spark):
    import re

    rect = spark.createDataFrame([(6, 10, 14, 20, 22)], "z int, x0 int, x1 int, y0 int, y1 int")

    def answer(url, headers):
        w, h = (int(re.search(rf"{k}=(\d+)", url).group(1)) for k in ("width", "height"))
        a = np.zeros((h, w, 4), dtype=np.uint8)
        a[-1, -1, 3] = 9
        return 200, png.encode(a), {}

    got = service.rendered(rect, "http://x", "c", 4, answer, most=8)
    drawn = {(r.px, r.py) for r in got.where("a > 0").collect()}
    assert got.count() == 15 and drawn == {(1, 1), (3, 1), (4, 1), (1, 2), (3, 2), (4, 2)}
    for wrong in (lambda url, headers: (500, b"no", {}), lambda url, headers: (200, png.encode(np.zeros((8, 8, 4), dtype=np.uint8)), {})):
        with pytest.raises(Exception, match="not an image|an image of"):
            service.rendered(rect.withColumn("x1", F.lit(12)), "http://x", "c", 4, wrong, most=16).count()


def test_modes_over_http(spark, tmp_path, capsys):
    import json
    import re
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    from quadloom.__main__ import main
    from quadloom.plans import build

    paper = png.encode(np.full((256, 256, 4), 255, dtype=np.uint8))
    asked = []

    class Service(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            code, body = 200, paper
            asked.append(self.path)
            if "GetTile" in self.path:
                z, y, x = map(int, re.search(r"tilematrix=M:(\d+)&tilerow=(\d+)&tilecol=(\d+)", self.path).groups())
                code = 200 if x == y else 404
            elif "layers=cov" in self.path:
                w, h = (int(re.search(rf"{k}=(\d+)", self.path).group(1)) for k in ("width", "height"))
                a = np.zeros((h, w, 4), dtype=np.uint8)
                a[h // 2, w // 2 - 16 : w // 2 + 1, 3] = 255  # two cells of 56
                body = png.encode(a)
            self.send_response(code)
            self.send_header("Content-Length", str(len(body) if code == 200 else 0))
            self.end_headers()
            if code == 200:
                self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{server.server_port}/s"
        world = ["--base", base, "--layer", "one", "--matrix", "M", "--bbox=-179,-80,179,80", "--zmin", "1", "--zmax", "3"]
        diagonal = {(z, x, x) for z in (1, 2, 3) for x in range(1 << z)}
        a, b, c = (str(tmp_path / f"{n}.mbtiles") for n in "abc")
        assert main(["crawl", a, *world, "--mode", "mask"]) == 0 and places(build.load(spark, a)) == diagonal
        assert main(["crawl", b, *world, "--mode", "descent", "--zmax", "2"]) == 0
        asked.clear()
        assert main(["crawl", b, *world, "--mode", "full", "--repair"]) == 0 and places(build.load(spark, b)) == diagonal
        assert len(asked) == len(set(asked)) == 4 + 16 + 64 - 2 - 4
        with pytest.raises(ValueError):
            main(["crawl", c, "--kind", "wms", *world, "--mode", "coverage"])
        area = ["crawl", c, "--kind", "wms", "--base", base, "--layer", "one", "--bbox=10,50,40,70", "--extent=10,50,40,70", "--zmin", "5", "--zmax", "7", "--mode", "coverage", "--coverage-layer", "cov", "--coverage-zoom", "6"]
        assert main(area) == 0
        got = places(build.load(spark, c))
        assert [sum(p[0] == z for p in got) for z in (6, 7)] == [12, 48] and any(p[0] == 5 for p in got)
        asked.clear()
        capsys.readouterr()
        assert main(area) == 0 and not asked and json.loads(capsys.readouterr().out.splitlines()[-1]) == {"complete": 7}
    finally:
        server.shutdown()
