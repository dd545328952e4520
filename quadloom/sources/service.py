"""Tile services: capabilities, addresses and a fetcher with an injectable transport."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import png
from ..functions import text as t

RETRY, RETRIES, BACKOFF = {429, 500, 502, 503, 504}, 4, 0.5
ANSWERS = "z int, x int, y int, status string, data binary, last_modified string, served_at string"


@dataclass(frozen=True)
class Source:
    """A tile service: ``kind`` wmts or wms, and how it behaves."""

    kind: str
    base: str
    layer: str
    matrix: str = ""
    conditional: bool = False
    empty_on_4xx: bool = True
    extent: tuple[float, float, float, float] | None = None

    def address(self, z: Column, x: Column, y: Column) -> Column:
        if self.kind == "wmts":
            return t.tile_url(self.base, F.lit(self.layer), z, y, x, self.matrix)
        from ..functions.geometry import bbox

        return t.map_url(self.base, F.lit(self.layer), *bbox(z, x, y), F.lit(256), F.lit(256))


def limits(capabilities: DataFrame, layer: str, column: str = "xml", matrix: str | None = None) -> DataFrame:
    """``z, x0, x1, y0, y1`` from the TileMatrixLimits of one layer in a capabilities text; of one matrix set if it is named."""
    part = F.explode(F.regexp_extract_all(column, F.lit(r"(?s)<Layer>.*?</Layer>"), 0))
    one = capabilities.select(part.alias("layer")).where(F.contains("layer", F.lit(f"<ows:Identifier>{layer}</ows:Identifier>")))
    if matrix is not None:
        links = F.explode(F.regexp_extract_all("layer", F.lit(r"(?s)<TileMatrixSetLink>.*?</TileMatrixSetLink>"), 0))
        one = one.select(links.alias("layer")).where(F.contains("layer", F.lit(f"<TileMatrixSet>{matrix}</TileMatrixSet>")))
    each = one.select(F.explode(F.regexp_extract_all("layer", F.lit(r"(?s)<TileMatrixLimits>.*?</TileMatrixLimits>"), 0)).alias("m"))
    number = lambda tag: F.regexp_extract("m", rf"<{tag}>(\d+)</{tag}>", 1).cast("int")
    return each.select(F.regexp_extract("m", r"<TileMatrix>[^<]*?(\d+)</TileMatrix>", 1).cast("int").alias("z"), number("MinTileCol").alias("x0"), number("MaxTileCol").alias("x1"), number("MinTileRow").alias("y0"), number("MaxTileRow").alias("y1"))


def stated_limits(capabilities: DataFrame, source: Source, column: str = "xml") -> DataFrame:
    """The limits of a source's layer in its matrix set; a service that states none is refused."""
    out = limits(capabilities, source.layer, column, source.matrix or None)
    if out.isEmpty():
        raise LookupError(f"no limits for {source.layer} in {source.matrix or 'any matrix set'}")
    return out


def classify(code: int, body: bytes | None, empty_on_4xx: bool) -> str:
    """ok, blank (a tile without a visible pixel), outside, notmodified or err."""
    if code == 304:
        return "notmodified"
    if code in (400, 404) and empty_on_4xx:
        return "outside"
    if code != 200 or not body:
        return "err"
    try:
        return "ok" if png.decode(body)[..., 3].any() else "blank"
    except ValueError:
        return "err"


def over_http(timeout: float = 30.0) -> Callable:
    """A transport over urllib: ``get(url, headers) -> (code, body, headers)``."""

    def get(url: str, headers: dict) -> tuple[int, bytes | None, dict]:
        from urllib.error import HTTPError, URLError
        from urllib.request import Request, urlopen

        try:
            with urlopen(Request(url, headers=headers), timeout=timeout) as r:
                return r.status, r.read(), dict(r.headers)
        except HTTPError as e:
            return e.code, None, dict(e.headers)
        except (URLError, TimeoutError):
            return 0, None, {}

    return get


class Unrendered(RuntimeError):
    """A part of a rendered coverage that can't be had; left out it would be a hole that prunes tiles unseen."""


def rendered(rectangle: DataFrame, base: str, layer: str, over: int, transport: Callable, most: int = 2048, tries: int = 3) -> DataFrame:
    """``px, py, a``: whether a coverage layer draws anything in each tile of one rectangle (``z, x0, x1, y0, y1``), counted from its corner.

    The rectangle is asked for in images of at most ``most`` pixels a side with
    ``over`` pixels a tile and way. An image that isn't one or has another size
    is asked for again, and fails the job after the last try.
    """
    from ..functions.geometry import bbox

    step = max(1, most // over)
    corner = rectangle.select("*", F.explode(F.sequence("x0", "x1", F.lit(step))).alias("x")).select("*", F.explode(F.sequence("y0", "y1", F.lit(step))).alias("y"))
    part = corner.withColumns({"nx": F.least(F.lit(step), F.col("x1") - F.col("x") + 1), "ny": F.least(F.lit(step), F.col("y1") - F.col("y") + 1)})
    box = bbox(F.col("z"), F.col("x"), F.col("y"), F.col("nx"), F.col("ny"))
    url = t.map_url(base, F.lit(layer), *box, F.col("nx") * over, F.col("ny") * over)

    def drawn(url: str, nx: int, ny: int):
        for _ in range(tries):
            code, body, _headers = transport(url, {})
            try:
                image = png.decode(body or b"")
            except ValueError:
                why = f"{code}, not an image"
                continue
            if image.shape[:2] == (ny * over, nx * over):
                return image[..., 3].reshape(ny, over, nx, over).max(axis=(1, 3))
            why = f"an image of {image.shape[1]} x {image.shape[0]}"
        raise Unrendered(f"{url}: {why}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for px, py, nx, ny, url in b.itertuples(index=False):
                a = drawn(url, nx, ny)
                yield pd.DataFrame([(px + i, py + j, int(a[j, i])) for j in range(ny) for i in range(nx)], columns=["px", "py", "a"])

    asked = part.select((F.col("x") - F.col("x0")).alias("px"), (F.col("y") - F.col("y0")).alias("py"), "nx", "ny", url.alias("url"))
    return asked.mapInPandas(run, "px int, py int, a int")


def fetcher(source: Source, transport: Callable, since: str | None = None, wait: Callable = time.sleep) -> Callable[[DataFrame], DataFrame]:
    """A fetch function for ``plans.crawl``; temporary failures are asked again with growing pauses."""
    headers = {"If-Modified-Since": since} if since else {}

    def ask(url: str) -> tuple[int, bytes | None, dict]:
        for k in range(RETRIES + 1):
            code, body, got = transport(url, headers)
            if code not in RETRY and code != 0 or k == RETRIES:
                break
            wait(BACKOFF * 2**k)
        return code, body, got

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for z, x, y, url in b.itertuples(index=False):
                code, body, got = ask(url)
                status = classify(code, body, source.empty_on_4xx)
                rows.append((z, x, y, status, body if status == "ok" else None, got.get("Last-Modified"), got.get("Date")))
            yield pd.DataFrame(rows, columns=["z", "x", "y", "status", "data", "last_modified", "served_at"])

    def fetch(candidates: DataFrame) -> DataFrame:
        url = source.address(F.col("z"), F.col("x"), F.col("y"))
        return candidates.select("z", "x", "y", url.alias("url")).mapInPandas(run, ANSWERS)

    return fetch


def narrowed(answers: DataFrame) -> DataFrame:
    """Blank and outside as one: empty."""
    return answers.withColumn("status", F.when(F.col("status").isin("blank", "outside"), "empty").otherwise(F.col("status")))


def masked(answers: DataFrame) -> DataFrame:
    """Statuses of a crawl by masks: content, placeholder (blank), outside, err."""
    return answers.withColumn("status", F.when(F.col("status") == "ok", "content").when(F.col("status") == "blank", "placeholder").otherwise(F.col("status")))
