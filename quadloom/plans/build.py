"""The whole run: for each layer refresh, decide, strip, rebuild, verify, publish; one layer's failure leaves the others."""

from __future__ import annotations

import fcntl
import os
import shutil
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.text import STAGES
from ..operators import grid, pyramid
from ..sources import files, mbtiles
from . import decide, publish, refresh, strip


class Failed(RuntimeError):
    """A layer can't be built or published."""


@dataclass(frozen=True)
class Layer:
    """A recipe: which stages a layer goes through."""

    name: str
    stages: tuple[str, ...] = ()
    radius: int = strip.RADIUS
    white: int = strip.WHITE
    limit: int = strip.LIMIT

    @property
    def stamp(self) -> str | None:
        on = [s for s in STAGES if s in self.stages]
        return f"nodata-r{self.radius}-w{self.white}-n{self.limit}:{'+'.join(on)}" if on else None


@dataclass
class Outcome:
    published: list[str] = field(default_factory=list)
    current: list[str] = field(default_factory=list)
    failed: list[tuple[str, str]] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)


@contextmanager
def locked(*folders: str | Path) -> Iterator[None]:
    """One run at a time over archives and work."""
    held = []
    try:
        for f in folders:
            if not str(f):
                raise Failed("an empty path is no folder")
            h = open(Path(f) / ".lock", "w")  # noqa: SIM115
            held.append(h)
            try:
                fcntl.flock(h, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except OSError as e:
                raise Failed(f"{f} is in use by another run") from e
        yield
    finally:
        for h in held:
            h.close()


def probe(work: str | Path, out: str | Path) -> None:
    """Refuses folders between which a file can't be renamed."""
    a, b = Path(work) / ".probe", Path(out) / ".probe"
    try:
        a.write_text("")
        os.replace(a, b)
    except OSError as e:
        raise Failed(f"{work} and {out} are not on one file system") from e
    finally:
        a.unlink(missing_ok=True)
        b.unlink(missing_ok=True)


def enough_disk(archives: list[Path], work: str | Path) -> None:
    need = 2 * max((f.stat().st_size for f in archives), default=0)
    free = shutil.disk_usage(work).free
    if free < need:
        raise Failed(f"{free} bytes are free, {need} are needed")


def load(spark: SparkSession, path: str | Path, keys: bool = False, zooms: list[int] | None = None) -> DataFrame:
    """An archive's tiles, or only their keys; of some zooms, if they are named."""
    return spark.read.format("mbtiles").options(path=str(path), keysonly=str(keys).lower(), zooms=",".join(map(str, zooms or []))).load()


def reason(spark: SparkSession, layer: Layer, meta: dict, deepest: int, current: dict | None, forced: bool) -> str | None:
    """Why a layer is built, by the rule query."""
    current = current or {}
    row = {"edition": meta.get("source_updated"), "stamp": layer.stamp, "zoom": str(deepest), "revision": meta.get("pipeline_revision") or "0"}
    was = {"edition": current.get("source_updated"), "stamp": current.get("nodata_stripped"), "zoom": current.get("downscale_source_zoom"), "revision": current.get("pipeline_revision") or "0"}
    pair = lambda k: (F.lit(row[k]), F.lit(was[k]))
    why = decide.reason(F.lit(forced), F.lit("published" if current else None), pair("edition"), pair("stamp"), pair("zoom"), pair("revision"))
    return spark.range(1).select(why.alias("why")).first()["why"]


def build(spark: SparkSession, archive: Path, layer: Layer, target: Path) -> None:
    """A processed copy of an archive: its deepest zoom stripped, the zooms below rebuilt."""
    meta = mbtiles.read_metadata(archive)
    tiles = load(spark, archive)
    zooms = load(spark, archive, keys=True).select("z").distinct()
    deepest = zooms.agg(F.max("z")).first()[0]
    if deepest is None:
        raise Failed(f"{archive.name} holds no tiles")
    top = load(spark, archive, zooms=[deepest])
    low = pyramid.floor_zoom(zooms, meta).first()["floor"]
    if layer.stages:
        top = strip.stripped(top, list(layer.stages), layer.radius, layer.white, layer.limit)
        whole = top
    else:
        whole = tiles
    out = pyramid.rebuilt(whole.where(F.col("z") >= low), deepest, low)
    out.write.format("mbtiles").option("path", str(target)).mode("overwrite").save()
    stamps = {"minzoom": str(low), "maxzoom": str(deepest), "downscaled": "1", "downscale_source_zoom": str(deepest), "downscale_filter": "box"}
    if layer.stamp:
        stamps["nodata_stripped"] = layer.stamp
    if not meta.get("bounds"):
        b = grid.leaf_bounds(load(spark, target, keys=True)).select(text.bounds_text(*[F.col(c) for c in ("west", "south", "east", "north")]).alias("b"))
        stamps["bounds"] = b.first()["b"] or ""
    mbtiles.set_metadata(target, {k: v for k, v in meta.items() if k != "pyramid_pending"} | stamps)


def verify(spark: SparkSession, target: Path, layer: Layer, baseline: int, deepest: int | None = None) -> None:
    """By the rules of ``decide.findings``, against the number of tiles before the run, so that a mass deletion is noticed."""
    meta = mbtiles.read_metadata(target)
    deepest = int(meta["maxzoom"]) if deepest is None else deepest
    n = load(spark, target, keys=True, zooms=[deepest]).count()
    made = spark.createDataFrame([(layer.name, n, baseline, meta, layer.stamp, deepest)], "layer string, tiles long, baseline long, metadata map<string,string>, stamp string, zoom int")
    problems = decide.findings(made).first()["problems"]
    if problems:
        raise Failed("; ".join(problems))


def refreshed(spark: SparkSession, archive: Path, fetch: Callable[[DataFrame], DataFrame], today: str) -> dict:
    """Asks for every held tile, applies the answers, and advances watermark, editions and revision."""
    meta = mbtiles.read_metadata(archive)
    tiles = load(spark, archive)
    from ..session import settled

    answers = settled(fetch(load(spark, archive, keys=True)))
    counts = refresh.report(answers).first().asDict()
    new = settled(refresh.applied(tiles, answers))
    new.write.format("mbtiles").option("path", str(archive)).mode("overwrite").save()
    e = refresh.edition_extent(answers, meta.get("source_updated"), meta.get("source_updated_oldest")).first()
    done = {"downloaded": refresh.watermark(meta.get("downloaded", ""), today, counts["errors"]), "pipeline_revision": str(refresh.revised(int(meta.get("pipeline_revision") or 0), counts["updated"], counts["removed"]))}
    done |= {k: e[k] for k in ("source_updated", "source_updated_oldest") if e[k]}
    mbtiles.set_metadata(archive, meta | done)
    return counts


def run(spark: SparkSession, layers: list[Layer], archives: str | Path, work: str | Path, out: str | Path, forced: bool = False, dry: bool = False, fetch: Callable | None = None, today: str = "") -> Outcome:
    """All layers in turn; what is built is published at once."""
    spark.dataSource.register(mbtiles.MBTiles)
    done = Outcome()
    with locked(archives, work):
        probe(work, out)
        publish.sweep(work)
        found = files.find_archives(archives)
        enough_disk(list(found.values()), work)
        for layer in layers:
            began = time.time()
            try:
                if layer.name not in found:
                    raise Failed("no archive")
                archive = found[layer.name]
                deepest = load(spark, archive, keys=True).agg(F.max("z")).first()[0]
                if deepest is None:
                    raise Failed("an empty archive")
                baseline = load(spark, archive, keys=True, zooms=[deepest]).count()
                if fetch is not None and not dry:
                    refreshed(spark, archive, fetch, today)
                meta = mbtiles.read_metadata(archive)
                prefix = publish.named(meta)[: -len("-0000-00-00.mbtiles")]
                current = files.published(out, prefix)
                why = reason(spark, layer, meta, deepest, mbtiles.read_metadata(current) if current else None, forced)
                if why is None:
                    done.current.append(layer.name)
                    continue
                if dry:
                    done.published.append(f"{layer.name}: {why}")
                    continue
                target = Path(work) / f"{prefix}.mbtiles.partial"
                build(spark, archive, layer, target)
                verify(spark, target, layer, baseline, deepest)
                manifest = publish.publish([target], out)
                target.unlink()
                done.published.append(f"{layer.name}: {why} ({len(manifest['charts'])} charts)")
            except Exception as e:  # noqa: BLE001  isolated and reported
                done.failed.append((layer.name, f"{type(e).__name__}: {e}"))
            finally:
                done.seconds[layer.name] = round(time.time() - began, 1)
    return done
