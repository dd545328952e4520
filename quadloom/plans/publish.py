"""Publishing files: plan, stage, verify, rename, retire, manifest. File work stays on the driver."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import sqlite3
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from ..sources.files import check_intact
from ..sources.mbtiles import read_metadata

NAME = re.compile(r"fi-[a-z0-9]+-\d{4}-\d{2}-\d{2}\.mbtiles")
SCHEMA = 1


class Unpublishable(RuntimeError):
    """Nothing has been changed."""


class PartiallyPublished(RuntimeError):
    """Some files are in place, others are not."""


@dataclass(frozen=True)
class Planned:
    source: Path
    name: str
    layer: str
    metadata: dict


def layer_of(meta: dict) -> str | None:
    """A file's layer name, from the first key that is neither missing nor empty."""
    return next((meta[k] for k in ("wmts_layer", "source_layer", "name") if meta.get(k)), None)


def slug(layer: str) -> str:
    """As ``functions.text.slug``, for one name on the driver."""
    return layer.lower().replace(" public", "").replace(" ", "").partition("erikois")[0]


def named(meta: dict) -> str:
    layer, edition = layer_of(meta), meta.get("source_updated")
    if not layer or not edition:
        raise Unpublishable("a file without layer or edition can't be named")
    name = f"fi-{slug(layer)}-{edition}.mbtiles"
    if not NAME.fullmatch(name):
        raise Unpublishable(f"{name} is not a publishable name")
    return name


def plan(sources: list[str | Path], folder: str | Path) -> list[Planned]:
    """Everything that can be refused is refused here, before the first file moves."""
    folder, out, seen = Path(folder), [], {}
    for s in map(Path, sources):
        if not s.is_file():
            raise Unpublishable(f"{s} is missing")
        if s.resolve().parent == folder.resolve():
            raise Unpublishable(f"{s} is already in the published folder")
        check_intact(s)
        meta = read_metadata(s)
        if meta.get("pyramid_pending"):
            raise Unpublishable(f"{s} lacks its lower zooms")
        name = named(meta)
        layer = name[: -len("-0000-00-00.mbtiles")]
        if layer in seen:
            raise Unpublishable(f"{s} and {seen[layer]} are of one layer")
        seen[layer] = s
        out.append(Planned(s, name, layer, meta))
    return out


def digest(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _replace(path: Path, content: str) -> None:
    part = path.with_name(path.name + ".tmp")
    with part.open("w", encoding="utf-8") as f:
        f.write(content)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def processing(meta: dict) -> str:
    steps = []
    if meta.get("nodata_stripped"):
        steps.append(meta["nodata_stripped"])
    if meta.get("downscaled"):
        steps.append(f"downscaled from z{meta.get('downscale_source_zoom') or '?'} ({meta.get('downscale_filter') or '?'})")
    return "; ".join(steps) or "none"


def entry(path: Path, meta: dict, name: str | None = None) -> dict:
    return {
        "filename": name or path.name, "layer": layer_of(meta), "name": meta.get("name"), "bytes": path.stat().st_size, "sha256": digest(path),
        "source_edition": meta.get("source_updated"), "source_edition_oldest": meta.get("source_updated_oldest"), "processing": processing(meta),
    }


def present(folder: Path) -> dict[Path, dict]:
    """Metadata of the published files that can be read; others are nobody's to list or retire."""
    out = {}
    for f in sorted(folder.glob("*.mbtiles")):
        if NAME.fullmatch(f.name):
            try:
                out[f] = read_metadata(f)
            except sqlite3.DatabaseError:
                continue
    return out


def retired(folder: Path, planned: list[Planned], keep: set[str] = frozenset()) -> list[Path]:
    """Older editions of the planned layers by the files' own metadata; an equal or newer one is never retired."""
    newest = {slug(layer_of(p.metadata)): p.metadata["source_updated"] for p in planned}
    names = {p.name for p in planned} | set(keep)

    def older(meta: dict) -> bool:
        layer, edition = layer_of(meta), meta.get("source_updated")
        return bool(layer and edition) and edition < newest.get(slug(layer), "")

    return [f for f, meta in present(folder).items() if f.name not in names and older(meta)]


def publish(sources: list[str | Path], folder: str | Path, pipeline: str = "", keep: set[str] = frozenset()) -> dict:
    """Copies beside, verifies the copies, renames them into place, retires older editions, then writes manifest and index."""
    from .site import index_page

    folder = Path(folder)
    planned = plan(sources, folder)
    names, staged = {p.name for p in planned}, []
    try:
        for p in planned:
            part = folder / f".{p.name}.partial"
            staged.append(part)
            shutil.copyfile(p.source, part)
            check_intact(part)
            if digest(part) != digest(p.source):
                raise Unpublishable(f"the copy of {p.source} differs")
        # All that reads files comes before the first rename.
        doomed = retired(folder, planned, keep)
        charts = [entry(part, p.metadata, p.name) for p, part in zip(planned, staged)]
        charts += [entry(f, meta) for f, meta in present(folder).items() if f.name not in names and f not in doomed]
        manifest = {"schema": SCHEMA, "generated": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "pipeline": pipeline, "charts": sorted(charts, key=lambda e: e["filename"])}
    except BaseException:
        for part in staged:
            part.unlink(missing_ok=True)
        raise
    done = []
    try:
        for p, part in zip(planned, staged):
            os.replace(part, folder / p.name)
            done.append(p.name)
        for old in doomed:
            old.unlink()
        _replace(folder / "manifest.json", json.dumps(manifest, indent=2, ensure_ascii=False) + "\n")
        _replace(folder / "index.html", index_page(manifest))
    except OSError as e:
        raise PartiallyPublished(f"in place: {done}; then {e}") from e
    finally:
        for part in staged:
            part.unlink(missing_ok=True)
    return manifest


def sweep(folder: str | Path, pattern: str = "*.partial") -> list[str]:
    """Deletes what an interrupted run left behind."""
    gone = sorted(Path(folder).glob(pattern))  # hidden files too
    for f in gone:
        f.unlink()
    return [f.name for f in gone]
