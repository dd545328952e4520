"""Archive files on the driver's disk: discovery and integrity."""

from __future__ import annotations

import struct
from pathlib import Path

MAGIC = b"SQLite format 3\x00"


class Damaged(ValueError):
    """Not a whole database file."""


def check_intact(path: str | Path) -> None:
    """Header, page count and pending log of a database file; raises ``Damaged``."""
    path = Path(path)
    with path.open("rb") as f:
        head = f.read(100)
    if len(head) < 100 or head[:16] != MAGIC:
        raise Damaged(f"{path.name}: not a database")
    size = struct.unpack(">H", head[16:18])[0]
    size = 65536 if size == 1 else size
    changed, pages, valid_for = struct.unpack(">I", head[24:28])[0], struct.unpack(">I", head[28:32])[0], struct.unpack(">I", head[92:96])[0]
    whole = path.stat().st_size
    if whole % size or (changed == valid_for and pages and pages * size > whole):
        raise Damaged(f"{path.name}: {whole} bytes are not {pages} pages of {size}")
    log = path.with_name(path.name + "-wal")
    if log.exists() and log.stat().st_size:
        raise Damaged(f"{path.name}: changes are still in its log")


def find_archives(folder: str | Path, pattern: str = "*.mbtiles") -> dict[str, Path]:
    """Archives by their source layer; unreadable files are passed over, two of one layer refused."""
    import sqlite3

    from .mbtiles import read_metadata

    if not str(folder):
        raise ValueError("an empty path is no folder")
    out: dict[str, Path] = {}
    for f in sorted(Path(folder).glob(pattern)):
        try:
            layer = read_metadata(f).get("source_layer")
        except sqlite3.DatabaseError:
            continue
        if layer in out:
            raise ValueError(f"{f.name} and {out[layer].name} are both {layer}")
        if layer:
            out[layer] = f
    return out


def published(folder: str | Path, prefix: str) -> Path | None:
    """The file of a layer that sorts last."""
    return max(Path(folder).glob(f"{prefix}-*.mbtiles"), default=None, key=lambda f: f.name)
