"""The "mbtiles" data source: tile archives in SQLite files, read in column ranges and written by zoom.

    spark.dataSource.register(MBTiles)
    spark.read.format("mbtiles").option("path", "/shared/a.mbtiles").load()
    df.write.format("mbtiles").option("path", "/shared/b.mbtiles").mode("overwrite").save()

Rows are ``z, x, y, tile_data`` with y from the north. ``option("keysonly", "true")``
leaves out the blobs, which SQLite then doesn't touch, and ``option("zooms", "3,4")``
reads those zooms only. Filters are not pushed: in Spark 4.1.2 a plan that read
one DataFrame under two conditions lost rows with it in tests. SQLite needs files that
every task can open, so the path lies on a file system that all executors
mount. Each write task fills a part file beside the target; the commit merges
them and renames the result into place, so a failed or repeated task leaves
nothing behind.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from contextlib import closing
from pathlib import Path
from urllib.parse import quote

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

KEYS = "z int, x int, y int"
SCHEMA = f"{KEYS}, tile_data binary"
DDL = [
    "CREATE TABLE IF NOT EXISTS tiles (zoom_level INTEGER, tile_column INTEGER, tile_row INTEGER, tile_data BLOB)",
    "CREATE UNIQUE INDEX IF NOT EXISTS tile_index ON tiles (zoom_level, tile_column, tile_row)",
    "CREATE TABLE IF NOT EXISTS metadata (name TEXT PRIMARY KEY, value TEXT)",
]
PROVENANCE = ("source", "source_layer")


def uri(path: str | Path, mode: str = "ro") -> str:
    """A database address in which nothing of the path can pass for a parameter."""
    return f"file:{quote(str(Path(path).absolute()))}?mode={mode}"


def connect(path: str | Path, mode: str = "ro") -> sqlite3.Connection:
    return sqlite3.connect(uri(path, mode), uri=True)


def read_metadata(path: str | Path) -> dict[str, str]:
    with closing(connect(path)) as db:
        return dict(db.execute("SELECT name, value FROM metadata"))


class MixedSources(ValueError):
    """An archive of another source."""


def set_metadata(path: str | Path, values: dict[str, str], defaults: dict[str, str] | None = None) -> None:
    """Writes values; defaults only where a key is missing. Provenance may not change under existing tiles."""
    with closing(connect(path, "rwc")) as db, db:
        for ddl in DDL:
            db.execute(ddl)
        held = dict(db.execute("SELECT name, value FROM metadata"))
        if db.execute("SELECT 1 FROM tiles LIMIT 1").fetchone():
            for k in PROVENANCE:
                if held.get(k) and values.get(k) and held[k] != values[k]:
                    raise MixedSources(f"{path} holds {held[k]}, not {values[k]}")
        db.executemany("INSERT OR IGNORE INTO metadata VALUES (?, ?)", (defaults or {}).items())
        db.executemany("INSERT OR REPLACE INTO metadata VALUES (?, ?)", values.items())


class _Range(InputPartition):
    def __init__(self, path: str, z: int, low: int, high: int):
        super().__init__((path, z, low, high))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.tiles = int(options.get("tilesperpartition", 4096))
        self.zooms = {int(z) for z in options["zooms"].split(",")} if options.get("zooms") else None
        self.blobs = options.get("keysonly") != "true"

    def partitions(self) -> list[_Range]:
        out = []
        for path in self.paths:
            with closing(connect(path)) as db:
                for z, n, low, high in db.execute("SELECT zoom_level, count(*), min(tile_column), max(tile_column) FROM tiles GROUP BY zoom_level"):
                    if self.zooms is not None and z not in self.zooms:
                        continue
                    step = max(1, -(-(high - low + 1) // max(1, -(-n // self.tiles))))
                    out += [_Range(path, z, a, min(a + step - 1, high)) for a in range(low, high + 1, step)]
        return out

    def read(self, partition: _Range | None) -> Iterator[tuple]:
        if partition is None:  # what Spark makes of no partitions
            return
        path, z, low, high = partition.value
        with closing(connect(path)) as db:
            what = "tile_column, tile_row" + ", tile_data" * self.blobs
            for x, row, *blob in db.execute(f"SELECT {what} FROM tiles WHERE zoom_level = ? AND tile_column BETWEEN ? AND ?", (z, low, high)):
                yield z, x, (1 << z) - 1 - row, *blob


class _Part(WriterCommitMessage):
    def __init__(self, path: str):
        self.path = path


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, rows: Iterator) -> _Part:
        import uuid

        part = f"{self.path}.{uuid.uuid4().hex}.part"
        with closing(connect(part, "rwc")) as db, db:
            db.execute(DDL[0])
            db.executemany("INSERT INTO tiles VALUES (?, ?, ?, ?)", ((r.z, r.x, (1 << r.z) - 1 - r.y, bytes(r.tile_data)) for r in rows))
        return _Part(part)

    def commit(self, messages: list) -> None:
        target, build = Path(self.path), f"{self.path}.partial"
        Path(build).unlink(missing_ok=True)
        if target.exists() and not self.overwrite:
            import shutil

            shutil.copyfile(target, build)
        with closing(connect(build, "rwc")) as db:
            for ddl in DDL:
                db.execute(ddl)
            for m in messages:
                db.execute("ATTACH ? AS part", (uri(m.path),))
                with db:
                    db.execute("INSERT OR IGNORE INTO tiles SELECT * FROM part.tiles")
                db.execute("DETACH part")
        os.replace(build, target)
        self._clear(messages)

    def abort(self, messages: list) -> None:
        self._clear(messages)

    @staticmethod
    def _clear(messages: list) -> None:
        for m in messages:
            if m is not None:
                Path(m.path).unlink(missing_ok=True)


class MBTiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mbtiles"

    def schema(self) -> str:
        return KEYS if self.options.get("keysonly") == "true" else SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)
