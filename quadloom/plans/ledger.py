"""What a crawl keeps between runs: its footprint, how far it came and the tiles that failed.

Tables lie as Parquet in a folder that driver and executors share. Each write is
a new generation, which counts once it is whole; a run that dies in between
leaves the one before.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relations
from . import crawl, refresh

KEYS = ["z", "x", "y"]


def shape(*parts: object) -> str:
    """What a finished zoom was measured against; another shape of run starts anew."""
    return "|".join(map(str, parts))


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _generations(self, name: str) -> list[int]:
        glob, files = self._path(f"{self.folder}/{name}/*/_SUCCESS")
        return sorted(int(s.getPath().getParent().getName()) for s in files.globStatus(glob) or [])

    def read(self, name: str) -> DataFrame | None:
        held = self._generations(name)
        return self.spark.read.parquet(f"{self.folder}/{name}/{held[-1]}") if held else None

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """A new generation, which may be made from the last one; older ones go once it is whole."""
        held = self._generations(name)
        now = held[-1] + 1 if held else 0
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/{now}")
        for old in held:
            path, files = self._path(f"{self.folder}/{name}/{old}")
            files.delete(path, True)
        return self.read(name)

    def footprint(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The cells kept under a key that names all they depend on; built where there are none."""
        name = f"footprint-{sha256(key.encode()).hexdigest()[:16]}"
        held = self.read(name)
        return self.write(name, build()) if held is None or held.isEmpty() else held

    def progress(self) -> refresh.Progress:
        held = self.read("progress")
        row = None if held is None else held.first()
        return refresh.Progress(row["zoom"], row["shape"]) if row else refresh.Progress(None, None)

    def mark(self, zoom: int, run: str) -> None:
        self.write("progress", self.spark.createDataFrame([(zoom, run)], "zoom int, shape string").coalesce(1))

    def failed(self) -> DataFrame:
        held = self.read("failed")
        return self.spark.createDataFrame([], "z int, x int, y int") if held is None else held

    def record(self, answers: DataFrame) -> DataFrame:
        """The retry queue after the answers."""
        return self.write("failed", refresh.failed(self.failed(), answers))


def coverage(ledger: Ledger, run: str, footprint: DataFrame, footprint_z: int, fetch: crawl.Fetch, low: int, high: int, store: Callable[[DataFrame], None], limits: DataFrame | None = None, stored: DataFrame | None = None) -> list[DataFrame]:
    """Answers zoom by zoom, each stored and its failures recorded before the next one is asked.

    What failed before is asked first. A run of the same shape goes on after the
    last zoom marked; a zoom is marked only while nothing is left in the queue,
    so a failure holds the mark back until it is resolved.
    """
    out, queue = [], ledger.failed()
    if not queue.isEmpty():
        out.append(crawl.settled(crawl.retried(queue.withColumn("status", F.lit("err")), fetch)))
        store(out[-1])
        ledger.record(out[-1])
    after = ledger.progress().resume_after(run)
    for z in range(low if after is None else after + 1, high + 1):
        ask = crawl.clipped(crawl.eligible(footprint, footprint_z, z), limits)
        ask = ask if stored is None else relations.todo(ask, stored)
        answers = crawl.settled(crawl.retried(crawl.settled(fetch(ask)), fetch))
        store(answers)
        out.append(answers)
        if ledger.record(answers).isEmpty():
            ledger.mark(z, run)
    return out
