"""Refreshing an archive from conditional answers, with a failure-safe watermark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import relations, summary

KEYS = ["z", "x", "y"]


def route(status: Column) -> Column:
    """What an answer does to the archive."""
    return F.when(status == "ok", "updated").when(status == "empty", "removed").when(status == "err", "errors").otherwise("unchanged")


def report(answers: DataFrame) -> DataFrame:
    """``checked, updated, removed, errors`` in one row."""
    n = lambda s: F.count_if(route(F.col("status")) == s).cast("long").alias(s)
    return answers.agg(F.count(F.lit(1)).alias("checked"), n("updated"), n("removed"), n("errors"))


def applied(tiles: DataFrame, answers: DataFrame) -> DataFrame:
    """The archive after the answers: new content replaces, empty removes, the rest stays. Applying them twice changes nothing."""
    new = answers.where("status = 'ok'").select(*KEYS, F.col("data").alias("tile_data"))
    return relations.without(relations.replace(tiles, new), answers.where("status = 'empty'"))


def failed(queue: DataFrame, answers: DataFrame) -> DataFrame:
    """The retry queue after the answers: resolved tiles leave it, failed ones enter."""
    left = relations.without(queue.select(*KEYS), answers.where("status <> 'err'"))
    return left.unionByName(answers.where("status = 'err'").select(*KEYS)).distinct()


def watermark(current: str, today: str, errors: int) -> str:
    """The day from which the next refresh asks; it stands still while anything failed."""
    return today if errors == 0 else current


@dataclass(frozen=True)
class Progress:
    """How far a crawl came, and the shape of run that it belongs to."""

    completed_zoom: int | None
    run_shape: str | None

    def resume_after(self, shape: str) -> int | None:
        """The zoom to go on after, if the run is of the same shape."""
        return self.completed_zoom if shape == self.run_shape else None


def editions(answers: DataFrame) -> DataFrame:
    """``day`` per answer that carries dates (``last_modified``, ``served_at``)."""
    return answers.select(text.edition_day(F.col("last_modified"), F.col("served_at")).alias("day")).where("day IS NOT NULL")


def edition_extent(answers: DataFrame, newest: str | None, oldest: str | None) -> DataFrame:
    return summary.edition_extent(editions(answers), (newest, oldest))


def revised(revision: int, updated: int, removed: int) -> int:
    """A revision rises only if the archive changed."""
    return revision + (updated + removed > 0)
