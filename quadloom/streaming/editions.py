"""Incremental ingestion: answers arrive as files, archive and watermark follow.

``Trigger.AvailableNow`` turns a stream of answer files into the next increment
of a batch refresh: each micro-batch is applied with ``foreachBatch``, replaying
one changes nothing, and the edition extent is a running aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..plans import refresh
from ..sources.service import ANSWERS


def answers(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(ANSWERS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def extents(stream: DataFrame) -> DataFrame:
    """Newest and oldest edition day per zoom, as they stand."""
    day = text.edition_day(F.col("last_modified"), F.col("served_at"))
    dated = stream.select("z", day.alias("day")).where("day IS NOT NULL")
    return dated.groupBy("z").agg(F.max("day").alias("source_updated"), F.min("day").alias("source_updated_oldest"))


def hourly(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Answers per hour and status; rows later than ``late`` are left out."""
    at = stream.withColumn("at", text.http_timestamp(F.col("served_at")))
    return at.withWatermark("at", late).groupBy(F.window("at", "1 hour"), "status").agg(F.count(F.lit(1)).alias("n"))


def ingest(stream: DataFrame, checkpoint: str, load: Callable[[], DataFrame], store: Callable[[DataFrame], None], on_report: Callable[[dict], None]):
    """Starts a run over what is there: every micro-batch replaces, removes and reports."""

    def apply(batch: DataFrame, _: int) -> None:
        batch = batch.dropDuplicates(["z", "x", "y"])
        store(refresh.applied(load(), batch))
        on_report(refresh.report(batch).first().asDict())

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
