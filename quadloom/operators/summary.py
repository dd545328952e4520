"""Counts, extents and estimates over tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Tiles that make a zoom worth opening on; novelty verdicts; a sane loss.
CENTRE_TILES, GENUINE, UPSCALED, LEAST_KEPT = 16, 0.03, 0.01, 0.5


def levels(tiles: DataFrame, *by: str) -> DataFrame:
    return tiles.groupBy(*by, "z").agg(F.count(F.lit(1)).alias("n"))


def totals(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.count_distinct("z").alias("levels"), F.count(F.lit(1)).alias("tiles"))


def status_report(fetched: DataFrame, *states: str) -> DataFrame:
    """Per zoom and in total (null zoom) how many requests ended in each state."""
    counts = [F.count_if(F.col("status") == s).cast("long").alias(s) for s in states]
    return fetched.rollup("z").agg(*counts, F.count(F.lit(1)).alias("requested"))


def centre(tiles: DataFrame) -> DataFrame:
    """The tile to open on: of the first zoom with ``CENTRE_TILES`` (else the deepest) the one nearest to the mean; ties by place."""
    n = tiles.groupBy("z").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"))
    at = n.agg(F.coalesce(F.min(F.when(F.col("n") >= CENTRE_TILES, F.col("z"))), F.max("z")).alias("z"))
    best = tiles.join(F.broadcast(n.join(at, "z")), "z")
    away = F.pow(F.col("x") - F.col("mx"), F.lit(2)) + F.pow(F.col("y") - F.col("my"), F.lit(2))
    return best.agg(F.min_by(F.struct("z", "x", "y"), F.struct(away.alias("d"), "x", "y")).alias("t")).select("t.*")


def edition_extent(editions: DataFrame, prior: tuple[str | None, str | None] = (None, None), *by: str) -> DataFrame:
    """Newest and oldest edition day, merged with what was known; days compare as text."""
    low, high = F.min("day"), F.max("day")
    return editions.groupBy(*by).agg(F.greatest(high, F.lit(prior[0])).alias("source_updated"), F.least(low, F.lit(prior[1])).alias("source_updated_oldest"))


def cost(sample: DataFrame, implied: DataFrame, requests_per_second: float) -> DataFrame:
    """Per zoom: share of requests with content, bytes a tile with deviation and error, bytes and hours implied, and running bytes."""
    s = sample.groupBy("z").agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("bytes") > 0).alias("hits"), F.avg(F.when(F.col("bytes") > 0, F.col("bytes"))).alias("mean"), F.stddev_samp(F.when(F.col("bytes") > 0, F.col("bytes"))).alias("sd"))
    j = s.join(implied, "z")
    j = j.withColumns({"rate": F.col("hits") / F.col("sampled"), "error": F.col("sd") / F.col("mean") / F.sqrt("hits")})
    j = j.withColumns({"bytes": F.col("tiles") * F.col("rate") * F.col("mean"), "hours": F.col("tiles") / requests_per_second / 3600})
    return j.withColumn("running_bytes", F.sum("bytes").over(Window.orderBy("z")))


def saved_percent(asked: Column, all_: Column) -> Column:
    """100 * (1 - asked / all); 0 where there was nothing to ask."""
    return F.when(all_ > 0, 100.0 * (1 - asked / all_)).otherwise(0.0)


def novelty_levels(scores: DataFrame) -> DataFrame:
    """Per transition: median, mean, 90th percentile, exact share and verdict."""
    out = scores.groupBy("z").agg(F.count(F.lit(1)).alias("n"), F.median("novelty").alias("median"), F.avg("novelty").alias("mean"), F.percentile("novelty", F.lit(0.9)).alias("p90"), F.avg("same").alias("same"))
    return out.withColumn("verdict", verdict(F.col("median")))


def verdict(median: Column) -> Column:
    return F.when(median >= GENUINE, "genuine").when(median < UPSCALED, "upscaled").otherwise("marginal")


def native_zoom(verdicts: DataFrame, lowest: int) -> DataFrame:
    """The deepest zoom whose step is not mere upscaling."""
    return verdicts.agg(F.coalesce(F.max(F.when(F.col("verdict") != "upscaled", F.col("z"))), F.lit(lowest)).alias("native_zoom"))


def extremes(scores: DataFrame) -> DataFrame:
    """Per transition the tiles of lowest and highest novelty; ties by place."""
    at = F.struct("novelty", "x", "y")
    return scores.groupBy("z").agg(F.min(at).alias("low"), F.max(at).alias("high"))


def too_few(after: Column, before: Column) -> Column:
    return after < before * LEAST_KEPT
