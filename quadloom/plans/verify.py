"""Checks of a pruned crawl against one that asks for everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import relations

SLACK = 0.25


def box_verdict(relation: Column, failed: Column, content: Column, asked: Column, all_: Column, missed: Column, extra: Column) -> Column:
    """What a test box shows; the first finding counts. ``relation``: inside, straddle or outside the footprint."""
    return (
        F.when(failed > 0, "errors")
        .when((relation == "outside") & (asked > 0), "requests outside")
        .when((relation != "outside") & (content == 0), "no content")
        .when((relation == "straddle") & (asked >= all_), "nothing pruned")
        .when((relation == "inside") & (asked < all_), "pruned inside")
        .when(extra > 0, "extra")
        .when(missed > 0, "missed")
        .otherwise("pass")
    )


def first_missed(full: DataFrame, pruned: DataFrame, n: int) -> DataFrame:
    """Per zoom the first ``n`` tiles that only the full crawl has."""
    from pyspark.sql import Window

    gone = relations.todo(full.select("z", "x", "y").distinct(), pruned)
    rank = F.row_number().over(Window.partitionBy("z").orderBy("x", "y"))
    return gone.withColumn("rank", rank).where(F.col("rank") <= n)


def footprint_checks(shipped: DataFrame, chunked: DataFrame, fine: DataFrame, levels: int) -> DataFrame:
    """One row: cells that depend on the chunking, fine cells not contained, and the shipped footprint's slack."""
    up = fine.select(F.shiftright("x", levels).alias("x"), F.shiftright("y", levels).alias("y")).distinct()
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    n = one(relations.symmetric_difference(shipped, chunked), "chunking").withColumn("k", F.lit(0))
    n = n.join(one(up.subtract(shipped), "uncontained").withColumn("k", F.lit(0)), "k").join(one(shipped, "cells").withColumn("k", F.lit(0)), "k").join(one(up, "reach").withColumn("k", F.lit(0)), "k")
    slack = F.col("cells") / F.col("reach") - 1
    return n.select("chunking", "uncontained", slack.alias("slack"), ((F.col("chunking") == 0) & (F.col("uncontained") == 0) & (slack <= SLACK)).alias("ok"))
