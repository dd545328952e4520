"""Set and key operations on tile tables: what is missing, what wins, what goes.

Tables are immutable, so inserts, updates and deletes are anti joins and
unions on the tile keys. Keys default to ``z, x, y``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["z", "x", "y"]


def todo(candidates: DataFrame, *done: DataFrame, on: list[str] = KEYS) -> DataFrame:
    """Candidates in none of the tables ``done``."""
    for d in done:
        candidates = candidates.join(d.select(*on), on, "left_anti")
    return candidates


def insert_missing(old: DataFrame, new: DataFrame, on: list[str] = KEYS) -> DataFrame:
    """The first write wins; of rows that are new twice, any one."""
    return old.unionByName(new.dropDuplicates(on).join(old.select(*on), on, "left_anti").select(*old.columns))


def replace(old: DataFrame, new: DataFrame, on: list[str] = KEYS, unique: bool = False) -> DataFrame:
    """The last write wins; of rows that are new twice, any one. ``unique`` says that no key is new twice, which saves a shuffle."""
    new = new if unique else new.dropDuplicates(on)
    return old.join(new.select(*on), on, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def without(tiles: DataFrame, gone: DataFrame, on: list[str] = KEYS) -> DataFrame:
    return tiles.join(gone.select(*on), on, "left_anti")


def merged_metadata(old: Column, new: Column) -> Column:
    """Two string maps; the second one's keys win."""
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)


def filled(made: DataFrame, original: DataFrame, low: int, high: int, on: list[str] = KEYS) -> DataFrame:
    """``made``, and the originals with ``low <= z < high`` where nothing was made."""
    return insert_missing(made, original.where((F.col("z") >= low) & (F.col("z") < high)), on)


def kept_levels(tiles: DataFrame, low: int, source: int) -> DataFrame:
    """What a rebuild of ``low`` up to ``source`` leaves as it is."""
    return tiles.where((F.col("z") >= source) | (F.col("z") < low))


def difference_report(full: DataFrame, other: DataFrame, on: list[str] = KEYS) -> DataFrame:
    """Per zoom how many tiles both have, ``other`` missed and ``other`` has in excess."""
    a, b = full.select(*on).distinct().withColumn("a", F.lit(True)), other.select(*on).distinct().withColumn("b", F.lit(True))
    both = a.join(b, on, "full_outer")
    n = lambda c: F.count_if(c).cast("long")
    return both.groupBy("z").agg(n(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"), n(F.col("b").isNull()).alias("missed"), n(F.col("a").isNull()).alias("extra"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in exactly one of two sets."""
    return a.subtract(b).unionByName(b.subtract(a))


def newest(files: DataFrame, key: str, order: str) -> DataFrame:
    """Per key the row with the largest ``order``."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return files.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def page(df: DataFrame, keys: list[str], after: list, size: int) -> DataFrame:
    """The next ``size`` rows in order of ``keys``; stable while other rows come and go."""
    if after:
        df = df.where(F.struct(*keys) > F.struct(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(keys, after)]))
    return df.orderBy(*keys).limit(size)


def hash_order(seed: str, *keys: str) -> Column:
    """A reproducible shuffle: MD5 of seed and keys."""
    return F.md5(F.concat_ws(",", F.lit(seed), *[F.col(k).cast("string") for k in keys]))


def sample(df: DataFrame, n: int, seed: str, *keys: str) -> DataFrame:
    """``n`` rows in shuffled order (a top-n, never a global sort)."""
    return df.orderBy(hash_order(seed, *keys), *keys).limit(n)


def picks(spark, n: int, seed: str, total: Column) -> DataFrame:
    """``n`` numbers below ``total``, with replacement: ``pick, at``."""
    draw = F.conv(F.substring(F.md5(F.concat_ws(",", F.lit(seed), F.col("id").cast("string"))), 1, 8), 16, 10).cast("long")
    return spark.range(n).select(F.col("id").alias("pick"), (draw % total).alias("at"))


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``at``, the place in order, without gathering all rows in one task.

    Rows are range-partitioned by the order; each partition's offset comes from
    the counts of those before it (one row per partition).
    """
    from .. import session

    ranged = session.settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(before), "_part").withColumn("at", (F.col("_before") + within - 1).cast("long")).drop("_part", "_before")


def disambiguated(df: DataFrame, key: str, position: str) -> DataFrame:
    """Repeated keys become ``key-2``, ``key-3`` in order of position (column ``name``)."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(position))
    return df.withColumn("name", F.when(n == 1, F.col(key)).otherwise(F.concat(F.col(key), F.lit("-"), n.cast("string"))))


def retired(present: DataFrame, plan: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """Files of a planned layer with an older edition (compared as text), less those to keep."""
    new = plan.select("layer", F.col("edition").alias("new_edition"))
    old = present.join(new, "layer").where(F.col("edition") < F.col("new_edition")).drop("new_edition").distinct()
    return old if keep is None else old.join(keep.select("filename"), "filename", "left_anti")
