"""Text rules and shared-folder tables that the operators of this subpackage use.

Text contracts everywhere below: a null text counts as empty, ``\\n`` alone
separates lines, the white space is ``[\\x20\\x09-\\x0D]`` and only A-Z have a
lower case (other letters stay as they are).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; ``lower`` has a fast path for pure ASCII, ``translate`` serves the rest."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def lines_of(c: Column) -> Column:
    return F.split(c, "\n", -1)


def words_of(c: Column) -> Column:
    """The words of a text; an empty array where it has none."""
    bare = strip(c)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+", -1))


def count_words(c: Column) -> Column:
    return F.size(words_of(c)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: lambda variables are never inlined."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Only the given columns, so that a caller's extra columns can't clash with an operator's own."""
    return df.select(*[c.alias(name) for name, c in columns.items()])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; set here only where a session (a test) has none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        kept = spark.sparkContext.getCheckpointDir()
        if kept is None:
            import tempfile

            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            kept = "file://" + tempfile.mkdtemp(prefix="quadloom-")
            spark.sparkContext.setCheckpointDir(kept)
        folder = kept
    return folder.rstrip("/")


_TABLES: list[str] = []


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    The lineage ends there, the statistics are those of the files, and a lost
    executor costs a read, not the stages before it. The table goes with the
    driver's JVM at the latest, or with ``drop_tables``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quadloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _TABLES.append(path)
    _filesystem(spark, path).deleteOnExit(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))
    # What the write shuffled is not needed again; Spark deletes shuffle files only after a collection.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def kept_tables() -> int:
    """How many tables ``cut`` has written in this process and not deleted."""
    return len(_TABLES)


def drop_tables(spark: SparkSession, first: int = 0, but: DataFrame | None = None) -> None:
    """Deletes the tables that ``cut`` wrote in this process from number ``first`` on, but for the one behind ``but``.

    Nothing may read them afterwards.
    """
    keep = {f.rsplit("/", 2)[1] for f in but.inputFiles()} if but is not None else set()
    for path in _TABLES[first:]:
        if path.rsplit("/", 1)[1] not in keep:
            remove(spark, path)
            _TABLES.remove(path)


def _filesystem(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    _filesystem(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)
