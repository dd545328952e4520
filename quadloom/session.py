"""Session settings that the engine's plans expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Decoded tiles are a quarter of a megabyte: few rows to an Arrow batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}


def build(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("quadloom").config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share (``spark.checkpoint.dir``); a temporary one in local tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if folder is None:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quadloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Rounds of an iteration start from files: lineage and size estimates don't
    pile up, and a lost executor costs one read. The table goes with the
    driver's JVM.
    """
    import uuid

    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quadloom/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
