from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split():
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return db


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="session")
def agrees(spark, duck):
    def check(run, sql: str) -> None:
        df = run(spark, SMALL)
        want = duck.sql(sql)
        names = sorted(want.columns)
        assert sorted(df.columns) == names
        types = dict(zip(want.columns, map(str, want.types)))
        assert {c: KINDS[k] for c, k in df.dtypes} == types
        got = sorted(repr([r[c] for c in names]) for r in df.collect())
        at = [want.columns.index(c) for c in names]
        assert got == sorted(repr([r[i] for i in at]) for r in want.fetchall())

    return check
