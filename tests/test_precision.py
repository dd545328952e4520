"""Vectors whose pixels lie next to a whole number: what is single precision in SQL is single precision in Spark."""

from __future__ import annotations

import random

import numpy as np
import pytest

from quadloom import queries as tile_queries

SHOWN = ["kernel_novelty", "kernel_survey", "pixel_classes", "pixel_survey", "halved_pixels", "kernel_masks", "kernel_parents", "kernel_stripped", "nearest_share"]


def edges() -> list[float]:
    """Single-precision values whose byte, ``floor((e + 1) * 127)``, is another one in double precision."""
    near = np.concatenate([np.float32(k / 127 - 1) + np.arange(-40, 41, dtype=np.float32) * np.float32(2**-26) for k in range(1, 254)])
    single = np.floor((near + np.float32(1)) * np.float32(127))
    double = np.floor((near.astype(np.float64) + 1) * 127)
    return sorted(set(near[single != double].tolist()))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pick, values = random.Random(5), edges()
    rows = [(n, [pick.choice(values) for _ in range(64)], n % 10) for n in range(40)]
    path = tmp_path_factory.mktemp("edges")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.mark.parametrize("name", SHOWN)
def test_pixels_next_to_a_whole_number(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    want = db.sql(tile_queries.oracle_sql()[name])
    got = tile_queries.queries()[name](spark, str(folder)).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
