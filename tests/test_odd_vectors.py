"""Vectors that are null, empty, too short or too long, or hold a null or more than a byte can: the same rows as in SQL."""

from __future__ import annotations

import random

import pytest

from quadloom import queries as tile_queries

LENGTHS = {"null vector": None, "empty": 0, "short": 50, "long": 70, "null element": 64}
SHOWN = [("kernel_survey", [*LENGTHS, "beyond a byte"]), ("pixel_classes", [*LENGTHS, "beyond a byte"]), ("pixel_survey", [*LENGTHS, "beyond a byte"]), ("halved_pixels", [*LENGTHS, "beyond a byte"]), ("kernel_masks", [*LENGTHS, "beyond a byte"]), ("kernel_parents", [*LENGTHS]), ("kernel_stripped", ["null vector", "empty", "long"]), ("nearest_share", [*LENGTHS, "beyond a byte"])]


def vectors(kind: str) -> list:
    pick = random.Random(5)
    rows = [[pick.uniform(-0.5, 0.5) for _ in range(64 if n % 3 else LENGTHS.get(kind, 64) or 0)] for n in range(40)]
    for n in range(0, 40, 3):
        if kind == "null vector":
            rows[n] = None
        elif kind == "null element":
            rows[n][5:7] = [None, None]
        elif kind == "beyond a byte":
            rows[n][:4] = [1.2, 1.5, -1.2, -1.5]
    return [(n, v, n % 10) for n, v in enumerate(rows)]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for kind in [*LENGTHS, "beyond a byte"]:
        out[kind] = tmp_path_factory.mktemp("odd")
        spark.createDataFrame(vectors(kind), "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{out[kind]}/embeddings.parquet")
    return out


@pytest.mark.parametrize("name, kind", [(name, kind) for name, kinds in SHOWN for kind in kinds])
def test_odd_vectors(spark, folders, name, kind):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folders[kind]}/embeddings.parquet/*.parquet'")
    want = db.sql(tile_queries.oracle_sql()[name])
    got = tile_queries.queries()[name](spark, str(folders[kind])).select(*want.columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


@pytest.mark.parametrize("kind", ["short", "null element", "beyond a byte"])
def test_what_is_left_of_odd_vectors(spark, folders, kind):
    test_odd_vectors(spark, folders, "kernel_stripped", kind)


def test_clear_white_is_not_taken_for_erased(spark, tmp_path):
    """A pixel of 294 is clear, and white where colours end at a byte; the black above it is erased, the pixel stays."""
    dark, light, clear = ((v + 0.5) / 127 - 1 for v in (10, 139, 294))
    image = [dark] * 32 + [light] * 18 + [clear] + [light] * 13
    spark.createDataFrame([(0, image, 0)], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    test_odd_vectors(spark, {"white": tmp_path}, "kernel_stripped", "white")
    assert "294,255,274,0" in tile_queries.queries()["kernel_stripped"](spark, str(tmp_path)).first()["pixels"]
