"""What the physical plans must and must not hold."""

import contextlib
import io
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quadloom import queries as tile_queries
from quadloom.operators import grid, relations
from quadloom.plans import crawl


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


PLAIN = ["tile_address", "footprint_semi", "todo_tiles", "replace_tiles", "full_coverage_diff", "neighbour_counts", "dilated_footprint", "refresh_by_day", "retired_files", "edition_extent", "html_digests", "pixel_survey", "novelty_pairs", "box_class_report", "rebuild_reason"]


@pytest.mark.parametrize("name", PLAIN)
def test_no_nested_loops_and_no_row_python(name, spark):
    text = plan(tile_queries.queries()[name](spark, SMALL))
    assert not re.search("NestedLoop|Cartesian|BatchEvalPython|SinglePartition", text)


@pytest.mark.parametrize(("name", "columns"), [("refresh_by_day", "ts,event_type"), ("edition_extent", "ts,user_id,event_type"), ("footprint_semi", "o_orderkey,o_custkey"), ("byte_counts", "page_id,html")])
def test_only_needed_columns_are_read(name, columns, spark):
    text = plan(tile_queries.queries()[name](spark, SMALL))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert read and all({c.split(":")[0] for c in r.split(",")} <= set(columns.split(",")) for r in read)


def test_filters_reach_the_scan_and_blobs_stay(spark, tmp_path):
    rows = [(z, x, x, bytearray(b"blob")) for z in (3, 4) for x in range(4)]
    spark.createDataFrame(rows, "z int, x int, y int, tile_data binary").write.partitionBy("z").parquet(str(tmp_path / "t"))
    tiles = spark.read.parquet(str(tmp_path / "t"))
    text = plan(relations.todo(tiles.where("z = 4 AND x BETWEEN 1 AND 2").select("z", "x", "y"), tiles.where("z = 3").select("z", "x", "y")))
    assert "tile_data" not in text and re.search(r"PartitionFilters: \[[^\]]*z#\d+ = 4", text) and "GreaterThanOrEqual(x,1)" in text


def test_a_footprint_join_is_an_equi_join(spark):
    tiles = spark.range(100).select(F.lit(9).alias("z"), F.col("id").cast("int").alias("x"), F.col("id").cast("int").alias("y"))
    assert "NestedLoop" not in plan(grid.within_footprint(tiles, tiles.select("x", "y"), 7))
    limits = spark.createDataFrame([(10, 0, 50, 0, 50)], "z int, x0 int, x1 int, y0 int, y1 int")
    assert "NestedLoop" not in plan(crawl.candidates(tiles, limits, 10))
