"""What to rebuild and whether a build may be published: one rule query per layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import summary

REQUIRED = ["source_layer", "source_updated", "bounds", "minzoom", "maxzoom"]


def recipe(stages: Column, radius: Column, white: Column, limit: Column, deepest: Column) -> tuple[Column, Column]:
    """The stamp that a build would carry (null without stages) and its deepest zoom."""
    return F.when(F.size(stages) > 0, text.processing_stamp(radius, white, limit, stages)), deepest


def reason(forced: Column, published: Column, edition: tuple[Column, Column], stamp: tuple[Column, Column], zoom: tuple[Column, Column], revision: tuple[Column, Column]) -> Column:
    """Why a layer is built, the first that holds; null if nothing calls for it. Pairs are (wanted, published)."""
    differs = lambda p: ~p[0].eqNullSafe(p[1])
    return (
        F.when(forced, "forced")
        .when(published.isNull(), "nothing published")
        .when(differs(edition), F.concat_ws("", F.lit("edition "), F.coalesce(edition[1], F.lit("?")), F.lit(" -> "), F.coalesce(edition[0], F.lit("?"))))
        .when(differs(stamp), "other processing")
        .when(zoom[1].isNull(), "never downscaled")
        .when(differs(zoom), "other source zoom")
        .when(differs(revision), "archive changed")
    )


def findings(builds: DataFrame) -> DataFrame:
    """Per build what is wrong with it: ``layer, problems``.

    ``builds`` has ``layer, tiles, baseline, metadata`` (map), ``stamp, zoom``.
    """
    m = F.col("metadata")
    missing = F.filter(F.array(*[F.lit(k) for k in REQUIRED]), lambda k: text.nonempty(F.try_element_at(m, k)).isNull())
    checks = [
        F.when(summary.too_few(F.col("tiles"), F.col("baseline")), F.format_string("%d tiles of %d before", "tiles", "baseline")),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))),
        F.when(~F.try_element_at(m, F.lit("nodata_stripped")).eqNullSafe(F.col("stamp")), F.lit("other processing than asked for")),
        F.when(~F.try_element_at(m, F.lit("downscale_source_zoom")).try_cast("int").eqNullSafe(F.col("zoom")), F.lit("other source zoom than asked for")),
    ]
    return builds.select("layer", F.filter(F.array(*checks), lambda c: c.isNotNull()).alias("problems"))
