"""Names, stamps, sizes and dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published name, the stages in their canonical order, size units, HTTP date layout.
PUBLISHED_NAME = r"\Afi-[a-z0-9]+-\d{4}-\d{2}-\d{2}\.mbtiles\z"
STAGES = ["black-tiles", "black-pixels", "white-tiles", "white-pixels"]
UNITS = ["B", "KiB", "MiB", "GiB"]
HTTP_DATE = "dd MMM yyyy HH:mm:ss"
ON_DEMAND_SECONDS = 60


def nonempty(c: Column) -> Column:
    """Null for the empty string, so that ``coalesce`` passes over both."""
    return F.nullif(c, F.lit(""))


def slug(layer: Column, drop: str = " public", cut: str = "erikois") -> Column:
    bare = F.replace(F.replace(F.lower(layer), F.lit(drop), F.lit("")), F.lit(" "), F.lit(""))
    return F.substring_index(bare, cut, 1)


def label(layer: Column, names: Column) -> Column:
    """A layer's name from a dictionary column (map), or the layer itself."""
    return F.coalesce(nonempty(F.try_element_at(names, layer)), layer)


def layer_prefix(*keys: Column) -> Column:
    """The first key that is neither null nor empty."""
    return F.coalesce(*[nonempty(k) for k in keys])


def published_name(layer: Column, edition: Column) -> Column:
    """Null where layer or edition is missing or the name would not be publishable."""
    name = F.concat(F.lit("fi-"), layer, F.lit("-"), nonempty(edition), F.lit(".mbtiles"))
    return F.when(F.rlike(name, F.lit(PUBLISHED_NAME)), name)


def stages_text(stages: Column) -> Column:
    return F.concat_ws("+", F.filter(F.array(*[F.lit(s) for s in STAGES]), lambda s: F.array_contains(stages, s)))


def processing_stamp(radius: Column, white: Column, limit: Column, stages: Column) -> Column:
    """``nodata-r<radius>-w<white>-n<limit>:<stages>``."""
    return F.concat(F.lit("nodata-r"), radius.cast("string"), F.lit("-w"), white.cast("string"), F.lit("-n"), limit.cast("string"), F.lit(":"), stages_text(stages))


def processing_text(stripped: Column, downscaled: Column) -> Column:
    """The steps that a file went through, or 'none'."""
    return F.coalesce(nonempty(F.concat_ws("; ", nonempty(stripped), nonempty(downscaled))), F.lit("none"))


def fingerprint(*parts: Column) -> Column:
    """Parts joined by ``|``; a missing one reads ``None``."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])


def human_size(n: Column) -> Column:
    """Bytes with one decimal (ties to even) in the largest unit that leaves at least 1; plain bytes below 1 KiB."""
    out = F.concat(n.cast("string"), F.lit(" B"))
    for i, unit in enumerate(UNITS[1:], 1):
        out = F.when(n >= 1024**i, F.concat(F.format_string("%.1f", F.bround(n / 1024**i, 1)), F.lit(f" {unit}"))).otherwise(out)
    return out


def duration(seconds: Column) -> Column:
    minutes = F.bround(seconds / 60).cast("long")
    h, m = F.floor(minutes / 60).cast("string"), (minutes % 60).cast("string")
    return F.when(minutes < 60, F.concat(m, F.lit(" min"))).otherwise(F.concat(h, F.lit(" h "), m, F.lit(" min")))


def http_timestamp(header: Column) -> Column:
    """``Tue, 02 Jun 2026 07:08:09 GMT``; the weekday is not read. Null if malformed."""
    return F.try_to_timestamp(F.substring(header, 6, 20), F.lit(HTTP_DATE))


def edition_day(last_modified: Column, served: Column) -> Column:
    """The edition's day, or null for a tile rendered on demand (served within a minute of its date)."""
    lm, at = http_timestamp(last_modified), http_timestamp(served)
    rendered = F.unix_timestamp(at) - F.unix_timestamp(lm) < ON_DEMAND_SECONDS
    return F.when(~F.coalesce(rendered, F.lit(False)), F.date_format(lm, "yyyy-MM-dd"))


def modified_since(day: Column) -> Column:
    """The header that asks for what changed after the whole day of a watermark."""
    return F.date_format(F.date_add(F.to_date(day), 1).cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def requested_count(summary: Column) -> Column:
    """The number after 'requested' in a run's summary; a summary without one fails the query."""
    found = F.regexp_extract(summary, r"requested ([\d,]+)", 1)
    return F.when(F.assert_true(found != "", F.lit("no request count in the summary")).isNull(), F.replace(found, F.lit(","), F.lit("")).cast("long"))


def revision(value: Column) -> Column:
    return F.coalesce(value.try_cast("int"), F.lit(0))


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def bounds_text(west: Column, south: Column, east: Column, north: Column) -> Column:
    return F.format_string("%.5f,%.5f,%.5f,%.5f", west, south, east, north)


def bounds_parts(bounds: Column) -> Column:
    return F.transform(F.split(bounds, ","), lambda x: x.cast("double"))


def is_counter(c: Column) -> Column:
    return F.rlike(c, F.lit(r"\A[0-9]+\z"))


def tile_url(base: str, layer: Column, z: Column, row: Column, col: Column, matrix: str) -> Column:
    """A WMTS GetTile address."""
    return F.concat(F.lit(f"{base}?service=WMTS&request=GetTile&version=1.0.0&style=default&format=image/png&tilematrixset={matrix}&layer="), F.url_encode(layer), F.format_string(f"&tilematrix={matrix}:%d&tilerow=%d&tilecol=%d", z, row, col))


def map_url(base: str, layers: Column, west: Column, south: Column, east: Column, north: Column, width: Column, height: Column, style: str = "") -> Column:
    """A WMS GetMap address in EPSG:3857 with errors as XML."""
    box = F.format_string("%.6f,%.6f,%.6f,%.6f", west, south, east, north)
    return F.concat(F.lit(f"{base}?service=WMS&request=GetMap&version=1.3.0&crs=EPSG:3857&format=image/png&transparent=true&exceptions=XML&styles={style}&layers="), F.url_encode(layers), F.lit("&bbox="), box, F.format_string("&width=%d&height=%d", width, height))
