"""Grids of cells: neighbours, floods and peels.

Neighbour joins are equi joins on exploded offsets, never conditions on
differences. The two iterative operators work in blocks of ``side`` cells: each
block is solved whole in one task of bounded size, and only block borders are
exchanged between rounds, so the rounds follow the number of blocks across and
not of cells.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import AROUND, SIDES, x_to_lon, y_to_lat
from ..session import settled

BLOCK = 512


def neighbours(cells: DataFrame, offsets=SIDES) -> DataFrame:
    """Each cell once per offset: ``nx, ny`` the neighbour's place and ``side``; other columns stay."""
    around = F.array(*[F.struct((F.col("x") + dx).alias("nx"), (F.col("y") + dy).alias("ny"), F.lit(s).alias("side")) for dx, dy, s in offsets])
    return cells.withColumn("_n", F.explode(around)).select(*cells.columns, "_n.*")


def _joined(cells: DataFrame, others: DataFrame, by: list[str], offsets, how: str) -> DataFrame:
    o = others.select(*[F.col(c).alias(f"o_{c}") for c in others.columns])
    n = neighbours(cells, offsets)
    same = (F.col("nx") == F.col("o_x")) & (F.col("ny") == F.col("o_y"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    return n.join(o, same, how)


def neighbour_counts(cells: DataFrame, others: DataFrame, by: list[str] = (), offsets=SIDES) -> DataFrame:
    """How many of a cell's neighbours are in ``others``."""
    by = list(by)
    hit = _joined(cells.select(*by, "x", "y").distinct(), others.select(*by, "x", "y").distinct(), by, offsets, "left")
    return hit.groupBy(*by, "x", "y").agg(F.count("o_x").alias("n"))


def facing(cells: DataFrame, reached: DataFrame, by: list[str] = (), offsets=AROUND) -> DataFrame:
    """Cells with a reached neighbour, and on which ``sides`` (sorted)."""
    by = list(by)
    hit = _joined(cells.select(*by, "x", "y").distinct(), reached.select(*by, "x", "y").distinct(), by, offsets, "inner")
    return hit.groupBy(*by, "x", "y").agg(F.array_sort(F.collect_set("side")).alias("sides"))


def around_payload(cells: DataFrame, tiles: DataFrame, payload: str, by: list[str] = ()) -> DataFrame:
    """Per cell a map from side to its neighbour's payload, sides in ``outward`` and absent neighbours left out."""
    by = list(by)
    wanted = _joined(cells.select(*by, "x", "y", "outward"), tiles.select(*by, "x", "y", payload), by, AROUND, "left")
    entry = F.when(F.col(f"o_{payload}").isNotNull() & ~F.array_contains("outward", F.col("side")), F.struct("side", F.col(f"o_{payload}")))
    return wanted.groupBy(*by, "x", "y").agg(F.map_from_entries(F.collect_list(entry)).alias("around"), F.first("outward").alias("outward"))


def dilated(cells: DataFrame, by: list[str] = (), width: int | None = None, height: int | None = None) -> DataFrame:
    """The cells and all eight neighbours of each; clipped to a grid if one is given."""
    nine = [(dx, dy, "") for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    out = neighbours(cells.select(*by, "x", "y"), nine).select(*by, F.col("nx").alias("x"), F.col("ny").alias("y"))
    if width is not None:
        out = out.where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1))
    return out.distinct()


def footprint_levels(cells: DataFrame, z: int, low: int = 0) -> DataFrame:
    """The footprint at every zoom from ``low`` to its own, each level dilated by a cell; ``z, x, y``."""
    up = cells.select("x", "y").withColumn("up", F.explode(F.sequence(F.lit(0), F.lit(z - low))))
    at = up.select((F.lit(z) - F.col("up")).alias("z"), F.call_function("shiftright", "x", "up").alias("x"), F.call_function("shiftright", "y", "up").alias("y")).distinct()
    return dilated(at, ["z"])


def within_footprint(tiles: DataFrame, footprint: DataFrame, footprint_z: int) -> DataFrame:
    """Tiles at or below the footprint's zoom whose ancestor there is in it."""
    up = F.col("z") - footprint_z
    keyed = tiles.withColumns({"_ax": F.call_function("shiftright", "x", up), "_ay": F.call_function("shiftright", "y", up)})
    f = footprint.select(F.col("x").alias("_ax"), F.col("y").alias("_ay")).distinct()
    return keyed.join(f, ["_ax", "_ay"], "left_semi").drop("_ax", "_ay")


def leaf_bounds(tiles: DataFrame) -> DataFrame:
    """West, south, east, north over the tiles that nothing one zoom deeper refines."""
    refined = tiles.select((F.col("z") - 1).alias("z"), F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y")).distinct()
    leaf = tiles.select("z", "x", "y").join(refined, ["z", "x", "y"], "left_anti")
    z = F.col("z")
    return leaf.agg(F.min(x_to_lon(F.col("x"), z)).alias("west"), F.min(y_to_lat(F.col("y") + 1, z)).alias("south"), F.max(x_to_lon(F.col("x") + 1, z)).alias("east"), F.max(y_to_lat(F.col("y"), z)).alias("north"))


# --- flood from outside ---------------------------------------------------------------


def open_labels(walls: np.ndarray) -> np.ndarray:
    """Numbers of the 4-connected regions of False; -1 on walls."""
    h, w = walls.shape
    label = np.full((h, w), -1, dtype=np.int64)
    parent: list[int] = []

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for y in range(h):
        edge = np.flatnonzero(np.diff(np.concatenate([[True], walls[y], [True]]).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):  # a run of open cells
            own = len(parent)
            parent.append(own)
            if y:
                for up in set(label[y - 1, a:b].tolist()) - {-1}:
                    parent[root(up)] = root(own)
                    own = root(own)
            label[y, a:b] = own
    if parent:
        roots = np.array([root(i) for i in range(len(parent))])
        label = np.where(label >= 0, roots[label], -1)
    return label


def _block_walls(rows: pd.DataFrame, side: int) -> tuple[np.ndarray, int, int]:
    r = rows.iloc[0][["bx", "by", "x0", "x1", "y0", "y1"]].astype(int)  # floats where a block has no walls
    x0, y0 = r["bx"] * side, r["by"] * side
    walls = np.ones((side, side), dtype=bool)
    walls[max(r["y0"] - y0, 0) : max(r["y1"] - y0 + 1, 0), max(r["x0"] - x0, 0) : max(r["x1"] - x0 + 1, 0)] = False
    at = rows[rows["x"].notna()]
    walls[at["y"].to_numpy(dtype=int) - y0, at["x"].to_numpy(dtype=int) - x0] = True
    return walls, x0, y0


def _ring(label: np.ndarray, x0: int, y0: int, r: pd.Series) -> set[int]:
    """Regions that hold a cell of the rectangle's border."""
    out: set[int] = set()
    h, w = label.shape
    for x in (int(r["x0"]) - x0, int(r["x1"]) - x0):
        if 0 <= x < w:
            out |= set(label[:, x].tolist())
    for y in (int(r["y0"]) - y0, int(r["y1"]) - y0):
        if 0 <= y < h:
            out |= set(label[y].tolist())
    return out - {-1}


def outside(cells: DataFrame, by: list[str] = (), side: int = BLOCK) -> DataFrame:
    """Every cell that a 4-connected walk from one cell beyond the data reaches.

    ``cells`` has ``x, y, marked``; marked cells are walls, other cells and
    empty places are open, and empty places that are reached are returned too.
    """
    by = list(by)
    box = cells.groupBy(*by).agg((F.min("x") - 1).alias("x0"), (F.max("x") + 1).alias("x1"), (F.min("y") - 1).alias("y0"), (F.max("y") + 1).alias("y1"))
    block = lambda c: F.floor(F.col(c) / side).cast("int")
    blocks = box.withColumn("bx", F.explode(F.sequence(block("x0"), block("x1")))).withColumn("by", F.explode(F.sequence(block("y0"), block("y1"))))
    walls = cells.where("marked").select(*[F.col(c).alias(f"w_{c}") for c in by], "x", "y", block("x").alias("w_bx"), block("y").alias("w_by"))
    same = (F.col("bx") == F.col("w_bx")) & (F.col("by") == F.col("w_by"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"w_{c}"))
    rows = settled(blocks.join(walls, same, "left").select(*by, "bx", "by", "x0", "x1", "y0", "y1", "x", "y"))
    keys = [*by, "bx", "by"]
    key_types = ", ".join(f"{c} {cells.schema[c].dataType.simpleString()}" for c in by)
    key_types = f"{key_types}, " if key_types else ""

    def borders(p: pd.DataFrame) -> pd.DataFrame:
        """The regions on a block's border cells; ``edge`` is the border's place, shared with the block beyond."""
        w, x0, y0 = _block_walls(p, side)
        label = open_labels(w)
        out, free = [], _ring(label, x0, y0, p.iloc[0])
        for k in range(side):
            for n, (lx, ly, ex, ey) in enumerate(((0, k, x0, y0 + k), (side - 1, k, x0 + side, y0 + k), (k, 0, x0 + k, y0), (k, side - 1, x0 + k, y0 + side))):
                if label[ly, lx] >= 0:
                    out.append((n // 2, ex, ey, int(label[ly, lx]), int(label[ly, lx]) in free))
        out += [(-1, 0, 0, g, True) for g in free]
        f = pd.DataFrame(out, columns=["axis", "ex", "ey", "region", "free"])
        for c in keys:
            f[c] = p[c].iloc[0]
        return f[[*keys, "axis", "ex", "ey", "region", "free"]]

    seen = settled(rows.groupBy(*keys).applyInPandas(borders, f"{key_types}bx int, by int, axis int, ex int, ey int, region long, free boolean"))
    free = settled(seen.where("free").select(*keys, "region").distinct())
    links = seen.where("axis >= 0").select(*by, "axis", "ex", "ey", "bx", "by", "region")
    o = links.select(*[F.col(c).alias(f"o_{c}") for c in links.columns])
    meet = (F.col("axis") == F.col("o_axis")) & (F.col("ex") == F.col("o_ex")) & (F.col("ey") == F.col("o_ey")) & ((F.col("bx") != F.col("o_bx")) | (F.col("by") != F.col("o_by")))
    for c in by:
        meet = meet & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    pairs = settled(links.join(o, meet).select(*keys, "region", F.col("o_bx"), F.col("o_by"), F.col("o_region")).distinct())
    count = -1
    while (now := free.count()) != count and not pairs.isEmpty():  # regions across borders, a block a round
        count = now
        on = pairs.join(free, [*keys, "region"], "left_semi").select(*by, F.col("o_bx").alias("bx"), F.col("o_by").alias("by"), F.col("o_region").alias("region"))
        free = settled(free.unionByName(on).distinct())

    def reached(p: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if p.empty:
            return pd.DataFrame(columns=[*by, "x", "y"])
        w, x0, y0 = _block_walls(p, side)
        y, x = np.nonzero(np.isin(open_labels(w), r["region"].to_numpy()))
        f = pd.DataFrame({"x": x + x0, "y": y + y0})
        for c in by:
            f[c] = p[c].iloc[0]
        return f[[*by, "x", "y"]]

    return rows.groupBy(*keys).cogroup(free.groupBy(*keys)).applyInPandas(reached, f"{key_types}x int, y int")


# --- peel -----------------------------------------------------------------------------


def peeled_block(marked: np.ndarray, blank: np.ndarray, own: np.ndarray, limit: int) -> np.ndarray:
    """Which blank cells of ``own`` are left when those with at most ``limit`` standing neighbours go, again and again."""
    standing = marked | blank
    while True:
        n = np.zeros(standing.shape, dtype=np.int8)
        n[1:] += standing[:-1]
        n[:-1] += standing[1:]
        n[:, 1:] += standing[:, :-1]
        n[:, :-1] += standing[:, 1:]
        go = blank & own & (n <= limit)
        if not go.any():
            return blank & own
        blank = blank & ~go
        standing = marked | blank


def held(cells: DataFrame, by: list[str] = (), limit: int = 2, side: int = BLOCK) -> DataFrame:
    """The blank cells of ``cells`` (``x, y, marked``) that a peel leaves standing.

    A blank cell goes when at most ``limit`` of its four neighbours stand. What
    goes never comes back, so blocks may peel in any order; each round a block
    goes as far as it can with the border its neighbours had before.
    """
    by = list(by)
    key_types = ", ".join(f"{c} {cells.schema[c].dataType.simpleString()}" for c in by)
    key_types = f"{key_types}, " if key_types else ""
    now = settled(cells.select(*by, "x", "y", "marked").distinct())
    marked = now.where("marked")
    count = now.where("NOT marked").count()
    halo = [(0, 0, ""), *SIDES]

    def peel(p: pd.DataFrame) -> pd.DataFrame:
        x0, y0 = int(p["bx"].iloc[0]) * side - 1, int(p["by"].iloc[0]) * side - 1
        shape = (side + 2, side + 2)
        m, b, own = np.zeros(shape, bool), np.zeros(shape, bool), np.zeros(shape, bool)
        own[1:-1, 1:-1] = True
        y, x, is_marked = p["y"].to_numpy() - y0, p["x"].to_numpy() - x0, p["marked"].to_numpy()
        m[y[is_marked], x[is_marked]] = True
        b[y[~is_marked], x[~is_marked]] = True
        y, x = np.nonzero(peeled_block(m, b, own, limit))
        f = pd.DataFrame({"x": x + x0, "y": y + y0})
        for c in by:
            f[c] = p[c].iloc[0]
        return f[[*by, "x", "y"]]

    while True:
        spread = neighbours(now, halo)
        spread = spread.select(*by, "x", "y", "marked", F.floor(F.col("nx") / side).cast("int").alias("bx"), F.floor(F.col("ny") / side).cast("int").alias("by")).distinct()
        left = settled(spread.groupBy(*by, "bx", "by").applyInPandas(peel, f"{key_types}x int, y int").distinct())
        n = left.count()
        if n == count:
            return left
        count = n
        now = marked.unionByName(left.withColumn("marked", F.lit(False)))


class Leaked(RuntimeError):
    """Solid no-data that the walk did not reach."""


def unreached(solid: DataFrame, candidates: DataFrame, by: list[str] = ()) -> DataFrame:
    return solid.join(candidates, [*by, "x", "y"], "left_anti").select(*by, "x", "y")


def refuse_leaks(solid: DataFrame, candidates: DataFrame, by: list[str] = ()) -> None:
    missed = unreached(solid, candidates, by)
    first = missed.orderBy(*by, "x", "y").limit(5).collect()
    if first:
        raise Leaked(f"{missed.count()} tiles are solid fill but out of the walk's reach: {[tuple(r) for r in first]}")


def edge_tiles(tiles: DataFrame, by: list[str] = (), side: int = BLOCK) -> DataFrame:
    """Tiles with fill that the outside touches, and from which ``sides``; ``tiles`` has ``x, y, chart, fill``."""
    reached = outside(tiles.withColumn("marked", F.col("chart")), by, side)
    return facing(tiles.where("fill > 0"), reached, by)
