"""Mixing sources to target weights by entropy balancing.

Among all document rates with the wanted words per source, the ones closest to
a common base rate (in relative entropy, each rate at most ``cap``) are
``min(cap, base * exp(lambda_s * size / mean_s))``: one dual variable a source.
The convex dual is solved by safeguarded Newton steps; each step sums value and
slope over all documents (as a histogram of sizes, so a source with a third of
all documents is as many rows as it has different sizes). Sources, their targets
and their dual variables are tables, however many there are; a step that doesn't
converge raises an error. Sums are decimals and the rounding works on integers,
so reruns agree whatever the task order.

Rates become whole copies: a document's rate is rounded down, or up if a hash
of its id falls below its fraction plus a shift. Per source, size classes are
served from large to small; each class picks the shift that meets its words and
hands what is missing to the next, so the error shrinks to that of the smallest
class.

Defined cases: null text has size 0; null source is a source of its own, last
in order; documents of size 0 get no copies; sources or tables without words
get target 0; repeated rows are mixed each; an empty table gives an empty
result; extra columns are ignored by ``mix`` and kept by ``apply_mix``. The
driver gets a few sums a step, never sources or documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import count_words, cut, prefixed, read, text_of

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
UNIT = 1 << 20  # rates are counted in these parts
BINS = 256


def source_key(c: Column) -> Column:
    """A name for each source, the null one included."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit("null"))


def sources(hist: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``key, source, have, n, weight``: a row per source; weights repeat in the order of sources, null last."""
    order = F.col("source").asc_nulls_last()
    total = hist.groupBy("key", "source").agg(F.sum(F.col("n") * F.col("size")).alias("have"), F.coalesce(F.sum(F.when(F.col("size") > 0, F.col("n"))), F.lit(0)).alias("n"))
    # Ids rise with the sorted ranges: above 2^33 the range, below it the place in it.
    placed = cut(total.repartitionByRange(order).sortWithinPartitions(order).withColumn("id", F.monotonically_increasing_id()), "sources")
    ranges = placed.groupBy(F.shiftright("id", 33).alias("range")).count().orderBy("range").collect()  # a row per range
    before, starts = 0, []
    for r in ranges:
        starts += [F.lit(r["range"]), F.lit(before)]
        before += r["count"]
    start = F.element_at(F.create_map(*starts), F.shiftright("id", 33)) if starts else F.lit(0)
    place = F.pmod(start + F.col("id").bitwiseAND((1 << 33) - 1), F.lit(len(weights))).cast("int")
    return placed.select("key", "source", "have", "n", F.get(F.array(*[F.lit(float(w)) for w in weights]), place).alias("weight"))


def targets(table: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds ``target``, the words wanted of each source: shares by weight, what exceeds ``cap`` times a source goes to the others."""
    table = cut(table, "weights")
    level, capped = None, -1
    while True:
        # A source over its cap stays there: what it gives up only raises the level of the others.
        over = F.lit(False) if level is None else F.lit(level) * F.col("weight") > F.lit(cap) * F.col("have")
        r = table.agg(F.sum("have").alias("all"), F.sum(F.when(over, F.col("have"))).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("weight"), F.count_if(over).alias("n")).first()
        if r["n"] == capped or not r["weight"]:
            break
        capped, level = r["n"], (share * r["all"] - cap * (r["full"] or 0)) / r["weight"]
    most = F.lit(cap) * F.col("have")
    return table.withColumn("target", F.least(most, F.lit(level) * F.col("weight")) if level is not None else most)


def _rate(base: Column, dual: Column, mean: Column, cap: Column, size: Column) -> Column:
    return F.least(cap, base * F.exp(F.least(F.lit(700.0), dual * size / mean)))


def solve_dual(hist: DataFrame, table: DataFrame, base: float, cap: float, tolerance: float = 1e-7, most: int = 100) -> DataFrame:
    """Adds ``mean`` and ``dual`` to a table of ``key, have, n, target``; a distributed sum over all documents for each Newton step."""
    free = (F.col("target") > 0) & (F.col("target") < F.lit(cap * (1 - 1e-9)) * F.col("have"))
    bound = F.when(F.col("target") > 0, 1e6).otherwise(-1e6)
    state = table.withColumns({"mean": F.when(F.col("have") > 0, F.col("have") / F.greatest("n", F.lit(1))).otherwise(1.0), "dual": F.when(free, 0.0).otherwise(bound), "low": F.lit(-1e3), "high": F.lit(1e3), "open": free})
    for _ in range(most):
        state = cut(state, "dual")
        if state.where("open").isEmpty():
            return state.drop("low", "high", "open")
        now = state.where("open").select("key", "dual", "mean")
        rate = _rate(F.lit(base), F.col("dual"), F.col("mean"), F.lit(cap), F.col("size"))
        words = F.col("h.n") * F.col("size") * F.round(rate * UNIT)
        slope = F.when(rate < cap, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = hist.alias("h").join(now, "key").groupBy("key").agg((F.sum(words.cast("decimal(38,0)")).cast("double") / UNIT).alias("f"), (F.sum(slope.cast("decimal(38,0)")).cast("double") / UNIT).alias("g"))
        short = F.col("f") < F.col("target")
        state = state.join(sums, "key", "left").withColumn("met", ~F.col("open") | (F.abs(F.col("f") - F.col("target")) <= tolerance * F.col("target")) | (F.col("high") - F.col("low") < 1e-12))
        state = state.withColumns({"low": F.when(~F.col("met") & short, F.col("dual")).otherwise(F.col("low")), "high": F.when(~F.col("met") & ~short, F.col("dual")).otherwise(F.col("high"))})
        state = state.withColumn("step", F.when(F.col("g") > 0, F.col("dual") + (F.col("target") - F.col("f")) / F.col("g")))
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        dual = F.when(F.col("met"), F.col("dual")).when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        state = state.withColumns({"dual": dual, "open": ~F.col("met")}).drop("f", "g", "met", "step")
    raise RuntimeError(f"the dual did not converge in {most} steps")


def _edges(rows: pd.DataFrame) -> pd.DataFrame:
    """For one source: per size class, how many bins of documents are rounded up."""
    out, owed = [], 0
    for c, part in sorted(rows.groupby("class"), key=lambda x: -x[0]):
        part = part.sort_values("bin")
        owed += int(part["want"].sum()) - int(part["down"].sum()) * UNIT
        gains = np.concatenate([[0], np.cumsum(part["up"].to_numpy(dtype="int64"))])
        k = int(np.argmin(np.abs(gains * UNIT - owed)))
        owed -= int(gains[k]) * UNIT
        out.append((rows["key"].iloc[0], int(c), int(part["bin"].iloc[k]) if k < len(part) else 2 * BINS))
    return pd.DataFrame(out, columns=["key", "class", "edge"])


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 4, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: Column | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, rate, copies`` and, if given, ``carry``; a row per input row."""
    extra = {"carry": carry} if carry is not None else {}
    rows = prefixed(docs, doc_id=F.col(id_col), source=F.col(source_col).cast("string"), size=count_words(text_of(text_col)), **extra)
    rows = rows.withColumn("key", source_key(F.col("source")))
    if carry is None:  # what is carried along may be long: then sizes are counted twice instead
        rows = cut(rows, "sizes")
    hist = cut(rows.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    base = share
    table = solve_dual(hist, targets(sources(hist, weights), share, cap), base, cap)
    table = table.select("key", "dual", "mean", F.col("have").cast("long").alias("source_size"), "target")
    rated = rows.join(table, "key", "left").withColumn("parts", F.round(_rate(F.lit(base), F.col("dual"), F.col("mean"), F.lit(cap), F.col("size")) * UNIT).cast("long"))
    down = F.col("parts") - F.pmod("parts", F.lit(UNIT))
    rated = rated.withColumns({"down": F.expr(f"parts div {UNIT}"), "frac": F.col("parts") - down, "class": F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int")})
    # Documents in the order in which they are rounded up: a uniform draw less the fraction.
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(UNIT))
    place = F.floor(F.lit(BINS) * (F.lit(UNIT) + draw - F.col("frac")) / F.lit(UNIT))
    rated = rated.withColumn("bin", F.when(F.col("frac") > 0, place).otherwise(2 * BINS).cast("int"))
    count = rated.where("size > 0").groupBy("key", "class", "bin").agg(F.sum(F.col("parts") * F.col("size")).cast("decimal(38,0)").alias("want"), F.sum(F.col("down") * F.col("size")).alias("down"), F.sum(F.when(F.col("frac") > 0, F.col("size")).otherwise(0)).alias("up"))
    # The counts settle first: what meets per source then is at most classes times bins rows, not what each task had of it.
    edges = cut(count, "counts").groupBy("key").applyInPandas(_edges, "key string, class int, edge int")
    out = rated.join(cut(edges, "edges"), ["key", "class"], "left")
    copies = F.when(F.col("size") > 0, F.col("down") + ((F.col("frac") > 0) & (F.col("bin") < F.col("edge"))).cast("long")).otherwise(0).cast("long")
    return out.select("doc_id", F.col("size").cast("long").alias("size"), F.col("source_size"), F.col("target"), (F.col("parts") / UNIT).alias("rate"), copies.alias("copies"), *extra)


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns as they were, as often as the mix takes them."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    mixed = mix(docs, carry=whole, **options)
    return mixed.select("carry", F.explode(F.expr("array_repeat(true, cast(copies as int))")).alias("one")).select("carry.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
