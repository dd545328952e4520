"""SimHash near-dedup by anchor-point covering.

A text's fingerprint takes each bit from the majority of its word shingles'
XXH64 values. Fingerprints at ``THRESHOLD`` or fewer differing bits link.

The anchors are products of binary Golay codes (length 23, covering radius 3,
perfect): two blocks, 46 of the 64 bits, give 2^24 anchors, all three up to 2^36. A
fingerprint goes to every anchor within covering radius plus threshold, counted
over the blocks together (about 61 anchors for two blocks). Of two linked
fingerprints one has its nearest anchor within the radius, and the other is
then within radius plus threshold of it, so they meet: the search is exact.
Fingerprints are compared per anchor: pair by pair in small groups, and in
large ones through the points one bit away, which any two fingerprints two bits
apart share, so a group of any size costs n log n and gives at most n - 1 links.

Equal texts and fingerprints combine before anything else. Components come from
alternating star steps on tables in the shared folder; neither links nor
fingerprints reach the driver.

Defined cases: null or empty text has fingerprint zero and links like any
other; fewer words than a shingle: the whole sequence is one; rows that repeat
an id are returned each; ids of any integer type, null last among a component's
candidates; an empty table gives an empty result; extra columns are ignored (and
kept by ``near_dedup``, which goes by id and text: rows with one id and texts of
different groups are kept in each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, prefixed, read, text_of

SHINGLE, SEED, THRESHOLD = 3, 42, 2
# Fixed value: the Golay code's generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR, CODE_BITS, CHECK_BITS, RADIUS = 0b110001110101, 23, 11, 3
BLOCK_BITS = [23, 23, 18]
SMALL_GROUP, CHUNK_ROWS = 48, 1 << 19


def shingle_hashes(text: bytes, size: int = SHINGLE, seed: int = SEED) -> list[int]:
    import xxhash

    words = text.lower().split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), seed)]
    joined = b" ".join(words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    starts.append(at)
    return [digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[size:])]


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    counts = np.zeros(64, dtype="int64")
    for i in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype="int64")
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_rows(size: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, dtype="<u8")
            for i, text in enumerate(batch.column(2).to_pylist()):
                hashes = shingle_hashes(text, size, seed)
                if hashes:
                    out[i] = majority(np.array(hashes, dtype="<u8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out.view("<i8"))], names=["doc_id", "text_h", "fp"])

    return rows


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_h, fp``: a signed 64-bit fingerprint per row, and the text's hash."""
    rows = prefixed(docs, doc_id=F.col(id_col), text_h=F.xxhash64(text_of(text_col)), text=text_of(text_col).cast("binary"))
    return rows.mapInArrow(_fingerprint_rows(size, seed), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_h long, fp long")


def golay_cosets() -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Syndrome tables of the three bytes of a block, and per excess weight (0, 1, 2 beyond the radius) the error patterns of each syndrome, padded with -1."""
    bit = np.zeros(CODE_BITS, dtype="int64")
    for i in range(CODE_BITS):
        x = 1 << i
        for k in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
            if x >> k & 1:
                x ^= GENERATOR << (k - CHECK_BITS)
        bit[i] = x
    byte = []
    for b in range(3):
        t = np.zeros(256, dtype="int64")
        for i in range(8):
            if 8 * b + i < CODE_BITS:
                t ^= np.where(np.arange(256) >> i & 1, bit[8 * b + i], 0)
        byte.append(t)
    level = {0: np.array([0])}
    for w in range(1, RADIUS + 3):
        grown = (level[w - 1][:, None] | (1 << np.arange(CODE_BITS))[None, :]).ravel()
        level[w] = np.unique(grown[np.bitwise_count(grown) == w])
    tables = []
    for weights in ([0, 1, 2, 3], [4], [5]):
        e = np.concatenate([level[w] for w in weights])
        s = byte[0][e & 255] ^ byte[1][e >> 8 & 255] ^ byte[2][e >> 16]
        e, s = e[np.argsort(s, kind="stable")], np.sort(s)
        count = np.bincount(s, minlength=1 << CHECK_BITS)
        table = np.full((1 << CHECK_BITS, count.max()), -1, dtype="int64")
        table[s, np.arange(len(s)) - np.repeat(np.cumsum(count) - count, count)] = e
        tables.append(table)
    return byte, tables


def anchors(fp: np.ndarray, blocks: int = 2, threshold: int = THRESHOLD, cosets=None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of ``fp`` and their anchors: all within covering radius plus threshold."""
    byte, tables = cosets or golay_cosets()
    row, anchor, excess = np.arange(len(fp)), np.zeros(len(fp), dtype="int64"), np.zeros(len(fp), dtype="int64")
    low = 0
    for width in BLOCK_BITS[:blocks]:
        y = (fp >> np.uint64(low) & np.uint64((1 << width) - 1)).astype("int64")[row]
        low += width
        syndrome = byte[0][y & 255] ^ byte[1][y >> 8 & 255] ^ byte[2][y >> 16]
        parts = []
        for more, table in enumerate(tables[: threshold + 1]):
            fits = np.flatnonzero(excess + more <= threshold)
            e = table[syndrome[fits]]
            k, j = np.nonzero(e >= 0)
            at = fits[k]
            parts.append((row[at], anchor[at] << (CODE_BITS - CHECK_BITS) | (y[at] ^ e[k, j]) >> CHECK_BITS, excess[at] + more))
        row, anchor, excess = (np.concatenate(x) for x in zip(*parts))
    return row, anchor


def _anchor_rows(blocks: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cosets = golay_cosets()
        for batch in batches:
            whole = np.asarray(batch.column(0)).view("<u8")
            for i in range(0, len(whole), 4096):
                fp = whole[i : i + 4096]
                row, anchor = anchors(fp, blocks, THRESHOLD, cosets)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[row].view("<i8"))], names=["anchor", "fp"])

    return rows


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links a-b, a star per component: each member with the component's smallest."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new[u], new[v]):
            break
        label = new
    member = np.flatnonzero(new != np.arange(len(names)))
    return names[member], names[new[member]]


def linked(anchor: np.ndarray, fp: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints that share an anchor, given in the order of anchors, as stars."""
    size = np.diff(np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]])))
    size = np.repeat(size, size)
    left, right = [], []
    small = (size > 1) & (size <= SMALL_GROUP)
    g, x = anchor[small], fp[small]
    for lag in range(1, SMALL_GROUP):
        i = np.flatnonzero(g[lag:] == g[:-lag])
        if not len(i):
            break
        i = i[np.bitwise_count(x[i] ^ x[i + lag]) <= threshold]
        left.append(x[i])
        right.append(x[i + lag])
    g, x = anchor[size > SMALL_GROUP], fp[size > SMALL_GROUP]
    edges = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]])) if len(g) else []
    for a, b in zip(edges, edges[1:]):
        points, n = np.unique(x[a:b]), b - a
        flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype="<u8")])
        passes = max(1, n >> 16)
        for p in range(passes):  # points by hash, so that memory stays bounded
            near, owner = [], []
            for f in flips:
                v = points ^ f
                keep = slice(None) if passes == 1 else (v * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(passes) == p
                near.append(v[keep])
                owner.append(points[keep])
            near, owner = np.concatenate(near), np.concatenate(owner)
            order = np.argsort(near, kind="stable")
            near, owner = near[order], owner[order]
            same = near[1:] == near[:-1]
            left.append(owner[1:][same])
            right.append(owner[:-1][same])
    if not left or not sum(map(len, left)):
        return np.array([], dtype="<u8"), np.array([], dtype="<u8")
    return spanning(np.concatenate(left), np.concatenate(right))


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted anchors; what is held is joined once a group of anchors is complete, however many batches the last one spans."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def give() -> pa.RecordBatch:
        a, b = linked(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]).view("<u8"))
        return pa.RecordBatch.from_arrays([pa.array(a.view("<i8")), pa.array(b.view("<i8"))], names=["u", "v"])

    for batch in batches:
        anchor, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if not len(anchor):
            continue
        if size >= CHUNK_ROWS:
            more = int(np.searchsorted(anchor, held[-1][0][-1], side="right"))  # rows of the last anchor so far
            if more < len(anchor):
                held.append((anchor[:more], fp[:more]))
                yield give()
                held, size, anchor, fp = [], 0, anchor[more:], fp[more:]
        held.append((anchor, fp))
        size += len(anchor)
    if held:
        yield give()


def links(points: DataFrame, blocks: int = 2) -> DataFrame:
    """``u, v``: links that span the components of the different fingerprints in ``points.fp``."""
    dealt = points.select("fp").mapInArrow(_anchor_rows(blocks), "anchor long, fp long")
    return dealt.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_link_rows, "u long, v long")


def are_stars(edges: DataFrame) -> bool:
    """Whether each larger end ``u`` has one link and is no link's smaller end ``v``: then ``v`` is the component's smallest node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.count_if((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).alias("n")).first()["n"]


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: each node that has an edge with the smallest node of its component.

    Alternating star steps: every node hands the smallest neighbour to its
    larger, then to its smaller ones, until all that is left are stars around
    the smallest nodes. Minima are aggregated before the shuffle, so a node with
    any number of neighbours is one row per task. Few tables are settled: a
    table is a file a task, however small, and on a local disk Hadoop starts
    processes for each file.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # A smallest node may have any number of larger neighbours: against a settled table its join can be split.
        large = both.where("v > u").join(cut(least, "least"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = cut(small.where("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def simhash_groups(docs: DataFrame, blocks: int | None = None, size: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_h, fp, component_id``: a row per input row, with the smallest id reachable over links."""
    rows = cut(fingerprints(docs, size, seed, id_col, text_col), "fingerprints")
    points = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    if blocks is None:  # two blocks keep an anchor's group small up to about a hundred million fingerprints
        blocks = 2 if points.count() < 100_000_000 else 3
    label = components(links(points, blocks))
    named = points.join(label, points["fp"] == label["node"], "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    named = cut(named, "labels")
    lowest = cut(named.groupBy("label").agg(F.min("first").alias("component_id")), "lowest")
    by_fp = named.join(lowest, "label").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "text_h", "fp", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they were, less all but one of each group.

    Rows are told apart by id and text: the smallest id stays, of several texts
    with that id the one of the least hash, and of rows that repeat both one.
    """
    found = simhash_groups(docs, id_col=id_col, text_col=text_col, **options)
    texts = found.groupBy("component_id", "doc_id", "text_h").agg(F.count(F.lit(1)).alias("n"))
    # Null ids come last, as among a component's candidates.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_h")
    texts = cut(texts.select("component_id", "n", order.alias("k")), "texts")
    first = texts.groupBy("component_id").agg(F.min("k").alias("first"))
    named = texts.join(first, texts["component_id"].eqNullSafe(first["component_id"])).select("n", F.col("k.doc_id").alias("m_id"), F.col("k.text_h").alias("m_h"), (F.col("k") == F.col("first")).alias("stays"))
    marked = cut(named.where(~F.col("stays") | (F.col("n") > 1)).select("m_id", "m_h", "stays"), "marked")
    same = F.col(id_col).eqNullSafe(F.col("m_id")) & (F.xxhash64(text_of(text_col)) == F.col("m_h"))
    once = docs.join(marked, same, "left_anti")
    # Rows that repeat id and text: one of them, the same one whatever the task order.
    again = docs.join(marked.where("stays"), same).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "m_id", "m_h")
    again = again.groupBy("m_id", "m_h").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    return once.unionByName(again)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(read(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
