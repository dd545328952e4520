"""Line dedup: common lines leave every document, told by compressed keep bitmaps.

Hashes of line keys are range-partitioned (hot keys salted by document) with a
secondary sort by document and position; each key's first occurrences are
streamed from the sorted partitions. What comes back per document is a sparse
bitmap of kept lines (64 lines a word, absent word: all kept), never text. All
of it runs in the JVM.

Defined cases: null or empty text is one empty line; a line's key shorter than
``min_chars`` code points is never dropped; repeated lines of one document
count once; rows that repeat a document (same id and text) share its bitmap;
rows with one id and different texts count as one document; an empty table
gives an empty result; null ids are an id of their own. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, lines_of, prefixed, read, strip, text_of

SALT_ROWS = 1 << 18  # lines to a salt: a key with all lines would be that many a group


def _rows(docs: DataFrame, id_col: str, text_col: str, **more: Column) -> DataFrame:
    rows = prefixed(docs, doc_id=F.col(id_col), text=text_of(text_col), **more)
    return rows.withColumn("text_h", F.xxhash64("text"))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_h, keep``: for documents that lose lines, ``array<struct<word int, bits long>>``.

    A key found in at least ``min_docs`` documents loses all its lines, or all
    but its first occurrence (smallest id, then position) if ``keep_first``.
    """
    line = _rows(docs, id_col, text_col).select("doc_id", "text_h", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    line = line.select("doc_id", "text_h", "pos", ascii_lower(strip(F.col("line"))).alias("key")).where(F.length("key") >= min_chars)
    # The hashes of all lines, a few dozen bytes each, are made once for the sort's sample, the sort and the join.
    hashed = cut(line.select(
        "doc_id", "text_h", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
    ), "lines")
    # Ranges of (key, salt): a key with a third of all lines spreads over a third of that many ranges.
    salts = 1 + hashed.count() // SALT_ROWS
    salted = hashed.withColumn("salt", F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(salts)).cast("int"))
    ranged = salted.repartitionByRange("h1", "h2", "salt")
    stream = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "text_h", "pos")
    first = ranged.select("*", ((F.row_number().over(stream) == 1) | ~F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))).alias("opens"))
    part = first.groupBy("h1", "h2", "salt").agg(F.sum(F.col("opens").cast("long")).alias("n"), F.min(F.struct("doc_id", "text_h", "pos")).alias("first"))
    common = part.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min("first").alias("first")).where(F.col("n") >= min_docs)
    hit = hashed.join(cut(common, "common"), ["h1", "h2"])
    if keep_first:
        hit = hit.where(~F.struct("doc_id", "text_h", "pos").eqNullSafe(F.col("first")))
    hit = hit.select("doc_id", "text_h", "pos").repartition("doc_id", "text_h")
    word = hit.groupBy("doc_id", "text_h", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("drop"))
    return word.groupBy("doc_id", "text_h").agg(F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("drop").alias("bits")))).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Column | None = None) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` (the kept lines joined by ``\\n``) and, if given, ``carry``; a row per input row."""
    more = {"carry": carry} if carry is not None else {}
    rows = _rows(docs, id_col, text_col, **more)
    b = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("text_h").alias("b_h"), "keep")
    rows = rows.join(b, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("text_h") == F.col("b_h")), "left")
    rows = rows.select("doc_id", "text", *more, "keep", lines_of(F.col("text")).alias("lines"))
    # The sparse words as a dense array, so that a line finds its bit at once.
    dense = F.expr(
        "transform(array(map_from_entries(keep)), m -> transform(sequence(0, element_at(keep, -1).word), w -> coalesce(try_element_at(m, w), -1L)))[0]"
    )
    rows = rows.select("doc_id", "text", *more, "lines", F.when(F.col("keep").isNotNull(), dense).alias("bits"))
    kept = F.expr("filter(lines, (x, i) -> i div 64 >= size(bits) OR (shiftright(bits[cast(i div 64 as int)], cast(i % 64 as int)) & 1L) = 1L)")
    rows = rows.select("doc_id", "text", *more, "lines", F.when(F.col("bits").isNotNull(), kept).alias("kept_lines"))
    n = F.size("lines").cast("long")
    return rows.select(
        "doc_id", n.alias("n_lines"), F.when(F.col("kept_lines").isNull(), F.lit(0)).otherwise(n - F.size("kept_lines")).cast("long").alias("n_dropped"),
        F.when(F.col("kept_lines").isNull(), F.col("text")).otherwise(F.array_join("kept_lines", "\n")).alias("kept"), *more,
    )


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_docs, min_chars, keep_first, id_col, text_col), id_col, text_col)


def replace_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the kept lines as their text; other columns as they were."""
    others = [c for c in docs.columns if c != text_col]
    whole = F.struct(*[F.col(f"`{c}`") for c in others])
    out = apply_bitmaps(docs, keep_bitmaps(docs, id_col=id_col, text_col=text_col, **options), id_col, text_col, whole)
    return out.select(*[F.col("kept" if c == text_col else f"carry.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), common AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k
GROUP BY doc_id
"""
