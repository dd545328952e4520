"""Exact dedup by content-defined chunk recipes.

A text without its white space is cut where its content says so: the low digits
of ``GEAR`` characters in a row, whatever the script, decide on a boundary between
``MIN_CHUNK`` and ``MAX_CHUNK`` bytes, so equal texts have equal chunks and a
long stretch that texts share has chunks of its own. Chunks are deduplicated to verified
identifiers: a 64-bit hash plus the rank of the SHA-256 among the digests seen
under that hash (0 unless two chunks collide). Texts are equal when their
ordered identifier lists are. Only digests move between tasks, a few dozen
bytes a chunk; long documents stay where they were read. All in the JVM.

Defined cases: null equals empty (and any text of white space alone); of equal
texts the row with the most code points, then the smallest id (null first)
stays; rows that repeat a document are all returned, counted in ``group_size``
and share its verdict; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, cut, prefixed, read, text_of

MIN_CHUNK, MAX_CHUNK = 512, 16384
# A boundary: of the last characters, the low hexadecimal digits of their last bytes are all among these; for even digits one place in 4^4.
GEAR, LOW = 4, "159D"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    """Chunks of the bytes in hexadecimal: the shortest one from ``least`` bytes on that ends at a boundary."""
    boundary = f"(?:[C-F].(?:[89AB].){{0,2}})?.[{LOW}]" * GEAR
    return rf"(?:..){{{least},{most}}}?(?<=[{LOW}])(?<={boundary})|(?:..){{1,{most}}}"


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """``doc_id, text_sha256, n_chars, copies, chunks``: a row per different (id, normalised text, length)."""
    rows = prefixed(docs, doc_id=F.col(id_col), text=text_of(text_col))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.regexp_replace("text", SPACE_CLASS + "+", "").alias("norm"))
    rows = rows.select("doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"), F.regexp_extract_all(F.hex(F.encode("norm", "UTF-8")), F.lit(chunk_pattern(least, most)), 0).alias("parts"))
    rows = rows.select("doc_id", "n_chars", "text_sha256", F.transform("parts", lambda c: F.struct(F.xxhash64(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("sha"))).alias("chunks"))
    return rows.groupBy("doc_id", "text_sha256", "n_chars").agg(F.count(F.lit(1)).alias("copies"), F.first("chunks").alias("chunks"))


def recipes(rows: DataFrame) -> DataFrame:
    """Adds ``recipe``, the list of verified chunk identifiers in place of ``chunks``."""
    part = rows.select("doc_id", "text_sha256", "n_chars", F.posexplode("chunks").alias("pos", "c")).select("doc_id", "text_sha256", "n_chars", "pos", "c.h", "c.sha")
    seen = part.groupBy("h", "sha").agg(F.count(F.lit(1)).alias("n"))
    clash = seen.groupBy("h").agg(F.count(F.lit(1)).alias("shas"), F.collect_set("sha").alias("all")).where("shas > 1")
    rank = clash.select("h", F.posexplode(F.array_sort("all")).alias("rank", "sha")).where("rank > 0")
    named = part.join(rank, ["h", "sha"], "left").select("doc_id", "text_sha256", "n_chars", F.struct("pos", "h", F.coalesce("rank", F.lit(0)).alias("rank")).alias("c"))
    listed = named.groupBy("doc_id", "text_sha256", "n_chars").agg(F.array_sort(F.collect_list("c")).alias("c"))
    listed = listed.select(F.col("doc_id").alias("r_id"), F.col("text_sha256").alias("r_sha"), F.col("n_chars").alias("r_n"), F.transform("c", lambda c: F.struct(c["h"].alias("h"), c["rank"].alias("rank"))).alias("recipe"))
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_sha256") == F.col("r_sha")) & (F.col("n_chars") == F.col("r_n"))
    none = F.array().cast("array<struct<h:bigint,rank:int>>")
    return rows.drop("chunks").join(listed, same, "left").select("doc_id", "text_sha256", "n_chars", "copies", F.coalesce("recipe", none).alias("recipe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, a row per input row."""
    rows = cut(recipes(cut(chunked(docs, id_col, text_col, least, most), "chunks")), "recipes")
    # Counts and minima combine before the shuffle, so thousands of copies arrive as one row a task.
    group = rows.groupBy("recipe").agg(F.sum("copies").alias("size"), F.count(F.lit(1)).alias("members"), F.min(F.struct((-F.col("n_chars")).alias("n"), "doc_id")).alias("best"))
    group = cut(group.where("size > 1").select("recipe", "size", F.col("best.doc_id").alias("best_id")), "copies")
    out = rows.join(group, "recipe", "left")
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("best_id"))
    out = out.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256", F.explode(F.expr("array_repeat(true, cast(copies as int))")).alias("row"))
    return out.drop("row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir))


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, (count(*) OVER (PARTITION BY norm))::BIGINT AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""
