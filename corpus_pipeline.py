"""From raw documents to packed sequences: five stages, each on all that the one before kept.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``. SQL cannot express fingerprints, dual variables or
token ids, so there is no ``ORACLE_SQL``; the stages are tested against
brute-force versions of the operators that they call.

Defined cases: a null or empty text has no words and goes in the first stage;
texts of any length pass whole; rows that repeat id and text are judged each and
left as one by near_copies, which keeps rows of one id whose texts differ where
their groups do; ties go to the smallest id, then the least hash of the text;
an empty table gives an empty result; extra columns are kept by all stages but
the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.llm import line_dedup, mixing, packing, quality, simhash
from quadloom.llm.common import cut, drop_tables, kept_tables, read

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and lines that the rules reject go; ``n_chars`` follows the text."""
    out = quality.quality_filter(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go; ``n_chars`` follows the text."""
    out = line_dedup.replace_text(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", common_lines),
    ("simhash_near_dedup", near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir), kept_tables()
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        drop_tables(spark, before, docs)  # what the stages so far wrote, but for their result
    return STAGES[-1][1](spark, docs, sf_dir)
