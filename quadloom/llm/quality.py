"""Quality rules, line first: bad lines go, then documents that lose too much.

Every line with a word is held against four rules: punctuation (runs of ! ? .
or of symbols, but for a heading's mark, in over ``PUNCT_SHARE`` percent of its
words), navigation (``NAV_MARKS`` or more menu separators, in a short line or as
``NAV_SHARE`` percent of a longer one's words), links (addresses and tags as
``LINK_SHARE`` percent of its words) and boilerplate (a short line with a stock
phrase, or one that breaks off in an ellipsis). Lines that fail are removed; a
document is rejected if the base rules fail or the removed lines hold over
``max_lost`` percent of its words. All of it is DataFrame functions within a
row; nothing is shuffled. (Lines common to many documents are line dedup's.)

Defined cases: a null text has no words (and so fails the base rules); blank
lines are neither judged nor counted and stay; equal lines count from the second
on; repeated rows are judged each; an empty table gives an empty result; extra
columns are ignored by ``judge`` and kept by ``quality_filter``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, count_words, let, lines_of, prefixed, read, text_of, words_of

# Patterns of the line rules (valid for Java and RE2 alike).
RUN = r"[!?]{2,}|[.]{4,}|[#*$%&|<>]{3,}"
HEADING = r"^[\x20\x09]*#{3,6}[\x20\x09]"
NAV_MARK = r"[|»›•·]|>>|::"
LINK = r"https?://|www[.]|<[A-Za-z/]"
BOILERPLATE = (
    r"(?i)(cookie policy|privacy policy|terms of (use|service)|accept (all )?cookies|subscribe to our|sign up for|log ?in to|"
    r"click here|read more|continue reading|enable javascript|skip to (main )?content|back to top|share (this )?on (facebook|twitter)|follow us on)"
)
TEASER = r"([.]{3}|…)[\x20\x09-\x0D]*$"
SYMBOLS = r"[#*$%&|<>]"
PUNCT_SHARE, NAV_MARKS, NAV_SHARE, LINK_SHARE, SHORT_WORDS, MAX_LOST = 30, 3, 20, 50, 30, 50
MIN_WORDS, MAX_REPEAT = 50, 50
POSITIONS = 24


def repeat_words(words: Column) -> Column:
    """How many words stand in a 3-word window that the text holds twice or more.

    A window becomes one long, its hash with the position in the low bits, so
    the sort is one of primitives and equal windows are neighbours by their high
    bits. What such neighbours suggest (hardly ever by chance) is settled on the
    whole hashes. The cost is n log n for a text of any length; one with more
    windows than ``POSITIONS`` bits can tell apart is settled whole.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    whole = let(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - 2), lambda i: F.xxhash64(F.element_at(h, i), F.element_at(h, i + 1), F.element_at(h, i + 2))))
    low = F.lit((1 << POSITIONS) - 1).cast("long")

    def suggested(w: Column) -> Column:
        packed = F.sort_array(F.transform(w, lambda x, i: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))))
        high = lambda x: F.shiftright(x, POSITIONS)
        found = let(packed, lambda p: F.filter(p, lambda x, k: (high(F.get(p, k - 1)) == high(x)) | (high(F.get(p, k + 1)) == high(x))))
        return F.when(F.size(w) <= 1 << POSITIONS, F.transform(found, lambda x: x.bitwiseAND(low).cast("int"))).otherwise(F.sequence(F.lit(0), F.size(w) - 1))

    def settled(w: Column, s: Column) -> Column:
        pairs = F.sort_array(F.transform(s, lambda i: F.struct(F.get(w, i).alias("h"), i.alias("i"))))
        near = lambda p, k: F.get(p, k)["h"]
        return let(pairs, lambda p: F.sort_array(F.transform(F.filter(p, lambda x, k: near(p, k - 1).eqNullSafe(x["h"]) | near(p, k + 1).eqNullSafe(x["h"])), lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)

    plain = let(whole, lambda w: let(suggested(w), lambda s: F.when(F.size(s) == 0, F.lit(0)).otherwise(let(settled(w, s), covered))))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(plain).cast("long")


def line_fails(line: Column) -> Column:
    """Whether a line fails a rule; a line without words never does."""
    # Most lines hold none of the marks; words are counted only for the others.
    has, count = lambda p: F.rlike(line, F.lit(p)), lambda p: F.regexp_count(line, F.lit(p))

    def judged(n: Column) -> Column:
        runs = (count(RUN) - has(HEADING).cast("int")) * 100 > n * PUNCT_SHARE
        menu = (count(NAV_MARK) >= NAV_MARKS) & ((n <= SHORT_WORDS) | (count(NAV_MARK) * 100 >= n * NAV_SHARE))
        return (n > 0) & (runs | menu | (count(LINK) * 100 >= n * LINK_SHARE) | ((n <= SHORT_WORDS) & (has(BOILERPLATE) | has(TEASER))))

    return F.when(has(f"{RUN}|{NAV_MARK}|{LINK}|{TEASER}") | has(BOILERPLATE), let(count_words(line), judged)).otherwise(F.lit(False))


def _lines(text: Column) -> Column:
    """``array<struct<line, bad>>``, so that each line is judged once."""
    return F.transform(lines_of(text), lambda x: F.struct(x.alias("line"), line_fails(x).alias("bad")))


def _lost(lines: Column) -> Column:
    return F.aggregate(F.filter(lines, lambda x: x["bad"]), F.lit(0).cast("long"), lambda a, x: a + count_words(x["line"]))


def _cleaned(lines: Column) -> Column:
    return F.array_join(F.transform(F.filter(lines, lambda x: ~x["bad"]), lambda x: x["line"]), "\n")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: int = MAX_LOST) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost_words, cleaned``: the verdicts and the text without failed lines."""
    rows = prefixed(docs, doc_id=F.col(id_col), text=text_of(text_col))
    rows = rows.select("doc_id", "text", words_of(F.col("text")).alias("words"), _lines(F.col("text")).alias("lines"), F.filter(lines_of(F.col("text")), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))).alias("full"))
    rows = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(F.regexp_replace("text", SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"), (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        let(F.col("words"), repeat_words).alias("n_repeat_words"), _lost(F.col("lines")).alias("n_lost_words"), _cleaned(F.col("lines")).alias("cleaned"),
    )
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("n_lost_words") * 100 <= F.col("n_words") * max_lost))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words", "cleaned")


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: int = MAX_LOST) -> DataFrame:
    """The rows of ``docs`` that the rules keep, without their failed lines; the other columns as they were."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.lit(True).alias("_")).alias("row")
    text = text_of(f"`{text_col}`")
    facts = lambda w, x: F.struct(F.size(w).alias("n"), repeat_words(w).alias("again"), _lost(x).alias("lost"), _cleaned(x).alias("cleaned"))
    judged = let(words_of(text), lambda w: let(_lines(text), lambda x: facts(w, x)))
    good = lambda s: (s["n"] >= MIN_WORDS) & (s["again"] * 100 <= s["n"] * MAX_REPEAT) & (s["lost"] * 100 <= s["n"] * max_lost)
    # An array of one or none: a filter on the facts would be pushed down and make them twice.
    rows = docs.select(others, F.explode(F.filter(F.array(judged), good)).alias("fact"))
    return rows.select(*[F.col("fact.cleaned" if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts, and length and digest of the text that is left once failed lines are gone."""
    return judge(read(spark, sf_dir)).withColumns({"cleaned_chars": F.length("cleaned").cast("long"), "cleaned_sha256": F.sha2("cleaned", 256)}).drop("cleaned")


_COUNT = "len(regexp_extract_all(x, '{}'))"
ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM d, unnest(range(1, len(w) - 1)) AS u(i)
), twice AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1
), again AS (
  SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id
), x AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d
), line AS (
  SELECT *, n > 0 AND (
      ({_COUNT.format(RUN)} - regexp_matches(x, '{HEADING}')::INT) * 100 > n * {PUNCT_SHARE}
      OR {_COUNT.format(NAV_MARK)} >= {NAV_MARKS} AND (n <= {SHORT_WORDS} OR {_COUNT.format(NAV_MARK)} * 100 >= n * {NAV_SHARE})
      OR {_COUNT.format(LINK)} * 100 >= n * {LINK_SHARE}
      OR n <= {SHORT_WORDS} AND (regexp_matches(x, '{BOILERPLATE}') OR regexp_matches(x, '{TEASER}'))) AS bad
  FROM (SELECT *, len(regexp_extract_all(x, '[^ \t\n\x0B\f\r]+')) AS n FROM x)
), left_over AS (
  SELECT doc_id, coalesce(sum(n) FILTER (WHERE bad), 0) AS lost, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT bad), '') AS cleaned FROM line GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[ \t\n\x0B\f\r]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(again.n, 0)::BIGINT AS n_repeat_words, lost::BIGINT AS n_lost_words, length(cleaned)::BIGINT AS cleaned_chars, sha256(cleaned) AS cleaned_sha256
  FROM d LEFT JOIN again USING (doc_id) LEFT JOIN left_over USING (doc_id)
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words) AND n_lost_words * 100 <= n_words * {MAX_LOST} AS kept
FROM m
"""
