"""Substring dedup by repeated-phrase automata.

Every window of ``WINDOW`` words that also starts in a document with a smaller
id loses its words. Equal word sequences are collapsed first. Then

1. each document lists its minimizers: of the ``GRAM``-word hashes in a window
   the smallest, so equal windows list an equal one (about one in five words);
2. minimizers of two or more documents are kept, with as many salts as their
   count asks for, and each document cuts out the stretches (a few dozen words)
   whose windows have such a minimizer, each different one once with its places;
3. stretches meet by minimizer and salt; windows found in two documents are
   confirmed with their first document, compiled into sharded Aho-Corasick
   automata over word numbers (exact, no hashes), and the shard's stretches are
   streamed through to locate every occurrence in a later document. Salted
   minimizers confirm across their salts by an aggregation first, and a phrase
   goes back to the salts that hold it;
4. located words are removed.

Shuffled are minimizers and stretches, a fraction of the text, and the texts of
the documents once for cutting and once for removing. Groups are bounded by the
salts; an automaton holds the windows of ``SHARD`` different ones and of the
group it ends in.

Defined cases: null text has no words; fewer words than a window: nothing goes;
rows that repeat an id don't remove each other's words; a null id counts as the
smallest; ids that aren't integers are refused; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import cut, prefixed, read, text_of

WINDOW, GRAM = 13, 4
SALT_ROWS = 4096
# Windows to an automaton: small ones stay in a core's cache; salted groups are streamed once for each of theirs.
SHARD, SALTED_SHARD = 2_000, 40_000
NULL_ID = -(1 << 63)


class WordHashes:
    """64-bit hashes of the words of a text whose words are joined by one space.

    A polynomial over the bytes, from prefix sums and brought to the word's own
    start, so equal words have equal hashes wherever they stand. Chance
    equality only makes texts meet; what is repeated is settled on the words.
    """

    def __init__(self, block: int = 1 << 18):
        base, size = 0x9E3779B97F4A7C15, block + (1 << 12)
        self.block = block
        self.power = np.cumprod(np.full(size, base, dtype="<u8"))
        self.inverse = np.cumprod(np.full(size, pow(base, -1, 1 << 64), dtype="<u8"))

    def __call__(self, joined: bytes) -> np.ndarray:
        if len(joined) <= self.block:
            return self._hashes(joined)
        out, at = [], 0
        while at < len(joined):
            end = joined.rfind(b" ", at, at + self.block)
            if end < at or at + self.block >= len(joined):
                end = len(joined) if at + self.block >= len(joined) else joined.find(b" ", at)
                end = len(joined) if end < 0 else end
            out.append(self._hashes(joined[at:end]))
            at = end + 1
        return np.concatenate(out)

    def _hashes(self, joined: bytes) -> np.ndarray:
        b = np.frombuffer(joined, dtype="u1")
        if len(b) > len(self.power):  # one word of that length
            import xxhash

            return np.array([xxhash.xxh64_intdigest(joined)], dtype="<u8")
        total = np.zeros(len(b) + 1, dtype="<u8")
        np.cumsum(self.power[: len(b)] * (b + np.uint64(1)), out=total[1:])
        gap = np.flatnonzero(b == 32)
        start, end = np.concatenate([[0], gap + 1]), np.concatenate([gap, [len(b)]])
        return (total[end] - total[start]) * self.inverse[start]


def minimizers(a: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Per window of words its smallest gram hash; the minimum over a span is one over two overlapping spans of a power of two."""
    n = len(a) - gram + 1
    g = np.zeros(n, dtype="<u8")
    for j in range(gram):
        g = (g ^ a[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        g ^= g >> np.uint64(32)
    span, width = window - gram + 1, 1
    while 2 * width <= span:
        g = np.minimum(g[:-width], g[width:])
        width *= 2
    rest = span - width
    return (np.minimum(g[: len(g) - rest], g[rest:]) if rest else g).view("<i8")


def runs(value: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(value):
        return np.zeros(1, dtype="int64")
    return np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1], [True]]))


def _list_rows(window: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of = WordHashes()
        for batch in batches:
            n, sha, s1, s2, found = [], [], [], [], []
            for text in batch.column(3).to_pylist():
                words = text.split()
                joined = b" ".join(words)
                seq = hashlib.blake2b(joined, digest_size=16).digest()
                n.append(len(words))
                sha.append(hashlib.sha256(joined).hexdigest())
                s1.append(int.from_bytes(seq[:8], "little", signed=True))
                s2.append(int.from_bytes(seq[8:], "little", signed=True))
                mins = minimizers(hashes_of(joined), window, gram) if len(words) >= window else np.zeros(0, "<i8")
                found.append(np.unique(mins[runs(mins)[:-1]]))
            ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            mins = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found) if found else np.zeros(0, "<i8")))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), mins], names=["doc_id", "key_id", "text_h", "n_words", "sha", "seq1", "seq2", "mins"])

    return rows


def _stretch_rows(window: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes_of = WordHashes()
        for batch in batches:
            keys, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = {k: [] for k in ("h", "salts", "salt", "key_id", "text_h", "pos", "words")}
            lists = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            for key, text_h, (text, mins, salts) in zip(keys, hashes, lists):
                words = text.split()
                if len(words) < window:
                    continue
                value = minimizers(hashes_of(b" ".join(words)), window, gram)
                order = np.argsort(mins := np.array(mins, dtype="<i8"))
                mins, salts = mins[order], np.array(salts)[order]
                # Runs of windows with one minimizer: a repeated word is one stretch, not one a window,
                # and a stretch that the text repeats is one row with all its places.
                edge = runs(value)
                at = np.minimum(np.searchsorted(mins, value[edge[:-1]]), len(mins) - 1)
                places: dict[tuple[int, bytes], list[int]] = {}
                for i in np.flatnonzero(mins[at] == value[edge[:-1]]).tolist():
                    a, b = int(edge[i]), int(edge[i + 1])
                    places.setdefault((int(at[i]), b" ".join(words[a : b - 1 + window])), []).append(a)
                for (i, stretch), pos in places.items():
                    k = int(salts[i])
                    out["h"].append(int(mins[i]))
                    out["salts"].append(k)
                    out["salt"].append(zlib.crc32(stretch, text_h & 0xFFFFFFFF) % k)
                    out["key_id"].append(key)
                    out["text_h"].append(text_h)
                    out["pos"].append(pos)
                    out["words"].append(stretch)
            types = {"h": pa.int64(), "salts": pa.int32(), "salt": pa.int32(), "key_id": pa.int64(), "text_h": pa.int64(), "pos": pa.list_(pa.int32()), "words": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in types.items()], names=list(types))

    return rows


class Shard:
    """Stretches and the confirmed windows that an automaton finds in them.

    Words are numbered within the shard; a window's key is its numbers as bytes.
    """

    def __init__(self, window: int):
        self.window, self.number = window, {}
        self.first: dict[bytes, int] = {}
        self.phrases: dict[bytes, int] = {}
        self.stretches: list[tuple[int, int, list[int], array]] = []

    def numbers(self, words: bytes) -> array:
        number = self.number
        return array("I", [number.setdefault(w, len(number)) for w in words.split(b" ")])

    def add(self, key: int, text_h: int, pos: list[int], words: bytes) -> None:
        """Stretches of one minimizer come by rising id, so a window's first document comes first."""
        ids = self.numbers(words)
        self.stretches.append((key, text_h, pos, ids))
        raw, first, width = ids.tobytes(), self.first, ids.itemsize * self.window
        for i in range(0, len(raw) - width + 1, ids.itemsize):
            w = raw[i : i + width]
            f = first.setdefault(w, key)
            if f != key:
                self.phrases[w] = f if w not in self.phrases else min(f, self.phrases[w])

    def located(self) -> Iterator[tuple[int, int, list[int]]]:
        """``id, text_h, starts`` of the windows that a document with a smaller id holds too."""
        import ahocorasick

        if not self.phrases:
            return
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for w, first in self.phrases.items():
            automaton.add_word(tuple(array("I", w)), first)
        automaton.make_automaton()
        for key, text_h, pos, ids in self.stretches:
            found = [end - self.window + 1 for end, first in automaton.iter(tuple(ids)) if first < key]
            if found:
                yield key, text_h, [p + k for p in pos for k in found]


_HITS = "key_id long, text_h long, starts array<int>"


def _hit_batch(found: list[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.list_(pa.int32()))], names=["key_id", "text_h", "starts"])


def _locate_rows(window: int):
    """Whole minimizer groups, in order of minimizer and id: confirm, compile, stream."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = Shard(window), None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for h, key, text_h, pos, words in zip(*columns):
                if h != last and len(shard.first) >= SHARD:
                    yield _hit_batch(list(shard.located()))
                    shard = Shard(window)
                last = h
                shard.add(key, text_h, pos, words)
        yield _hit_batch(list(shard.located()))

    return rows


def _confirm_rows(window: int):
    """Different windows of each salt of a minimizer, with their least and largest ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def give(h: int, salt: int) -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([h] * len(seen), pa.int64()), pa.array([salt] * len(seen), pa.int32()), pa.array(list(seen), pa.binary()), pa.array([x[0] for x in seen.values()], pa.int64()), pa.array([x[1] for x in seen.values()], pa.int64())], names=["h", "salt", "phrase", "lo", "hi"])
            seen.clear()
            return out

        seen: dict[bytes, tuple[int, int]] = {}
        last = None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for h, salt, key, words in zip(*columns):
                if last is not None and ((h, salt) != last or len(seen) >= SALTED_SHARD):
                    yield give(*last)
                last = h, salt
                split = words.split()
                for i in range(len(split) - window + 1):
                    p = b" ".join(split[i : i + window])
                    lo, hi = seen.get(p, (key, key))
                    seen[p] = (min(lo, key), max(hi, key))
        if last is not None:
            yield give(*last)

    return rows


def _locate_salted(window: int):
    def locate(stretches: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
        found = []
        for a in range(0, max(len(phrases), 1), SALTED_SHARD):
            shard = Shard(window)
            for p, lo in zip(phrases["phrase"].iloc[a : a + SALTED_SHARD], phrases["lo"].iloc[a : a + SALTED_SHARD]):
                shard.phrases[shard.numbers(p).tobytes()] = lo
            shard.stretches = [(k, t, pos, shard.numbers(w)) for k, t, pos, w in zip(stretches["key_id"], stretches["text_h"], stretches["pos"], stretches["words"])]
            found += shard.located()
        return pd.DataFrame(found, columns=["key_id", "text_h", "starts"])

    return locate


def _remove_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone, sha = [], []
            for text, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.split()
                change = np.zeros(len(words) + 1, dtype="int64")
                s = np.unique(np.array(starts, dtype="int64"))
                change[s] += 1
                np.subtract.at(change, s + window, 1)
                keep = np.cumsum(change[:-1]) == 0
                gone.append(int(len(words) - keep.sum()))
                sha.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["key_id", "text_h", "n_removed", "kept_sha256"])

    return rows


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The listed rows, the rows whose whole word sequence stands in an earlier document, and ``key_id, text_h, starts`` of all other repeated windows."""
    text = text_of(text_col)
    rows = prefixed(docs, doc_id=F.col(id_col), key_id=F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), text_h=F.xxhash64(text), text=text.cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    listed = cut(rows.mapInArrow(_list_rows(window, gram), f"doc_id {kind}, key_id long, text_h long, n_words long, sha string, seq1 long, seq2 long, mins array<long>"), "minimizers")
    first = cut(listed.groupBy("seq1", "seq2").agg(F.min("key_id").alias("first"), F.max("key_id").alias("last")).where("first < last"), "sequences")
    copies = cut(listed.select("key_id", "text_h", "seq1", "seq2").join(first, ["seq1", "seq2"]).where("key_id > first").select("key_id", "text_h").distinct(), "copies")

    one = listed.select("key_id", "text_h", "mins").join(copies, ["key_id", "text_h"], "left_anti").select("key_id", "text_h", F.explode("mins").alias("h"))
    shared = one.groupBy("h").agg(F.min("key_id").alias("lo"), F.max("key_id").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi")
    shared = cut(shared.select("h", F.expr(f"cast((n - 1) div {SALT_ROWS} + 1 as int)").alias("salts")), "shared")
    lists = cut(one.join(shared, "h").groupBy("key_id", "text_h").agg(F.collect_list("h").alias("mins"), F.collect_list("salts").alias("salts")), "lists")

    cutting = rows.select("key_id", "text_h", "text").join(lists, ["key_id", "text_h"]).select("key_id", "text_h", "text", "mins", "salts")
    stretches = cut(cutting.mapInArrow(_stretch_rows(window, gram), "h long, salts int, salt int, key_id long, text_h long, pos array<int>, words binary"), "stretches")
    whole = stretches.where("salts = 1").select("h", "key_id", "text_h", "pos", "words").repartition("h").sortWithinPartitions("h", "key_id")
    hits = cut(whole.mapInArrow(_locate_rows(window), _HITS), "hits")
    salted = stretches.where("salts > 1")
    part = salted.select("h", "salt", "key_id", "words").repartition("h", "salt").sortWithinPartitions("h", "salt")
    confirmed = part.mapInArrow(_confirm_rows(window), "h long, salt int, phrase binary, lo long, hi long").groupBy("h", "phrase").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_set("salt").alias("salt")).where("lo < hi")
    # A phrase goes back to the salts that hold it, so there are no more rows than windows were confirmed from.
    confirmed = cut(confirmed.select("h", "phrase", "lo", F.explode("salt").alias("salt")), "confirmed")
    more = salted.groupBy("h", "salt").cogroup(confirmed.groupBy("h", "salt")).applyInPandas(_locate_salted(window), _HITS)
    return listed, copies, hits.unionByName(cut(more, "more"))


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``, a row per input row."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer: documents are ordered by it")
    listed, copies, hits = repeated_windows(docs, window, gram, id_col, text_col)
    starts = cut(hits.groupBy("key_id", "text_h").agg(F.flatten(F.collect_list("starts")).alias("starts")), "starts")
    text = text_of(text_col)
    rows = prefixed(docs, key_id=F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), text_h=F.xxhash64(text), text=text.cast("binary"))
    less = rows.join(starts, ["key_id", "text_h"]).select("key_id", "text_h", "text", "starts").mapInArrow(_remove_rows(window), "key_id long, text_h long, n_removed long, kept_sha256 string")
    less = cut(less.dropDuplicates(["key_id", "text_h"]), "less")
    gone = copies.withColumn("copy", F.lit(True))
    out = listed.drop("mins").join(less, ["key_id", "text_h"], "left").join(gone, ["key_id", "text_h"], "left")
    whole = F.col("copy").isNotNull() & (F.col("n_words") >= window)
    return out.select(
        "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir))
