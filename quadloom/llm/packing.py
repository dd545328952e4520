"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents become token ids (a cache of words per worker, so that each
different word meets the tokenizer once), end with ``END`` and are cut into
pieces only where longer than a sequence. Full pieces are sequences of their
own. The rest is dealt at random into shards of about ``SHARD`` pieces. A shard
starts from its pieces as they come, a new sequence where one doesn't fit, which
leaves about a quarter of the places free; a local search makes the packing:
moves, one-for-one and two-for-one exchanges between underfull sequences, each
of which increases the sum of squared fills, until sequences empty. What the
shards leave in underfull sequences, about one a shard, meets again in fewer
shards, so the work per task stays bounded at any input size.

Defined cases: null text is an empty document of one token (the end); rows that
repeat a document are packed each; a text of any length works; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import string
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, prefixed, read, text_of

LENGTH, END, SHARD = 2048, 0, 4096
CACHED_WORDS, PART_BYTES = 300_000, 2_000_000
SEPARATOR = "<|endoftext|>"
MARKS = string.punctuation
CACHED_TAILS = 10_000
# Letters that stay single letters in the tokenizer's normal form (NFC, then lower case): Latin up to U+024F without the dotted capital I, Greek and Cyrillic.
PLAIN = re.compile("[A-Za-z\u00aa-\u012f\u0131-\u024f\u0370-\u052f]+")


# Bytes of characters from U+0300 on: below, there are no marks that the normal form could compose with a letter.
BEYOND = re.compile(rb"[\xcc-\xff]")


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, in lower case where that changes neither their normal form nor special tokens."""
    return (text if BEYOND.search(text) or b"<|" in text else text.lower()).split()


def plain(word: str) -> bool:
    """Whether a word has letters alone that are encoded as they stand, whatever stands beside them."""
    return word.isalpha() and (word.isascii() or PLAIN.fullmatch(word) is not None)


class WordCoder:
    """Ids of texts as little-endian 32-bit bytes; words are cached.

    The tokenizer drops white space and case and never joins words across
    white space, so a text is the concatenation of its words, and a ``plain``
    word followed by marks is the concatenation of both. Plain words are
    encoded many to a call and told apart by the ids that end a word, those of
    a-z by the model alone, as the normal form leaves them as they are; what
    remains is kept apart by a special token.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.cached, self.words = cached, {}
        self.mark = self.tokenizer.token_to_id(SEPARATOR)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.tails = {"": b""}

    def _one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _joined(self, tokenizer, words: list[str], glue: str, size: int) -> np.ndarray:
        texts = [glue.join(words[i : i + size]) for i in range(0, len(words), size)]
        return np.concatenate([np.array(e.ids, dtype="<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def _tail(self, marks: str) -> bytes:
        ids = self.tails.get(marks)
        if ids is None:
            ids = self._one(marks)
            if len(self.tails) < CACHED_TAILS:
                self.tails[marks] = ids
        return ids

    @staticmethod
    def shared(path: str) -> WordCoder:
        """The one of this process: a worker's later tasks find the words of its earlier ones."""
        kept = sys.modules.setdefault("_quadloom_coders", types.ModuleType("_quadloom_coders")).__dict__
        if path not in kept:
            kept[path] = WordCoder(path)
        return kept[path]

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        if not words:
            return {}
        # Only ASCII loses its case here: a letter's case decides which marks the normal form composes with it.
        texts = [w.lower().decode("ascii") if w.isascii() and b"<|" not in w else w.decode("utf-8", "replace") for w in words]
        known, fresh, others = {}, {True: [], False: []}, {}
        bare, tail = [], []
        for t in texts:
            stem = t.rstrip(MARKS)
            if not plain(stem):
                others[t] = b""
                stem = t
            elif stem not in known:
                known[stem] = self.words.get(stem.encode())
                if known[stem] is None:
                    fresh[stem.isascii()].append(stem)
            bare.append(stem)
            tail.append(t[len(stem) :])
        for tokenizer, names in ((self.bare, fresh[True]), (self.tokenizer, fresh[False])):
            if not names:
                continue
            ids = self._joined(tokenizer, names, " ", 64)
            edges = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
            if len(edges) == len(names) + 1:
                raw = ids.tobytes()
                known.update((n, raw[4 * a : 4 * b]) for n, a, b in zip(names, edges, edges[1:]))
            else:  # a word did not end as expected: none is taken from this call
                others.update(dict.fromkeys(names, b""))
        apart = [n for n in others if "<|" not in n]
        for i in range(0, len(apart), 64):
            ids = self._joined(self.tokenizer, apart[i : i + 64], SEPARATOR, 64)
            edges = [-1, *np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            others.update((n, ids[a + 1 : b].tobytes()) for n, a, b in zip(apart[i : i + 64], edges, edges[1:]))
        others.update((n, self._one(n)) for n in others if "<|" in n)
        known |= others
        return {w: known[t] + self._tail(m) if m else known[t] for w, t, m in zip(words, bare, tail)}

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text; a few megabytes of text are split into words at a time."""
        known = self.words
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size < PART_BYTES and i + 1 < len(texts):
                continue
            split = [words_of(t) for t in texts[first : i + 1]]
            first, size = i + 1, 0
            found = [list(map(known.get, words)) for words in split]
            fresh = self._encode(list({w for words, ids in zip(split, found) for w, x in zip(words, ids) if x is None}))
            if len(known) < self.cached:
                known.update(fresh)
            for words, ids in zip(split, found):
                try:
                    yield b"".join(ids)
                except TypeError:  # a new word
                    yield b"".join([fresh[w] if x is None else x for w, x in zip(words, ids)])


def _piece_rows(path: str, length: int, end: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder, tail, width = WordCoder.shared(path), int(end).to_bytes(4, "little"), 4 * length
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            row, piece, start, size, crc = [], [], [], [], []
            for i, raw in enumerate(coder.encode(texts)):
                raw += tail
                for k in range(0, len(raw), width):
                    part = raw[k : k + width]
                    row.append(i)
                    piece.append(k // width)
                    start.append(k // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: a row per piece of each row of ``docs``."""
    rows = prefixed(docs, doc_id=F.col(id_col), text=text_of(text_col).cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_piece_rows(path, length, end), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def dealt(sizes: list[int], length: int) -> list[list[int]]:
    """A first deal without any search: items in their order, a new bin where one doesn't fit."""
    bins, room = [], 0
    for i, n in enumerate(sizes):
        if n > room:
            bins.append([])
            room = length
        bins[-1].append(i)
        room -= n
    return bins


class LocalSearch:
    """Moves and exchanges between underfull bins, each of which increases the sum of squared fills.

    A bin receives an item of another underfull bin and gives none, one or two
    back; of all such steps the one that leaves it the least room is taken, and
    it must end up fuller than the other one was. Bins receive in the order of
    their largest items: those that few items fit have the first choice, and
    bins whose items all went elsewhere are empty. Rounds end when no bin has a
    step left, or when no fewer bins could hold the items.

    ``at[v]`` lists the items of size ``v`` in underfull bins; entries that no
    longer hold are dropped when met.
    """

    def __init__(self, sizes: list[int], bins: list[list[int]], length: int):
        self.sizes, self.bins, self.length = sizes, [list(b) for b in bins], length
        self.fill = [sum(sizes[i] for i in b) for b in bins]
        self.home = [0] * len(sizes)
        self.at: list[list[int]] = [[] for _ in range(length + 1)]
        self.held = 0  # bit v: at[v] has entries
        self.steps = {"move": 0, "one for one": 0, "one for two": 0}
        self.emptied = 0
        for b, items in enumerate(self.bins):
            for i in items:
                self.home[i] = b
                if self.fill[b] < length:
                    self._list(i)

    def _list(self, i: int) -> None:
        self.at[self.sizes[i]].append(i)
        self.held |= 1 << self.sizes[i]

    def _closest(self, most: int, back: int, b: int, worst: int):
        """``(left, item)``: of the items up to ``most`` the largest that bin ``b`` may have for ``back`` tokens, if it leaves less than ``worst``."""
        held, fill, home = self.held & ((2 << most) - 1), self.fill, self.home
        low = max(back, most - worst)
        while held:
            x = held.bit_length() - 1
            if x <= low:
                return None
            here = self.at[x]
            k = len(here) - 1
            while k >= 0:
                i = here[k]
                h = home[i]
                if fill[h] == self.length:
                    here[k] = here[-1]
                    here.pop()
                elif h != b and fill[b] + x - back > fill[h]:
                    return most - x, i
                k -= 1
            if not here:
                self.held &= ~(1 << x)
            held &= ~(1 << x)
        return None

    def _step(self, b: int):
        """The best step of bin ``b``: the item it gets and those it gives back."""
        sizes, items, room = self.sizes, self.bins[b], self.length - self.fill[b]
        top, best, worst = self.length - 1, None, room
        found = self._closest(min(room, top), 0, b, worst)
        if found:
            (worst, item), best = found, (found[1], [])
        if worst:
            for y, i in {sizes[i]: i for i in items}.items():
                found = self._closest(min(room + y, top), y, b, worst)
                if found:
                    (worst, item), best = found, (found[1], [i])
                    if not worst:
                        break
        if worst:
            pairs = {sizes[i] + sizes[j]: [i, j] for k, i in enumerate(items) for j in items[k + 1 :]}
            for y, ij in pairs.items():
                if room + y <= top:
                    found = self._closest(room + y, y, b, worst)
                    if found:
                        (worst, item), best = found, (found[1], ij)
                        if not worst:
                            break
        return best

    def _fill(self, b: int) -> bool:
        """All steps of one bin; whether there was any."""
        moved = False
        while self.fill[b] < self.length:
            step = self._step(b)
            if step is None:
                break
            i, back = step
            giver, gain = self.home[i], self.sizes[i] - sum(self.sizes[j] for j in back)
            self.bins[giver].remove(i)
            self.bins[giver] += back
            self.bins[b] = [j for j in self.bins[b] if j not in back] + [i]
            self.home[i] = b
            for j in back:
                self.home[j] = giver
            self.fill[giver] -= gain
            self.fill[b] += gain
            self.steps[("move", "one for one", "one for two")[len(back)]] += 1
            self.emptied += not self.bins[giver]
            moved = True
        return moved

    def run(self) -> list[list[int]]:
        fewest = -(-sum(self.fill) // self.length)
        alive, moved = sum(map(bool, self.bins)), True
        while moved and alive - self.emptied > fewest:
            moved = False
            for b in sorted((b for b, n in enumerate(self.fill) if 0 < n < self.length), key=lambda b: (-max(self.sizes[i] for i in self.bins[b]), b)):
                if alive - self.emptied <= fewest:
                    break
                if self.bins[b]:
                    moved |= self._fill(b)
        return [b for b in self.bins if b]


def _pack_shard(length: int, number: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "piece"], kind="stable").sample(frac=1, random_state=7).reset_index(drop=True)
        sizes = rows["length"].tolist()
        bins = LocalSearch(sizes, dealt(sizes, length), length).run()
        seq, offset, fill = (np.zeros(len(sizes), dtype="int64") for _ in range(3))
        first = number << 56 | int(rows["shard"].iloc[0]) << 24
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                seq[i], offset[i] = first + k, at
                at += sizes[i]
            fill[b] = at
        return rows.drop(columns="shard").assign(sequence_id=seq, offset=offset, fill=fill)

    return pack


def pack(rows: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces that can be read again.

    What shards leave in underfull sequences meets again, in fewer shards, until
    one shard holds it all.
    """
    full = rows.where(F.col("length") == length).withColumns({"sequence_id": -F.monotonically_increasing_id() - 1, "offset": F.lit(0).cast("long")})
    part, done, number, names = rows.where(F.col("length") < length), full, 0, rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long, fill long"
    left = part.count()
    while True:
        n = max(1, -(-left // shard))
        # Dealt by place in the table, not by id: rows that repeat an id spread like any others.
        given = part.withColumn("shard", F.pmod(F.xxhash64(F.lit(number), F.monotonically_increasing_id()), F.lit(n)).cast("int"))
        packed = given.groupBy("shard").applyInPandas(_pack_shard(length, number), schema)
        if n == 1:
            return done.unionByName(packed.drop("fill"))
        packed, before = cut(packed, "packed"), left
        part = packed.where(F.col("fill") < length).select(*names)
        left = part.count()
        if left > before // 2:  # sizes that fill no sequence: another round would change little
            return done.unionByName(packed.drop("fill"))
        done = done.unionByName(packed.where(F.col("fill") == length).drop("fill"))
        number += 1


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack(cut(pieces(docs, path, length, end, id_col, text_col), "pieces"), length, shard)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir))
