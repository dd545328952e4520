"""LM scoring with a hidden Markov language model trained by Baum-Welch.

Tokens are the words with A-Z lower-cased and one end token a text. Each word
has a class it can be told by alone: the ``OWN`` most frequent words are
classes of their own, the others fall into ``SUFFIXES`` classes by their last
letters, the end token is a class. The model: a hidden state walks from token
to token, emits the token's class, and the class emits the word,

    P(text) = [sum over state paths of prod P(state|last) P(class|state)] * prod P(word|class),
    P(word|class) = (c + 1) / (n_class + V_class + 1)

with one slot a class for words not in training; classes of one word emit it
surely. Word counts grow with the corpus and stay distributed; the state part
has a fixed size.

Training covers all training texts, whole: each Baum-Welch step reads the class
sequences (made once, two bytes a token) and every task adds up its expected
counts. A text is worked on in stretches of ``STRETCH`` tokens side by side; the
products of a stretch's transitions carry the exact forward and backward
messages over its borders, so the counts are those of the whole text. The counts
meet as ``(index, value)`` rows in one aggregation, so the driver gets the
model's size and never a row per task. Steps end when one lifts the likelihood
by less than ``GAIN`` (log10 a token), or after ``STEPS``. Scoring is exact: the
scaled forward recursion over each whole text.

Counts of the ``HEAD`` most frequent words (a fixed number) are broadcast; other
words meet their counts in a join by 64-bit hash, so no frequent word can make
a hot key.

Defined cases: null text is the end token alone; a null id hashes as the empty
text; rows that repeat a document are scored each, and count each in training;
an empty training set gives the uniform model (every count 0, N = V = 0); an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, prefixed, read, text_of

FOLDS, HELD_OUT = 7, 2
STATES, STEPS, GAIN, STRETCH = 8, 12, 0.002, 64
OWN, SUFFIXES = 512, 512
HEAD = 1 << 18
FLUSH, CACHED = 400_000, 300_000
SMOOTH = 1.0


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIXES


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    def flush() -> pa.RecordBatch:
        h = np.array([xxhash.xxh64_intdigest(w) for w in counts], dtype="<u8").view("<i8")
        s = np.array([suffix_class(w) for w in counts], dtype="int32")
        out = pa.RecordBatch.from_arrays([pa.array(h), pa.array(s), pa.array(list(counts.values()), pa.int64())], names=["h", "suffix", "c"])
        counts.clear()
        return out

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(text.lower().split())
            if len(counts) > FLUSH:
                yield flush()
    if counts:
        yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """``h, suffix, c``: occurrences by word hash, from a binary column ``text``."""
    return texts.select("text").mapInArrow(_count_rows, "h long, suffix int, c long").groupBy("h", "suffix").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """About the ``most`` most frequent words: all above a count, and of those about that count a share by hash.

    Counts fall into 64 steps a doubling, so the threshold comes from a few
    thousand sums and no task hands over more than its share.
    """
    step = F.floor(F.log2("c") * 64).cast("int")
    sizes = {r["step"]: r["n"] for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, total, share = max(sizes, default=0) + 1, 0, 0
    for s in sorted(sizes, reverse=True):
        if total + sizes[s] > most:
            share = int((most - total) / sizes[s] * (1 << 16) * 0.95)
            break
        total += sizes[s]
        least = s
    return counts.where((step >= least) | ((step == max((s for s in sizes if s < least), default=-1)) & (F.pmod("h", F.lit(1 << 16)) < share)))


class Lexicon:
    """What a task needs to read texts: head counts and the words with classes of their own."""

    def __init__(self, h: np.ndarray, c: np.ndarray, ends: int):
        order = np.argsort(h)
        self.h, self.c, self.ends = h[order], c[order], ends
        rank = np.lexsort((h, -c))[:OWN]
        self.own = {int(x): k for k, x in enumerate(h[rank])}
        self.own_counts = c[rank]

    @property
    def classes(self) -> int:
        return OWN + SUFFIXES + 1


def _encode_rows(lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        lex = Lexicon(*lexicon.value)
        next_id = TaskContext.get().partitionId() << 40
        known: dict[bytes, int] = {}
        hashes, counts, classes = np.zeros(0, "<i8"), np.zeros(0, "int64"), np.zeros(0, "<i2")
        end = lex.classes - 1
        for batch in batches:
            if len(known) > CACHED:
                known, hashes, counts, classes = {}, hashes[:0], counts[:0], classes[:0]
            out = {k: [] for k in ("rid", "n", "sum", "known", "classes", "tail", "times")}
            texts = batch.column(2).to_pylist()
            for first in range(0, len(texts), 256):
                split = [t.lower().split() for t in texts[first : first + 256]]
                new = [w for w in dict.fromkeys(w for words in split for w in words) if w not in known]
                if new:
                    h = np.array([xxhash.xxh64_intdigest(w) for w in new], dtype="<u8").view("<i8")
                    at = np.minimum(np.searchsorted(lex.h, h), max(len(lex.h) - 1, 0))
                    c = np.where(lex.h[at] == h, lex.c[at], -1) if len(lex.h) else np.full(len(h), -1)
                    g = [lex.own[x] if x in lex.own else OWN + suffix_class(w) for x, w in zip(h.tolist(), new)]
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                    hashes, counts, classes = np.concatenate([hashes, h]), np.concatenate([counts, c]), np.concatenate([classes, np.array(g, "<i2")])
                for words in split:
                    i = np.array([known[w] for w in words], dtype="int64")
                    c = counts[i]
                    tail, times = np.unique(hashes[i[c < 0]], return_counts=True)
                    out["rid"].append(next_id)
                    next_id += 1
                    out["n"].append(len(words) + 1)
                    out["sum"].append(float(np.log10(c[c >= 0] + 1.0).sum() + np.log10(lex.ends + 1.0)))
                    out["known"].append(int((c >= 0).sum()) + (lex.ends > 0))
                    out["classes"].append(np.append(classes[i], np.int16(end)).astype("<i2").tobytes())
                    out["tail"].append(tail)
                    out["times"].append(times)
            n = pa.array(np.cumsum([0, *map(len, out["tail"])]), pa.int32())
            tail, times = (np.concatenate(out[k]) if out[k] else np.zeros(0) for k in ("tail", "times"))
            arrays = [pa.array(out["rid"], pa.int64()), batch.column(0), batch.column(1), pa.array(out["n"], pa.int64()), pa.array(out["sum"], pa.float64()), pa.array(out["known"], pa.int64()), pa.array(out["classes"], pa.binary())]
            arrays += [pa.ListArray.from_arrays(n, pa.array(tail.astype("<i8"))), pa.ListArray.from_arrays(n, pa.array(times.astype("int32")))]
            yield pa.RecordBatch.from_arrays(arrays, names=["rid", "doc_id", "held_out", "n_tokens", "head_sum", "head_known", "classes", "tail", "times"])

    return rows


def encoded(rows: DataFrame, lexicon) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, held_out boolean, n_tokens long, head_sum double, head_known long, classes binary, tail array<long>, times array<int>"
    return rows.select("doc_id", "held_out", "text").mapInArrow(_encode_rows(lexicon), schema)


class Model:
    """``start`` (K), ``move`` (K x K) and ``emit`` (C x K): P(class|state)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def initial(frequency: np.ndarray, states: int, seed: int = 5) -> Model:
        """States that stay mostly put and prefer classes at random."""
        noise = np.exp(np.random.default_rng(seed).normal(0, 1.0, (len(frequency), states)))
        emit = frequency[:, None] * noise
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    def products(self, stretches: np.ndarray, length: np.ndarray, opening: np.ndarray) -> np.ndarray:
        """Per stretch (longest first) the product of its transitions and emissions, scaled: from the state before it to that at its end."""
        k, n = len(self.start), len(stretches)
        at, emission, onward = np.ascontiguousarray(stretches.T), np.ascontiguousarray(self.emit.T, dtype="f4"), self.move.T.astype("f4")
        first = np.where(opening[None, None, :], self.start[:, None, None], self.move.T[:, :, None]).astype("f4")  # to, from, stretch
        out, p = np.empty((k, k, n), "f4"), first * emission.take(at[0], axis=1)[:, None, :]
        for t in range(1, int(length.max())):
            m = int(np.searchsorted(-length, -t, side="left"))
            if m < p.shape[2]:
                out[:, :, m : p.shape[2]] = p[:, :, m:]
                p = np.ascontiguousarray(p[:, :, :m])
            p = (onward @ p.reshape(k, -1)).reshape(p.shape) * emission.take(at[t, :m], axis=1)[:, None, :]
            p /= p.sum(axis=(0, 1))
        out[:, :, : p.shape[2]] = p
        return out

    def borders(self, stretches: np.ndarray, length: np.ndarray, text: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What enters each stretch from the left (state chances) and from the right (backward messages, up to scale)."""
        k, n = len(self.start), len(stretches)
        before, after = np.full((k, n), 1 / k, "f4"), np.ones((k, n), "f4")
        parts = np.bincount(text)
        several = np.flatnonzero(parts[text] > 1)
        if not len(several):
            return before, after
        product = self.products(stretches[several], length[several], nth[several] == 0)
        place = {}  # stretch number within its text: the stretches, by text
        slot = np.full((len(parts), int(nth.max()) + 1), -1)
        slot[text[several], nth[several]] = np.arange(len(several))
        for j in range(1, slot.shape[1]):
            to = slot[:, j][slot[:, j] >= 0]
            place[j] = (slot[:, j - 1][slot[:, j] >= 0], to)
        for j in sorted(place):
            left, right = place[j]
            moved = np.einsum("jin,in->jn", product[:, :, left], before[:, several[left]])
            before[:, several[right]] = moved / moved.sum(axis=0)
        for j in sorted(place, reverse=True):
            left, right = place[j]
            moved = np.einsum("jin,jn->in", product[:, :, right], after[:, several[right]])
            after[:, several[left]] = moved / moved.sum(axis=0)
        return before, after

    def expected(self, stretches: np.ndarray, length: np.ndarray, text: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, ...]:
        """Baum-Welch counts and log10 likelihood of texts cut into ``stretches`` (padded rows of classes, longest first; ``nth`` of their ``text``)."""
        n, t_max, k = len(stretches), int(length.max()), len(self.start)
        before, after = self.borders(stretches, length, text, nth)
        opening = nth == 0
        alive = np.searchsorted(-length, -np.arange(t_max), side="left")  # rows longer than t
        at = np.ascontiguousarray(stretches.T)  # a step's classes side by side
        # States as rows; single precision is ample for counts that are scaled at each step.
        emission, onward = np.ascontiguousarray(self.emit.T, dtype="f4"), self.move.astype("f4")
        alpha, scaled = np.zeros((t_max, k, n), "f4"), np.zeros((t_max, k, n), "f4")  # scaled: emissions over the step's scale
        a, likelihood = None, 0.0
        for t in range(t_max):
            m = alive[t]
            e = emission.take(at[t, :m], axis=1)
            a = (np.where(opening, self.start[:, None].astype("f4"), onward.T @ before) if t == 0 else onward.T @ a[:, :m]) * e
            s = 1 / a.sum(axis=0)
            likelihood -= float(np.log10(s).sum(dtype="f8"))
            a *= s
            e *= s
            alpha[t, :, :m], scaled[t, :, :m] = a, e
        ends = alpha[length - 1, :, np.arange(n)].T
        beta = after / (ends * after).sum(axis=0)
        move = np.zeros((k, k))
        for t in range(t_max - 1, 0, -1):
            m = alive[t]
            back = scaled[t, :, :m] * beta[:, :m]
            move += alpha[t - 1, :, :m] @ back.T
            alpha[t, :, :m] *= beta[:, :m]  # the chance of each state at t
            beta[:, :m] = onward @ back
        move += (before * ~opening) @ (scaled[0] * beta).T  # over the borders
        alpha[0] *= beta
        flat = at[:t_max].ravel()
        emit = np.stack([np.bincount(flat, weights=alpha[:, j].ravel(), minlength=len(self.emit)) for j in range(k)], axis=1)
        start = alpha[0][:, opening].sum(axis=1, dtype="f8")
        return start, move * self.move, emit, np.array([likelihood, length.sum()])

    @staticmethod
    def reestimated(start: np.ndarray, move: np.ndarray, emit: np.ndarray, frequency: np.ndarray) -> Model:
        emit = emit + SMOOTH * frequency[:, None]
        return Model((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def log10_likelihood(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact: the scaled forward recursion, all sequences side by side."""
        length = np.array([len(s) for s in sequences])
        order = np.argsort(-length, kind="stable")
        flat, at = np.concatenate([sequences[i] for i in order]), np.concatenate([[0], np.cumsum(length[order])[:-1]])
        alive = np.searchsorted(-length[order], -np.arange(length.max()), side="left")
        total, a = np.zeros(len(order)), None
        emission, onward = np.ascontiguousarray(self.emit.T), np.ascontiguousarray(self.move.T)
        for t in range(int(length.max())):
            m = alive[t]
            e = emission.take(flat[at[:m] + t], axis=1)
            a = (self.start[:, None] if t == 0 else onward @ a[:, :m]) * e
            s = a.sum(axis=0)
            a /= s
            total[:m] += np.log10(s)
        out = np.zeros(len(order))
        out[order] = total
        return out


def _stretches(blobs: list[bytes], most: int | None = None) -> tuple[np.ndarray, ...]:
    """Rows of classes, their lengths, texts and places in them, longest first."""
    most = most or STRETCH
    rows, text, nth = [], [], []
    for k, blob in enumerate(blobs):
        c = np.frombuffer(blob, dtype="<i2")
        for i in range(0, len(c), most):
            rows.append(c[i : i + most])
            text.append(k)
            nth.append(i // most)
    length = np.array([len(r) for r in rows])
    order = np.argsort(-length, kind="stable")
    padded = np.zeros((len(rows), most), dtype="int64")
    for k, i in enumerate(order):
        padded[k, : length[i]] = rows[i]
    return padded, length[order], np.array(text)[order], np.array(nth)[order]


def _step_rows(model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, total, held, size = Model(*model.value), None, [], 0

        def add() -> None:
            nonlocal total
            part = np.concatenate([x.ravel() for x in m.expected(*_stretches(held))])
            total = part if total is None else total + part

        for batch in batches:
            for blob in batch.column(0).to_pylist():
                held.append(blob)
                size += len(blob)
                if size > 400_000:
                    add()
                    held, size = [], 0
        if held:
            add()
        if total is not None:
            i = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype("int32")), pa.array(total[i])], names=["i", "v"])

    return rows


def train(sequences: DataFrame, frequency: np.ndarray, states: int = STATES, steps: int = STEPS, gain: float = GAIN) -> Model:
    """Baum-Welch over all ``sequences.classes``, until a step lifts the likelihood by less than ``gain`` a token."""
    sc = sequences.sparkSession.sparkContext
    model = Model.initial(frequency, states)
    k, c, last = states, len(frequency), -np.inf
    for _ in range(steps):
        given = sc.broadcast((model.start, model.move, model.emit))
        sums = sequences.select("classes").mapInArrow(_step_rows(given), "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        got = sums.toPandas()  # at most a row per number of the model
        total = np.zeros(k + k * k + c * k + 2)
        total[got["i"].to_numpy(dtype="int64")] = got["v"].to_numpy()
        model = Model.reestimated(total[:k], total[k : k + k * k].reshape(k, k), total[k + k * k : -2].reshape(c, k), frequency)
        given.unpersist()
        level = total[-2] / max(total[-1], 1)
        if level - last < gain:
            break
        last = level
    return model


def _score_rows(model, weight):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, w = Model(*model.value), weight.value
        for batch in batches:
            blobs = batch.column(6).to_pylist()
            parts = []
            for i in range(0, len(blobs), 4096):
                sequences = [np.frombuffer(b, dtype="<i2").astype("int64") for b in blobs[i : i + 4096]]
                parts.append(m.log10_likelihood(sequences) - np.array([w[s].sum() for s in sequences]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(np.concatenate(parts) if parts else [], pa.float64())], names=[*batch.schema.names[:6], "state_part"])

    return rows


class Fitted:
    """What is learned from the training rows of ``doc_id, held_out, text``, and the encoded rows."""

    def __init__(self, rows: DataFrame, states: int = STATES, steps: int = STEPS):
        sc = rows.sparkSession.sparkContext
        self.counts = counts = cut(word_counts(rows.where(~F.col("held_out"))), "counts")
        ends = rows.where(~F.col("held_out")).count()
        by_suffix = counts.groupBy("suffix").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # SUFFIXES rows
        head = most_frequent(counts, HEAD).toPandas()  # HEAD rows or so, whatever the input
        self.lexicon = lex = Lexicon(head["h"].to_numpy(dtype="int64"), head["c"].to_numpy(dtype="int64"), ends)
        self.n_total = int(sum(r["n"] for r in by_suffix) + ends)
        self.v_total = int(sum(r["v"] for r in by_suffix) + (ends > 0))
        # Words and different words of each class; those with classes of their own leave their suffix class.
        words, kinds = np.zeros(lex.classes), np.zeros(lex.classes)
        for r in by_suffix:
            words[OWN + r["suffix"]], kinds[OWN + r["suffix"]] = r["n"], r["v"]
        own_suffix = {int(h): int(s) for h, s in zip(head["h"], head["suffix"]) if int(h) in lex.own}
        for h, k in lex.own.items():
            words[k] = lex.own_counts[k]
            words[OWN + own_suffix[h]] -= words[k]
            kinds[OWN + own_suffix[h]] -= 1
        words[-1] = ends
        self.weight = np.log10(words + kinds + 1)  # P(word|class) = (c + 1) / 10^weight
        self.texts = cut(encoded(rows, sc.broadcast((lex.h, lex.c, lex.ends))), "encoded")
        self.model = train(self.texts.where(~F.col("held_out")), (words + 1) / (words + 1).sum(), states, steps)


def hmm_scores(docs: DataFrame, held_out=None, states: int = STATES, steps: int = STEPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; ``held_out`` a condition on the id."""
    sc = docs.sparkSession.sparkContext
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD_OUT
    rows = prefixed(docs, doc_id=F.col(id_col), held_out=held_out, text=text_of(text_col).cast("binary"))
    fitted = Fitted(rows, states, steps)
    model, texts = fitted.model, fitted.texts
    small = texts.select("rid", "doc_id", "held_out", "n_tokens", "head_sum", "head_known", "classes")
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = small.mapInArrow(_score_rows(sc.broadcast((model.start, model.move, model.emit)), sc.broadcast(fitted.weight)), f"rid long, doc_id {kind}, held_out boolean, n_tokens long, head_sum double, head_known long, state_part double")
    pair = texts.select("rid", F.explode(F.arrays_zip("tail", "times")).alias("p")).select("rid", F.col("p.tail").alias("h"), F.col("p.times").alias("times"))
    tail = pair.join(fitted.counts.select("h", "c"), "h").groupBy("rid").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("tail_sum"), F.sum("times").alias("tail_known"))
    out = scored.join(tail, "rid", "left")
    logs = F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"), F.lit(fitted.n_total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(fitted.n_total + fitted.v_total + 1))).alias("base_score"), (logs + F.col("state_part")).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(read(spark, sf_dir))
