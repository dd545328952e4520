"""The training-data operators against SQL, brute force and edge cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quadloom.llm import catalog, exact_dedup, hmm_lm, licenses, line_dedup, mixing, packing, phrases, quality, secret_scan, simhash
from quadloom.llm.common import cut, drop_tables

SPACE = " \t\n\x0b\x0c\r"
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "", r.source) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties and clashing extra columns."""
    long_ = " ".join(f"word{i % 977}" for i in range(60_000))
    line = "The same line for all"
    rows = [(1, None, "a"), (2, "", None), (3, " \t\r\n", "a"), (4, long_, None), (4, long_, None), (None, "orphan text with a few words", "b"), (5, None, None)]
    rows += [(i, f"{line}\nown line {i} é İ ﬁ \U0001f600 <|endoftext|> it's 12 x", "c") for i in range(10, 24)]
    rows += [(30, "Tie tie", "d"), (31, "tie Tie", "d"), (32, "T ie tie", "d")]
    names = ["h1", "key", "text_h", "rid", "carry", "shard", "fp", "size", "keep", "pos", "n_words", "label"]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    return cut(df.withColumns({n: F.lit("extra") for n in names}), "odd")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(name, agrees):
    agrees(QUERIES[name], catalog.oracle_sql()[name])


RUNS = {
    "line_dedup": line_dedup.line_dedup, "secret_scan": secret_scan.secret_scan, "packing": packing.pack_documents, "mixing": mixing.mix, "hmm_lm": lambda d: hmm_lm.hmm_scores(d, steps=1, states=2),
    "simhash": simhash.simhash_groups, "phrases": phrases.substring_dedup, "quality": quality.judge, "exact_dedup": exact_dedup.exact_dedup, "licenses": licenses.license_scan,
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_odd_rows_are_all_answered(name, odd):
    got = RUNS[name](odd)
    n = got.where("piece = 0").count() if name == "packing" else got.count()
    assert n == odd.count()


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_table(name, odd):
    assert RUNS[name](odd.limit(0)).count() == 0


def test_line_dedup_on_odd_rows(odd):
    got = {r.doc_id: r for r in line_dedup.line_dedup(odd).collect()}
    assert (got[1].n_lines, got[1].n_dropped, got[1].kept) == (1, 0, "")
    assert got[10].n_dropped == 1 and got[10].kept.startswith("own line 10")
    first = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(odd, keep_first=True).collect()}
    assert first[10] == 0 and first[11] == 1


def test_keep_bitmaps_are_sparse(spark):
    text = "\n".join(f"own {i}" for i in range(200)) + "\nshared"
    df = spark.createDataFrame([(i, text.replace("own", f"own{i}")) for i in range(10)], "doc_id long, text string")
    keep = line_dedup.keep_bitmaps(df).first().keep
    assert [(w.word, w.bits & (1 << 64) - 1) for w in keep] == [(3, (1 << 64) - 1 ^ 1 << 8)]


def test_exact_dedup_on_odd_rows(odd):
    got = exact_dedup.exact_dedup(odd).collect()
    empty = [r for r in got if r.doc_id in (1, 2, 3, 5)]
    assert {r.keep_id for r in empty} == {3} and {r.group_size for r in empty} == {4}
    assert [(r.keep_id, r.group_size, r.kept) for r in got if r.doc_id == 4] == [(4, 2, True)] * 2
    assert [(r.keep_id, r.kept) for r in got if r.doc_id == 32] == [(32, True)]
    assert [(r.keep_id, r.group_size) for r in got if r.doc_id == 30] == [(32, 2)]  # the longer original
    assert [(r.keep_id, r.group_size) for r in got if r.doc_id == 31] == [(31, 1)]


def test_small_chunks_give_the_same_groups(odd):
    a, b = exact_dedup.exact_dedup(odd), exact_dedup.exact_dedup(odd, least=2, most=5)
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_boundaries_follow_the_content_in_any_script(spark):
    rng = np.random.default_rng(5)
    for low, high in [(0x61, 0x7B), (0x41, 0x5B), (0x410, 0x450), (0x4E00, 0x9FA5), (0x3B1, 0x3CA), (0x1F600, 0x1F640)]:
        shared = "".join(map(chr, rng.integers(low, high, 30_000)))
        df = spark.createDataFrame([(1, "0" * 700 + shared), (2, "1" * 3333 + shared)], "doc_id long, text string")
        a, b = ({c.h for c in r.chunks} for r in exact_dedup.chunked(df).orderBy("doc_id").collect())
        assert len(a & b) > 0.5 * len(a) and 10 < len(a) < 400


def base_spans(text):
    found = []
    for m in re.finditer(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def spans_text(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_secret_scan_equals_brute_force(spark, docs):
    texts = {i: t for i, t, _ in docs}
    for r in QUERIES["op2_secret_scan"](spark, SMALL).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spans_text(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
        assert set(spans_text(want).split(",")) <= set(r.spans.split(","))


def test_secret_positions_and_consumed_matches(spark):
    cases = ["é😀 token=token:abcdefgh", "TOKEN : 'a.b/c=+-_'x PassWD=12345 api_key:\"123456", "AKIA" + "AKIA" * 4 + "é" + "f" * 24 + "g" + "0" * 23, "ſecret=abcdefg toKen=abcdef", "x" * 300 + (" token=" + "9" * 30) * 700]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in secret_scan.secret_scan(df).collect():
        assert [(s.start, s.kind, s.end) for s in r.base] == base_spans(cases[r.doc_id])


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = np.random.default_rng(1)
    random = ["".join(rng.choice(list("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), 40)) for _ in range(200)]
    plain = ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "abababababababababababababababababababa1", "Version10000000000000000000000000000000A"] * 20
    df = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(random + plain)], "doc_id long, text string")
    hit = {r.doc_id for r in secret_scan.secret_scan(df).collect() if any(s.kind == 3 for s in r.spans)}
    assert len(hit & set(range(200))) > 180 and not hit - set(range(200))


def _histogram(spark, rows):
    """Thresholds of rows ``(stratum, token, p, copies)``."""
    df = spark.createDataFrame(rows, "stratum int, token long, p double, copies int")
    one = F.struct(F.lit(0).cast("long").alias("start"), F.lit(1).cast("long").alias("end"), "stratum", "p", "token")
    return secret_scan.thresholds(df.select(F.array_repeat(one, F.col("copies")).alias("candidates")))


def test_copies_of_a_token_do_not_move_the_threshold(spark):
    even = [(3, i, (i + 0.5) / 500, 1) for i in range(500)]
    structured = [(3, 1000 + i, 0.0005, 1) for i in range(1000)]
    assert _histogram(spark, even) == _histogram(spark, [*even, (3, 900, 0.4, 1000)]) == {3: 0.0}
    plain = _histogram(spark, [*even, *structured])
    assert plain == _histogram(spark, [*even, *structured, (3, 900, 0.92, 1000)]) and plain[3] > 0


def test_few_tokens_are_pooled_or_held_against_a_fixed_value(spark):
    assert _histogram(spark, [(3, 1, 0.3, 1), (4, 2, 0.6, 1)]) == {3: secret_scan.FEW_P, 4: secret_scan.FEW_P}
    band = len(secret_scan.BANDS) + 1
    pooled = [(3 + band * (i % 8), i, (i + 0.5) / 240, 1) for i in range(240)]
    assert _histogram(spark, [*pooled, (4, 1, 0.3, 1)]) == {3 + band * k: 0.0 for k in range(8)} | {4: secret_scan.FEW_P}


def test_a_copied_secret_is_found_with_all_its_copies(spark):
    rng = np.random.default_rng(5)
    random = ["".join(rng.choice(list("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), 40)) for _ in range(100)]
    p = {r.i: r.p for r in spark.createDataFrame(list(enumerate(random)), "i int, t string").select("i", F.explode(secret_scan.candidates(F.col("t"))).alias("c")).select("i", "c.p").collect()}
    copied = random[next(i for i in p if 0.35 < p[i] < 0.45)]
    df = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(random + [copied] * 1000)], "doc_id long, text string")
    hit = {r.doc_id for r in secret_scan.secret_scan(df).collect() if any(s.kind == 3 for s in r.spans)}
    assert hit >= set(range(100, 1100)) and len(hit & set(range(100))) >= 85


def test_prefix_sums_over_blocks(spark):
    n = 3 * secret_scan._BLOCK + 7
    r = spark.range(1).select(secret_scan.prefix_sums(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))).alias("s")).first().s
    assert r == [i * (i + 1) // 2 for i in range(n)]


def tokens(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    if not hasattr(tokens, "t"):
        tokens.t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return np.array(tokens.t.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")


def check_packing(rows, texts):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        ids, at = tokens(t), 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.length == min(2048, len(ids) - at)
            at += r.length
        assert at == len(ids)
    for rs in by_seq.values():
        end = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 2048
    return len(by_seq)


def test_packing_round_trip(spark, docs):
    rows = QUERIES["op3_best_fit_packing"](spark, SMALL).collect()
    n = check_packing(rows, {i: t for i, t, _ in docs})
    bound = max(-(-sum(r.length for r in rows) // 2048), sum(r.length > 1024 for r in rows))
    assert n <= bound + 1


def test_packing_of_odd_words(spark):
    texts = {0: "İstanbul ΑΣ. naïve, été ﬁ q̣̇ <|endoftext|> x<|y don't. we'll! 3.14, A.B. Ω   \x1c end", 1: "A" * 5000, 2: "..., !!! a1! é. ß? 漢字。 क़", 3: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_packing(packing.pack_documents(df).collect(), texts)


def best_fit_decreasing(sizes, length):
    rooms = []
    for n in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else length) - n)
    return len(rooms)


def test_local_search_makes_the_packing():
    search = packing.LocalSearch([6, 4, 6, 4, 5, 5], [[0], [1], [2], [3], [4], [5]], 10)
    assert len(search.run()) == 3 and search.emptied == 3
    # One for one and one for two are needed: no move fits anywhere.
    search = packing.LocalSearch([7, 2, 6, 3, 1], [[0, 1], [2, 3], [4]], 10)
    assert len(search.run()) == 2 and search.steps["move"] > 0
    rng = np.random.default_rng(0)
    kinds = collections.Counter()
    for low, high in [(1, 2048), (1, 40), (500, 1100), (600, 800)]:
        sizes = rng.integers(low, high, 600).tolist()
        start = packing.dealt(sizes, 2048)
        search = packing.LocalSearch(sizes, start, 2048)
        squares = sum(n * n for n in search.fill)
        out = search.run()
        kinds.update(search.steps)
        assert sorted(i for b in out for i in b) == list(range(600)) and all(sum(sizes[i] for i in b) <= 2048 for b in out)
        assert (sum(n * n for n in search.fill) > squares) == (sum(search.steps.values()) > 0) and len(start) - search.emptied == len(out) <= best_fit_decreasing(sizes, 2048)
    assert kinds["move"] and kinds["one for one"]


def test_word_ids_equal_the_tokenizer():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, coder, draw = Tokenizer.from_file(path), packing.WordCoder(path), random.Random(3)
    fixed = ["GELD\u0130.", "GELD\u0130, G\u0130TT\u0130", "\u092c\u093e\u0915\u093c.", "\u0915\u093c, \u091c\u093c.", "\u05d9\u05b4.", "H\u0331. T\u0308; W\u030a", "\u00df. \u03a3.", "a\u0085b\u001c."]
    # Letters of many scripts, marks that compose with them, white space of all kinds, punctuation, tokens.
    pools = ["abcXYZ", "\u00e9\u00c9\u00df\u0130\u0131\u03a3\u03c3\u03c2\u0153", "\u0915\u093c\u092c\u093e\u0958\u095f\u094d", "\u05d9\u05b4\ufb1d\u05d0", "\u0331\u0301\u0307\u0308\u030a\u030c\u0345", "HTWYJhtwyjIiK\u212b", "12\u00b2\u0663"]
    pools += ["\u4e2d\u6587\u30ab\u309b\uac01\u1100\u1161", "\u0149\u01f0\u0390\u03b0\u1e96\ufb01", "\U0001f600\u200d\u00ad\x01", ["'s", "'ll", "<|endoftext|>", "n't", "'S"], "\u0401\u0451\u0419\u0439", "\u0386\u037a\u0374\u0384", "\u0139\u0140"]
    always = [" \t\n\r\x0b\x0c\u00a0\u2028\u3000", ".,;:!?\u2026'-<|>"]
    texts = fixed + ["".join(draw.choice(draw.choice(pool)) for _ in range(draw.randint(1, 14))) for pool in (draw.sample(pools, draw.randint(1, 4)) + always for _ in range(20_000))]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode([t.encode() for t in texts])]
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_only_new_letters_meet_the_tokenizer(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, coder = Tokenizer.from_file(path), packing.WordCoder(path)
    list(coder.encode([b"stone wall"]))
    monkeypatch.setattr(coder, "_joined", None)
    texts = ["Stone, WALL!! stone$$$ Wall###.", "wall' stone*** STONE"]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode([t.encode() for t in texts])]
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_special_tokens_keep_their_case():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, coder = Tokenizer.from_file(path), packing.WordCoder(path)
    texts = ["A<|ENDOFTEXT|>B", "Stone <|EndOfText|>", "wall<|endoftext|> STONE"]
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode([t.encode() for t in texts])]
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_shards_share_their_last_sequences(spark, docs):
    texts = {i: t for i, t, _ in docs}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert check_packing(packing.pack_documents(df, shard=64).collect(), texts) <= check_packing(packing.pack_documents(df).collect(), texts) + 2


def water_fill(sizes, weights=(3, 1, 2)):
    """Targets by source, one resharing after the other."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, rest = {}, 1.5 * sum(sizes.values())
    while names:
        total = sum(weight[s] for s in names)
        over = [s for s in names if rest * weight[s] / total > 2 * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / total for s in names}
        out |= {s: 2 * sizes[s] for s in over}
        rest -= sum(2 * sizes[s] for s in over)
        names = [s for s in names if s not in over]
    return out


def histogram(spark, sizes):
    rows = [(None if s is None else s, n, 1) for s, n in sizes.items()]
    df = spark.createDataFrame(rows, "source string, size long, n long")
    return df.withColumn("key", mixing.source_key(F.col("source")))


def test_targets_reshare_what_is_capped(spark):
    rng = np.random.default_rng(1)
    many = {f"host{k}.{c}": int(n) for k, (c, n) in enumerate(zip("aZé漢\U0001f600" * 60, rng.lognormal(6, 3, 300)))}
    for sizes in ({"a": 10, "b": 1000, "c": 1000, None: 90}, {"a": 0, "b": 0}, many | {None: 7, "": 3}):
        got = {r.source: r.target for r in mixing.targets(mixing.sources(histogram(spark, sizes).repartition(5))).collect()}
        want = water_fill(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)
    assert mixing.targets(mixing.sources(histogram(spark, {"a": 1}).limit(0))).count() == 0


def test_dual_equals_a_reference_solver(spark):
    """By bisection, and no feasible rates come closer to the base rate than the solved ones."""
    rng = np.random.default_rng(3)
    size, want = rng.integers(1, 400, 60), 1.5
    rows = [("s", int(n), 1) for n in size]
    hist = cut(spark.createDataFrame(rows, "source string, size long, n long").withColumn("key", mixing.source_key(F.col("source"))).groupBy("key", "source", "size").agg(F.sum("n").alias("n")), "h")
    total, mean = int(size.sum()), size.mean()
    for share in (0.4, 1.9):
        table = mixing.sources(hist).withColumn("target", F.lit(share * total))
        dual = mixing.solve_dual(hist, table, want, 2.0).first().dual
        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if (np.minimum(2, want * np.exp(mid * size / mean)) * size).sum() < share * total else (low, mid)
        assert abs(dual - low) < 1e-4 * max(1, abs(low))
        rate = np.minimum(2, want * np.exp(dual * size / mean))
        entropy = lambda r: (r * np.log(r / want) - r + want).sum()
        for _ in range(50):
            i, j = rng.choice(60, 2, replace=False)
            other, d = rate.copy(), 1e-3 * rng.random()
            other[i] += d / size[i]
            other[j] -= d / size[j]
            if other.max() <= 2:
                assert entropy(other) >= entropy(rate) - 1e-9
    with pytest.raises(RuntimeError):
        mixing.solve_dual(hist, mixing.sources(hist).withColumn("target", F.lit(1.9 * total)), want, 2.0, most=2)


def test_mixing_meets_targets_and_reruns_agree(spark, docs):
    got = QUERIES["op4_source_mixing"](spark, SMALL).collect()
    source = {i: s for i, _, s in docs}
    size = {i: len(t.encode().split()) for i, t, _ in docs}
    by, most = collections.Counter(), collections.Counter()
    for i, n in size.items():
        by[source[i]] += n
        most[source[i]] = max(most[source[i]], n)
    want, taken = water_fill(by), collections.Counter()
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == by[source[r.doc_id]] and r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= max(0.01 * want[s], 0.15 * most[s]) for s in by)
    again = QUERIES["op4_source_mixing"](spark, SMALL).repartition(7).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_rates_are_tilted_exponentially(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 40), "a" if i < 900 else "b") for i in range(1000)], "doc_id long, text string, source string")
    rows = [r for r in mixing.mix(df).collect() if 0 < r.rate < 1.999]
    assert rows
    for s in {r.source_size for r in rows}:
        x = np.array([(r.size, math.log(r.rate)) for r in rows if r.source_size == s])
        assert np.abs(np.polyval(np.polyfit(x[:, 0], x[:, 1], 1), x[:, 0]) - x[:, 1]).max() < 1e-3


def test_hmm_base_scores_and_held_out_gain(spark, docs):
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    words = {i: t.encode().lower().split() + [b""] for i, t, _ in docs}
    c = collections.Counter(w for i, ws in words.items() if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    gain = []
    for r in QUERIES["op5_hmm_lm"](spark, SMALL).collect():
        ws = words[r.doc_id]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        gain.append((r.held_out, r.score - r.base_score, len(ws)))
    assert sum(g for h, g, _ in gain if h) / sum(k for h, _, k in gain if h) > 0.05


def test_hmm_tail_words_meet_their_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(hmm_lm, "HEAD", 600)
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    few = {r.doc_id: r for r in hmm_lm.hmm_scores(df, steps=1).collect()}
    monkeypatch.undo()
    for r in hmm_lm.hmm_scores(df, steps=1).collect():
        assert r.n_known == few[r.doc_id].n_known and abs(r.base_score - few[r.doc_id].base_score) < 1e-6 * abs(r.base_score)
        assert abs(r.score - few[r.doc_id].score) < 1e-6 * abs(r.score)


def brute_forward(m, seq):
    total, a = 0.0, m.start * m.emit[seq[0]]
    for c in seq[1:]:
        total += math.log10(a.sum())
        a = (a / a.sum()) @ m.move * m.emit[c]
    return total + math.log10(a.sum())


def test_forward_and_baum_welch():
    rng = np.random.default_rng(2)
    f = rng.random(12)
    m = hmm_lm.Model.initial(f / f.sum(), 3)
    seqs = [rng.integers(0, 12, n) for n in (1, 9, 4, 30)]
    assert np.allclose(m.log10_likelihood(seqs), [brute_forward(m, s) for s in seqs])
    blobs = [s.astype("<i2").tobytes() for s in seqs]
    start, move, emit, level = m.expected(*hmm_lm._stretches(blobs))
    assert np.isclose(start.sum(), 4, rtol=1e-4) and np.isclose(emit.sum(), 44, rtol=1e-4) and np.isclose(move.sum(), 40, rtol=1e-4)
    assert np.allclose(emit.sum(axis=1), np.bincount(np.concatenate(seqs), minlength=12), rtol=1e-4)
    assert np.allclose(level, [sum(brute_forward(m, s) for s in seqs), 44], rtol=1e-5)
    plain = hmm_lm.Model((start + 1e-9) / (start + 1e-9).sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    assert plain.log10_likelihood(seqs).sum() > m.log10_likelihood(seqs).sum()


def brute_counts(m, seq):
    """Expected counts of one whole text, forward and backward, without scaling tricks."""
    k, n = len(m.start), len(seq)
    alpha, beta = np.zeros((n, k)), np.ones((n, k))
    alpha[0] = m.start * m.emit[seq[0]]
    for t in range(1, n):
        alpha[t] = alpha[t - 1] @ m.move * m.emit[seq[t]]
    for t in range(n - 2, -1, -1):
        beta[t] = m.move @ (m.emit[seq[t + 1]] * beta[t + 1])
    p = alpha[-1].sum()
    gamma, move, emit = alpha * beta / p, np.zeros((k, k)), np.zeros_like(m.emit)
    for t in range(n):
        emit[seq[t]] += gamma[t]
        if t:
            move += np.outer(alpha[t - 1], m.emit[seq[t]] * beta[t]) * m.move / p
    return gamma[0], move, emit


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_expected_counts_are_those_of_whole_texts(stretch):
    rng = np.random.default_rng(8)
    f = rng.random(9)
    m = hmm_lm.Model.initial(f / f.sum(), 4)
    m.start = rng.dirichlet(np.ones(4))
    seqs = [rng.integers(0, 9, n) for n in (1, 3, 7, 64, 65, 100, 12)]
    got = m.expected(*hmm_lm._stretches([s.astype("<i2").tobytes() for s in seqs], stretch))
    for x, parts in zip(got, zip(*[brute_counts(m, s) for s in seqs])):
        assert np.allclose(x, sum(parts), rtol=1e-3, atol=1e-4)
    assert np.allclose(got[3][0], sum(brute_forward(m, s) for s in seqs), rtol=1e-5)


def test_hmm_score_equals_brute_force(spark, docs):
    import xxhash

    df = spark.createDataFrame([(i, t) for i, t, _ in docs[:120]], "doc_id long, text string")
    rows = df.select("doc_id", F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text"))
    fitted = hmm_lm.Fitted(rows, states=3, steps=2)
    words = {i: t.encode().lower().split() for i, t, _ in docs[:120]}
    c = collections.Counter(w for ws in words.values() for w in ws)
    own = sorted(c, key=lambda w: (-c[w], int.from_bytes(xxhash.xxh64_intdigest(w).to_bytes(8, "big"), "big", signed=True)))[: hmm_lm.OWN]
    number = {w: k for k, w in enumerate(own)}
    kind = lambda w: number.get(w, hmm_lm.OWN + hmm_lm.suffix_class(w))
    size, kinds = collections.Counter(), collections.Counter(kind(w) for w in c if w not in number)  # a word of its own has no unknown beside it
    for w, n in c.items():
        size[kind(w)] += n
    for r in hmm_lm.hmm_scores(df, held_out=F.lit(False), states=3, steps=2).collect():
        ws = words[r.doc_id]
        end = fitted.lexicon.classes - 1
        want = brute_forward(fitted.model, [*map(kind, ws), end]) + sum(math.log10((c[w] + 1) / (size[kind(w)] + kinds[kind(w)] + 1)) for w in ws)
        want += math.log10((120 + 1) / (120 + 0 + 1))
        assert abs(r.score - want) < 1e-4 * max(1, abs(want))


def test_ties_do_not_empty_the_head(spark, monkeypatch):
    counts = spark.range(5000).select(F.xxhash64("id").alias("h"), F.lit(1).alias("suffix"), F.when(F.col("id") < 3, 9).otherwise(1).cast("long").alias("c"))
    got = hmm_lm.most_frequent(counts, 1000).toPandas()
    assert 700 < len(got) <= 1000 and (got.c == 9).sum() == 3
    assert hmm_lm.most_frequent(counts, 10_000).count() == 5000 and hmm_lm.most_frequent(counts.limit(0), 10).count() == 0


def components(ids, fps, most=2):
    label = {i: i for i in ids}
    change = True
    while change:
        change = False
        for i in ids:
            for j in ids:
                if bin(fps[i] ^ fps[j]).count("1") <= most and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    change = True
    return label


def test_simhash_equals_brute_force(spark, docs):
    import xxhash

    fps = {}
    for i, t, _ in docs:
        w = t.encode().lower().split()
        s = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    want = components(sorted(fps), fps)
    for r in QUERIES["op6_simhash_near_dedup"](spark, SMALL).collect():
        assert int(r.fingerprint, 16) == fps[r.doc_id] and r.component_id == want[r.doc_id]


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_linked_fingerprints_share_an_anchor(blocks):
    rng = np.random.default_rng(blocks)
    x = rng.integers(0, 1 << 63, 500, dtype="<u8")
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 500).astype("<u8")) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype("<u8"))
    a, b = ({*zip(*(v.tolist() for v in simhash.anchors(p, blocks)))} for p in (x, y))
    assert {r for r, _ in a & b} == set(range(500))


def test_large_anchor_groups_equal_small_ones(monkeypatch):
    rng = np.random.default_rng(4)
    seed = rng.integers(0, 1 << 63, 3, dtype="<u8")
    fp = np.unique(np.concatenate([s ^ (np.uint64(1) << rng.integers(0, 30, 90).astype("<u8")) ^ (np.uint64(1) << rng.integers(0, 30, 90).astype("<u8")) for s in seed]))
    at = np.zeros(len(fp), dtype="int64")
    both = []
    for size in (4, 1 << 20):
        monkeypatch.setattr(simhash, "SMALL_GROUP", size)
        a, b = simhash.linked(at, fp)
        both.append(sorted(zip(a.tolist(), b.tolist())))
    assert both[0] == both[1] and both[0]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (5, 6)]
    got = {r.node: r.label for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_star_steps_settle_few_tables(spark, monkeypatch):
    names, settle = [], simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df, name: (names.append(name), settle(df, name))[1])
    found = lambda edges: {r.node: r.label for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found([(5, 1), (1, 7), (9, -2), (9, -2), (4, 4)]) == {5: 1, 7: 1, 9: -2}
    assert names == ["edges"]  # these are stars already
    names.clear()
    assert found([(4, 4)]) == {} and names == ["edges"]
    rng = np.random.default_rng(3)
    for n in (30, 60):
        edges = [(int(a), int(b)) for a, b in rng.integers(-40, 40, (n, 2))]
        label = {x: x for e in edges for x in e}
        for _ in label:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        names.clear()
        assert found(edges) == {x: y for x, y in label.items() if x != y}
        rounds = names.count("edges") - 1
        assert rounds and names.count("least") == names.count("large") == rounds


def test_near_dedup_goes_by_row(spark):
    a, b = " ".join(f"alpha{i}" for i in range(60)), " ".join(f"beta{i}" for i in range(60))
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (9, a, "x"), (3, a, "x"), (None, b, "x"), (7, None, "x"), (8, "", "x"), (None, "orphan of a kind that no other is", None)]
    out = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    assert out.columns == ["doc_id", "text", "fp"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(3, a, "x"), (5, b, "x"), (7, None, "x"), rows[-1]], key=repr)


def test_anchor_groups_over_many_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "CHUNK_ROWS", 50)
    rng = np.random.default_rng(3)
    anchor = np.sort(rng.integers(0, 12, 900))
    fp = rng.integers(0, 256, 900).astype("<u8")
    table = [pa.RecordBatch.from_arrays([pa.array(anchor[i : i + 37]), pa.array(fp[i : i + 37].view("<i8"))], names=["anchor", "fp"]) for i in range(0, 900, 37)]
    got = [b for b in simhash._link_rows(iter(table))]
    u, v = (np.concatenate([np.asarray(b.column(k)) for b in got]) for k in (0, 1))
    whole = simhash.spanning(*simhash.linked(anchor, fp))
    assert set(zip(*simhash.spanning(u.view("<u8"), v.view("<u8")))) == set(zip(*whole))


def removed(docs, window=13):
    first, out = {}, {}
    for i, t, *_ in sorted(docs, key=lambda d: d[0]):
        w, gone = t.encode().split(), set()
        for k in range(len(w) - window + 1):
            if first.setdefault(tuple(w[k : k + window]), i) < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("rows", [4096, 2])
def test_substring_dedup_equals_brute_force(spark, docs, monkeypatch, rows):
    monkeypatch.setattr(phrases, "SALT_ROWS", rows)
    want = removed(docs)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op7_substring_dedup"](spark, SMALL).collect()} == want
    assert sum(n for _, n, _ in want.values()) > 0


def test_substring_dedup_of_repeats_and_copies(spark):
    a = " ".join(f"w{i}" for i in range(30))
    rows = [(1, a), (2, a), (3, "the " * 50), (4, "the " * 20 + a[:60]), (5, "x " + a), (6, "short text"), (7, "short text"), (8, a + "  "), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = removed([(i, t or "") for i, t in rows])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.substring_dedup(df).collect()} == want


@pytest.mark.parametrize("rows", [4096, 2])
def test_substring_dedup_of_periodic_texts(spark, monkeypatch, rows):
    monkeypatch.setattr(phrases, "SALT_ROWS", rows)
    period = [f"p{i}" for i in range(20)]
    texts = {i: " ".join((period * 400)[i:] + [f"own{i}x{k}" for k in range(40)] + period) for i in range(6)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.substring_dedup(df).collect()}
    assert got == removed(list(texts.items()))
    listed = df.select("text").first().text.encode()
    hashes = phrases.minimizers(phrases.WordHashes()(listed))
    assert len(phrases.runs(hashes)) > 500  # yet a row per different stretch
    with pytest.raises(TypeError):
        phrases.substring_dedup(df.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_quality_filter_keeps_columns_and_clean_documents(spark, odd):
    clean = " ".join(f"Clean{i} sentence{i} says{i} something{i} else{i}." for i in range(30))
    junk = " ".join(f"BUY{i}!! NOW{i}!!" for i in range(60))
    df = spark.createDataFrame([(1, clean, "x"), (2, junk, "x"), (3, "a b " * 40, "x"), (4, None, "x")], "doc_id long, text string, q_text string")
    out = quality.quality_filter(df)
    assert out.columns == df.columns and [r.doc_id for r in out.collect()] == [1]
    assert quality.quality_filter(odd).columns == odd.columns


def test_quality_lines(spark):
    bad = ["Home | About | Contact | Help", "We use cookies: read our Cookie Policy", "WOW!! NO!! YES!!", "https://a.example/b www.c.example d", "One more thing that you will ..."]
    good = ["A fine line.", "See https://a.example for what it says about this.", "### Title", "a < b and b > c", " \t"]
    df = spark.createDataFrame([(1, "\n".join([*bad, *good, ""]))], "doc_id long, text string")
    got = quality.judge(df).first()
    assert got.cleaned == "\n".join([*good, ""]) and got.n_lost_words == sum(len(x.split()) for x in bad)


def repeated(words):
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    return len({i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)})


@pytest.mark.parametrize("bits", [24, 3])
def test_repeated_words_equal_brute_force(spark, docs, monkeypatch, bits):
    monkeypatch.setattr(quality, "POSITIONS", bits)
    rng = np.random.default_rng(2)
    texts = {i: t for i, t, _ in docs[:60]} | {-k: " ".join(rng.choice(list("abcde"), n)) for k, n in enumerate([1, 2, 3, 4, 5, 60, 400], 1)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.n_repeat_words for r in quality.judge(df).collect()} == {i: repeated(t.encode().split()) for i, t in texts.items()}


def test_long_menu_lines_fail_by_their_density(spark):
    menu = " | ".join(f"item{i}" for i in range(60))
    prose = " ".join(f"word{i}" for i in range(60)) + " a | b | c | d"
    df = spark.createDataFrame([(1, menu), (2, prose), (3, menu.replace("|", "›"))], "doc_id long, text string")
    assert not any(r.base_failed for r in quality.judge(df).collect())
    assert [r.doc_id for r in quality.judge(df).where("kept").collect()] == [2]
    assert [r.doc_id for r in quality.quality_filter(df).collect()] == [2]


def test_quality_stage_removes_failed_lines(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    clean = " ".join(f"Clean{i} sentence{i}." for i in range(60))
    rows = [(1, f"Home | About | Contact | Help\n{clean}\n\nWOW!! NO!!", 7), (2, clean, 7)]
    out = corpus_pipeline.quality_rules(spark, spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), SMALL)
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {1: (f"{clean}\n", len(clean) + 1), 2: (clean, len(clean))}


def test_runs_of_symbols_fail_by_the_method(spark):
    junk = " ".join(f"word{i}" + ("###", "$$$", "%%%", "&&&", "***")[i % 5] for i in range(80))
    heads = "\n".join(f"### Title {i}\n" + " ".join(f"word{i}x{k}" for k in range(9)) for i in range(20))
    df = spark.createDataFrame([(1, junk), (2, heads), (3, "a **bold** word & some C# for $5 " + heads)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    assert not any(r.base_failed for r in got.values()) and [i for i in got if got[i].kept] == [2, 3]
    assert got[1].n_lost_words == 80 and got[2].n_lost_words == 0


def test_labelled_junk_is_rejected_by_the_method(spark):
    tables = [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]
    junk = quality.judge(tables[0]).join(tables[1].select("doc_id", "quality"), "doc_id").where("quality = 0 AND NOT base_failed")
    runs = F.regexp_count(F.col("text"), F.lit(r"[#$%&*]{3}")) * 100 > F.col("n_words") * 30
    got = junk.join(tables[0].select("doc_id", "text"), "doc_id").where(runs).select("kept").collect()
    assert got and not any(r.kept for r in got)


def test_license_labels_and_order(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, "All rights\nreserved all-rights-RESERVED"), (3, "released under a MIT license"), (4, "the terms of it"), (5, None), (6, "CC BY-SA 4.0 licensed under; cc/by")]
    got = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [f.label for f in got[1].found] == ["apache"] and got[1].found[0].score == 1.0
    assert [(b.word, b.label) for b in got[2].base] == [(0, "reserved"), (3, "reserved")]
    assert [(f.label, f.score) for f in got[3].found] == [("mit", 0.8)]
    assert not got[4].found and not got[5].base and got[5].n_words == 0
    assert [b.word for b in got[6].base] == [0, 7] and "cc-by-sa" in {f.label for f in got[6].found}


def test_wrapped_notices_are_found(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal"
    bsd = "Intro words here\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided"
    mpl = "// This Source Code Form is subject to the terms of the Mozilla\n// Public License, v. 2.0. If a copy"
    gpl = "you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published"
    far = "permission is hereby granted free of charge\n" + "other text between\n" * 20 + "to any person obtaining a copy of this software and associated documentation files"
    rows = list(enumerate([mit, bsd, mpl, gpl, far, "\n".join(licenses.TEMPLATES[2][2].split())]))
    got = {r.doc_id: {f.label: f.score for f in r.found} for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].get(x) for i, x in enumerate(["mit", "bsd", "mpl", "gpl", "mit", "mit"])] == [1.0, 1.0, 1.0, 1.0, None, 1.0]


def license_labels(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [{f.label for f in r.found} | {b.label for b in r.base} for r in licenses.license_scan(df).orderBy("doc_id").collect()]


def test_short_notices_need_their_distinguishing_words(spark):
    texts = ["Released under the Apache license", "Licensed under CC BY-NC 4.0.", "CC BY 4.0", "Released under the MIT License.", "the license under which it is released " * 50, "mit", "/* Licensed under the\n * Apache License, Version 2.0 */", "GNU Lesser General Public License"]
    assert license_labels(spark, texts) == [{"apache"}, {"cc-by", "cc-by-nc"}, {"cc-by"}, {"mit"}, set(), set(), {"apache"}, {"gpl"}]


def test_whole_license_texts_are_found(spark):
    long_ = [t for t in licenses.TEMPLATES if len(t[2].split()) > 60]
    rng = np.random.default_rng(4)
    texts = []
    for _, _, text in long_:
        words = text.split()
        changed = [w if rng.random() > 0.08 else f"x{k}" for k, w in enumerate(words)]  # edited here and there
        texts.append("Some words before.\n\n" + "\n".join(" * " + " ".join(changed[i : i + 9]) for i in range(0, len(words), 9)) + "\nand after")
    assert all(t[0] in got for t, got in zip(long_, license_labels(spark, texts)))


def test_license_join_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    templates = [("a", "k1", "k1 k2 k3 k4 k5"), ("b", "k6 k2", "k6 k2 k2 k7 k1 k8 k9 k3"), ("c", "k4", "k4")]
    texts = [" ".join(f"k{x}" for x in rng.integers(1, 16, rng.integers(0, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for threshold in (0.6, 0.8, 1.0):
        got = {r.doc_id: sorted((f.label, round(f.score, 9)) for f in r.found) for r in licenses.license_scan(df, threshold, templates).collect()}
        for i, text in enumerate(texts):
            w, want = text.split(), []
            for label, marks, t in templates:
                tokens, span = set(t.split()), math.ceil(len(t.split()) / threshold - 1e-9)
                blocks = [set(w[k : k + span]) & tokens for k in range(len(w))]
                fits = [len(b) / len(tokens) for b in blocks if set(marks.split()) <= b and len(b) >= threshold * len(tokens) - 1e-9]
                want += [(label, round(max(fits), 9))] if fits else []
            assert got[i] == sorted(want)


def test_pipeline_stages_take_effect(spark, docs):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    start = spark.read.parquet(f"{SMALL}/documents.parquet")
    verdict = {r.doc_id for r in quality.judge(start).where("kept").collect()}
    now, seen = start, []
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = cut(stage(spark, now, SMALL), name)
        seen.append(now)
        assert name == "best_fit_packing" or now.columns == start.columns
        if name == "quality_rules":
            assert {r.doc_id for r in now.collect()} == verdict
        if name == "line_dedup":
            want = {r.doc_id: r.kept for r in line_dedup.line_dedup(before).collect()}
            assert {r.doc_id: r.text for r in now.collect()} == want
        if name == "simhash_near_dedup":
            keep = {r.component_id for r in simhash.simhash_groups(before).collect()}
            assert {r.doc_id for r in now.collect()} == keep
        if name == "source_mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies}
            assert collections.Counter(r.doc_id for r in now.collect()) == copies
    n = collections.Counter(r.doc_id for r in seen[3].collect())
    assert collections.Counter(r.doc_id for r in now.where("piece = 0").collect()) == n


def test_tables_are_dropped(spark):
    keep = cut(spark.range(3), "t")
    assert keep.count() == 3
    drop_tables(spark)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(keep.inputFiles()[0]).count()
