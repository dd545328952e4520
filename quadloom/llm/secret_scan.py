"""Secret scan: fixed patterns plus a battery of randomness tests.

Base spans come from three patterns. The method then looks at every token of
``MIN_TOKEN`` or more characters that mixes letters and digits, infers its
encoding from its alphabet, and tests the hypothesis "drawn at random from that
alphabet": chi-squared uniformity, runs above and below the alphabet's middle,
and serial correlation, combined into one p-value. Random tokens spread their
p-values evenly, structured ones pile up near 0; so within each stratum of
encoding and length the evenly spread part is estimated from the upper half,
and the lowest threshold whose expected share of structured tokens stays within
``max_false`` decides. Each different token counts once, however often it is
copied. Strata with fewer than ``LEAST_TOKENS`` are pooled by length; where the
pool holds too few as well, ``FEW_P`` decides. The strata make the control length-aware: short tokens,
whose tests are weak, need a higher p-value than long ones. No token below
``LEAST_P`` is called random whatever its stratum holds.

Positions count code points. Only DataFrame functions are used; texts are read
once and never shuffled (hashes of tokens are), a digest of spans goes to the
shared folder, and what
reaches the driver is at most ``ENCODINGS x BANDS`` thresholds.

Defined cases: null text has no spans; repeated rows are scanned each; an empty
table gives an empty result; a text may hold any number of matches (prefix sums
run in blocks); extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, let, prefixed, read, text_of

# Patterns and the order of kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
KINDS = ["assign", "access", "hex", "random"]
MIN_TOKEN = 16
# Encoding, pattern of the whole token, alphabet in its natural order.
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = [
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("upper36", "^[A-Z0-9]+$", _DIGITS + _UPPER),
    ("lower36", "^[a-z0-9]+$", _DIGITS + _LOWER),
    ("base62", "^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
    ("base64", "^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_"),
]
BANDS = [24, 32, 48, 64, 128]
BINS, LEAST_P = 20, 0.001
# With fewer different tokens the evenly spread part can't be estimated; then tokens from FEW_P on are called.
LEAST_TOKENS, FEW_P = 50, 0.01
_BLOCK = 256


def prefix_sums(a: Column) -> Column:
    """Sums of all earlier elements, by blocks: a long array never costs its square."""
    running = lambda x: F.aggregate(x, F.array(F.lit(0).cast("long")), lambda s, v: F.concat(s, F.array(F.element_at(s, -1) + v)))

    def whole(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _BLOCK).cast("int")), lambda b: running(F.slice(x, b * _BLOCK + 1, _BLOCK)))
        return let(blocks, lambda bs: let(running(F.transform(bs, lambda r: F.element_at(r, -1))), lambda o: F.flatten(F.transform(bs, lambda r, k: F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda v: v + F.get(o, k))))))

    return F.when(F.size(a) == 0, a).otherwise(let(a, whole))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<start, end, value>>`` of all leftmost matches; what lies between them gives the positions."""
    size = lambda a: F.transform(a, lambda x: F.length(x).cast("long"))
    gaps = size(F.split(text, pattern, -1))
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    value = F.regexp_extract_all(text, F.lit(pattern), group)

    def spans(g: Column, f: Column, v: Column) -> Column:
        step = F.transform(f, lambda n, i: n + F.get(g, i))
        return let(prefix_sums(step), lambda p: F.transform(f, lambda n, i: F.struct((F.get(p, i) + F.get(g, i)).alias("start"), (F.get(p, i) + F.get(g, i) + n).alias("end"), F.get(v, i).alias("value"))))

    return let(gaps, lambda g: let(size(found), lambda f: let(value, lambda v: spans(g, f, v))))


NO_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _kind(found: Column, index: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(index).alias("kind"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    none = F.array().cast(NO_SPANS)
    assign = F.when((F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & F.rlike(text, F.lit(ASSIGN)), _kind(F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 6), 0)).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")) & F.rlike(text, F.lit(ACCESS)), _kind(matches(text, ACCESS), 1)).otherwise(none)
    hexes = F.when(F.rlike(text, F.lit(HEX)), _kind(matches(text, HEX), 2)).otherwise(none)
    return F.array_sort(F.concat(assign, access, hexes))


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, by a logistic curve (absolute error below 0.0002)."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * F.pow(z, F.lit(3))))


def _battery(bare: Column, alphabet: str) -> Column:
    """p-value of "random over this alphabet": the least of three tests, spread evenly again for random tokens."""
    k, n = len(alphabet), F.length(bare).cast("double")
    counts = F.transform(F.array_distinct(F.split(bare, "")), lambda c: F.pow((F.length(bare) - F.length(F.replace(bare, c, F.lit("")))).cast("double"), F.lit(2)))
    chi = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) * k / n - n
    # Wilson-Hilferty: the cube root of a chi-squared variable is nearly normal.
    df = k - 1.0
    p_uniform = normal_tail((F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5)
    place = F.transform(F.split(bare, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1 - (k - 1) / 2).cast("double"))

    def ordered(v: Column) -> Column:
        last = F.size(v) - 1
        pairs = F.slice(v, F.lit(1), last)
        high = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x > 0).cast("double"))
        runs = F.aggregate(F.transform(pairs, lambda x, i: ((x > 0) != (F.get(v, i + 1) > 0)).cast("double")), F.lit(1.0), lambda a, x: a + x)
        mean = 2 * high * (n - high) / n + 1
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
        p_runs = F.when((high == 0) | (high == n), 0.0).otherwise(2 * normal_tail(F.abs(runs - mean) / spread))
        square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
        lagged = F.aggregate(F.transform(pairs, lambda x, i: x * F.get(v, i + 1)), F.lit(0.0), lambda a, x: a + x)
        p_serial = 2 * normal_tail(F.abs(lagged / square) * F.sqrt(n))
        return 1 - F.pow(1 - F.least(F.lit(1.0), p_uniform, p_runs, p_serial), F.lit(3))

    return let(place, ordered)


def candidates(text: Column) -> Column:
    """Mixed tokens with their stratum (encoding and length band) and p-value."""
    mixed = lambda v: F.rlike(v, F.lit("[0-9]")) & F.rlike(v, F.lit("[A-Za-z]"))

    def scored(m: Column) -> Column:
        bare = F.rtrim(m["value"], F.lit("="))
        kind, p = F.lit(-1), F.lit(0.0)
        for i, (_, pattern, alphabet) in reversed(list(enumerate(ENCODINGS))):
            fits = F.rlike(m["value"], F.lit(pattern))
            kind, p = F.when(fits, i).otherwise(kind), F.when(fits, _battery(bare, alphabet)).otherwise(p)
        band = F.lit(0)
        for edge in BANDS:
            band = band + (F.length(bare) >= edge).cast("int")
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), (kind * (len(BANDS) + 1) + band).alias("stratum"), p.alias("p"), F.xxhash64(bare).alias("token"))

    found = F.transform(F.filter(matches(text, TOKEN), lambda m: mixed(m["value"])), scored)
    none = F.array().cast("array<struct<start:bigint,end:bigint,stratum:int,p:double,token:bigint>>")
    return F.when(F.rlike(text, F.lit(TOKEN)), F.filter(found, lambda m: m["stratum"] >= 0)).otherwise(none)


def thresholds(scanned: DataFrame, max_false: float = 0.05) -> dict[int, float]:
    """By stratum, the lowest p-value that counts as random (over 1: none does)."""
    one = scanned.select(F.explode("candidates").alias("c")).select("c.stratum", "c.token", F.least(F.floor(F.col("c.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
    # Copies say nothing about how p-values spread: each different token counts once.
    one = one.groupBy("stratum", "token").agg(F.min("bin").alias("bin"))
    counts: dict[int, list[int]] = {}
    for r in one.groupBy("stratum", "bin").count().collect():  # strata times bins: a fixed number of rows at most
        counts.setdefault(r["stratum"], [0] * BINS)[r["bin"]] = r["count"]
    # Strata with few tokens are pooled by length band.
    few, pools = {s for s, bins in counts.items() if sum(bins) < LEAST_TOKENS}, {}
    for s in few:
        band = s % (len(BANDS) + 1)
        pools[band] = [a + b for a, b in zip(pools.get(band, [0] * BINS), counts[s])]
    return {s: lowest(pools[s % (len(BANDS) + 1)] if s in few else bins, max_false) for s, bins in counts.items()}


def lowest(bins: list[int], max_false: float) -> float:
    """The lowest p-value from which on at most ``max_false`` of the tokens are expected to be structured."""
    if sum(bins) < LEAST_TOKENS:
        return FEW_P
    even = 2 * sum(bins[BINS // 2 :]) / BINS  # random tokens in each bin
    for low in range(BINS):
        called = sum(bins[low:])
        if called and max(0.0, called - even * (BINS - low)) <= max_false * called:
            return low / BINS
    return 2.0


def secret_scan(docs: DataFrame, max_false: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: arrays of ``struct<start, kind, end>``, ``kind`` an index into ``KINDS``."""
    rows = prefixed(docs, doc_id=F.col(id_col), text=text_of(text_col))
    scanned = cut(rows.select("doc_id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("candidates")), "spans")
    limit = thresholds(scanned, max_false)
    table = F.create_map(*[x for s, t in limit.items() for x in (F.lit(s), F.lit(t))]) if limit else F.lit(None).cast("map<int,double>")
    called = F.filter("candidates", lambda c: c["p"] >= F.greatest(F.lit(LEAST_P), F.coalesce(F.try_element_at(table, c["stratum"]), F.lit(2.0))))
    added = F.transform(called, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def span_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan(read(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
