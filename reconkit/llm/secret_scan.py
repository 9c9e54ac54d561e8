"""Secrets: fixed patterns, and a battery of randomness tests over encoded strings; built-in functions only.

A candidate is a run of 20 or more key characters with a digit.  Its encoding (hex,
base 32, letters and digits, base 64) follows from its characters.  Three tests ask
whether it can be random in that encoding: chi-squared for equal use of the alphabet,
runs above and below the middle, and serial correlation.  Their smallest p-value, times
three, is the candidate's.  Long strings give the tests more power, so candidates are
grouped by length, and in each group Benjamini and Hochberg's step-up rule rejects
randomness at the given false-discovery rate; what it does not reject is a secret.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from reconkit.llm.common import stored

# fixed values: the base patterns; (kind, pattern, least length of the counted group, group)
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_KEY = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")

RATE = 0.05  # false-discovery rate: share of random strings among those called not random
_BINS = 60  # of p-values, on a logarithmic scale
_LENGTHS = (24, 32, 48, 64, 128)  # limits of the length groups
# alphabets by encoding, each character's place is its value
_ALPHABETS = (
    ("hex", "0123456789abcdef", "^[0-9a-f]+$"),
    ("HEX", "0123456789ABCDEF", "^[0-9A-F]+$"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "^[A-Z2-7]+$"),
    ("alnum", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "^[A-Za-z0-9]+$"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", "."),
)


def _spans(text: Column, pattern: str, trigger: str, keep=None) -> Column:
    """Array of (start, end, value) of the pattern's leftmost matches that don't overlap, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    both = F.transform(F.arrays_zip(between.alias("gap"), found.alias("value")), lambda x: F.struct(x["gap"].alias("gap"), x["value"].alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc, x):
        first = acc["at"] + x["gap"]
        last = first + F.length(x["value"])
        here = F.array(F.struct(first.alias("start"), last.alias("end"), x["value"].alias("value")))
        return F.when(x["value"].isNull(), acc).otherwise(F.struct(last.alias("at"), F.concat(acc["out"], here).alias("out")))

    spans = F.aggregate(both, start, step, lambda acc: acc["out"])
    if keep is not None:
        spans = F.filter(spans, lambda x: keep(x["value"]))
    return F.when(F.regexp_like(text, F.lit(trigger)), spans).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _normal_tail(z: Column) -> Column:
    """Chance that a normal value exceeds |z|, both sides (Abramowitz and Stegun 26.2.17)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.least(F.lit(1.0), 2 * F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * series)


def _upper_tail(z: Column) -> Column:
    half = _normal_tail(z) / 2
    return F.when(z > 0, half).otherwise(1 - half)


def _places(value: Column, alphabet: str, size: int) -> Column:
    return F.transform(F.split(value, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1) % size)


def _values(value: Column) -> Column:
    """Array of alphabet places, and the alphabet's size, of the first encoding that fits."""
    out = None
    for _, alphabet, pattern in reversed(_ALPHABETS):
        size = 64 if len(alphabet) > 64 else len(alphabet)
        here = F.struct(_places(value, alphabet, size).alias("v"), F.lit(size).alias("k"))
        out = here if out is None else F.when(F.regexp_like(value, F.lit(pattern)), here).otherwise(out)
    return out


def p_value(value: Column) -> Column:
    """Smallest p-value of the three tests of randomness, times three (at most 1)."""

    def battery(x):
        v, k = x["v"], x["k"].cast("double")
        n = F.size(v).cast("double")
        counts = F.transform(F.array_distinct(v), lambda d: F.size(F.filter(v, lambda y: y == d)).cast("double"))
        chi = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) * k / n - n
        free = k - 1
        wilson = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        uniform = _upper_tail(wilson)

        high = F.transform(v, lambda y: (y * 2 >= x["k"]).cast("int"))
        ones = F.aggregate(high, F.lit(0), lambda a, y: a + y).cast("double")
        zeros = n - ones
        pairs = F.arrays_zip(F.slice(high, 2, F.size(v) - 1).alias("a"), F.slice(high, 1, F.size(v) - 1).alias("b"))
        runs = F.aggregate(pairs, F.lit(1), lambda a, y: a + (y["a"] != y["b"]).cast("int")).cast("double")
        mean_runs = 1 + 2 * ones * zeros / n
        spread = F.sqrt(F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9)))
        in_runs = F.when((ones == 0) | (zeros == 0), F.pow(F.lit(2.0), 1 - n)).otherwise(_normal_tail((runs - mean_runs) / spread))

        middle = F.aggregate(v, F.lit(0.0), lambda a, y: a + y) / n
        off = F.transform(v, lambda y: y - middle)
        follow = F.arrays_zip(F.slice(off, 2, F.size(v) - 1).alias("a"), F.slice(off, 1, F.size(v) - 1).alias("b"))
        along = F.aggregate(follow, F.lit(0.0), lambda a, y: a + y["a"] * y["b"])
        square = F.aggregate(off, F.lit(0.0), lambda a, y: a + y * y)
        # expected -1/n of the variance under randomness
        serial = F.when(square == 0, F.lit(0.0)).otherwise(_normal_tail((along / square + 1 / n) * F.sqrt(n)))
        return F.least(F.lit(1.0), 3 * F.least(uniform, in_runs, serial))

    return F.transform(F.array(_values(value)), battery)[0]


def _length_group(n: Column) -> Column:
    return sum((n >= limit).cast("int") for limit in _LENGTHS)


def _bin(p: Column) -> Column:
    """0 for the smallest p-values; eight bins for each power of ten."""
    return F.greatest(F.lit(0), F.least(F.lit(_BINS - 1), F.lit(_BINS) + F.floor(F.log10(F.greatest(p, F.lit(1e-30))) * 8).cast("int")))


def marked(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id`` and arrays ``assign, access, hex, candidates`` of spans of every row; null text is empty.

    Candidates carry their p-value, length group and bin.
    """
    text = F.col("text")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plain = {
        "assign": _spans(text, ASSIGN, ASSIGN_KEY, lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 6),
        "access": _spans(text, ACCESS, ACCESS),
        "hex": _spans(text, HEX, HEX),
        "tried": _spans(text, CANDIDATE, CANDIDATE),
    }
    found = own.select("doc_id", *[c.alias(k) for k, c in plain.items()])
    base = F.concat("assign", "access", "hex")
    apart = F.filter("tried", lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    tested = F.transform(apart, lambda x: F.struct(x["start"], x["end"], p_value(x["value"]).alias("p"), _length_group(F.length(x["value"])).alias("group")))
    spans = {k: F.transform(k, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))) for k in ("assign", "access", "hex")}
    return found.select(
        "doc_id",
        *[c.alias(k) for k, c in spans.items()],
        F.transform(
            tested,
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["p"].alias("p"), x["group"].alias("group"), _bin(x["p"]).alias("bin")),
        ).alias("candidates"),
    )


def rejected_upto(candidates: DataFrame, rate: float = RATE) -> DataFrame:
    """``group, last_bin``: the step-up rule on binned p-values, each counted at its bin's upper limit."""
    counts = candidates.groupBy("group", "bin").agg(F.count("*").alias("n"))  # at most groups * bins rows
    line = Window.partitionBy("group").orderBy("bin")
    whole = Window.partitionBy("group")
    upper = F.pow(F.lit(10.0), (F.col("bin") + 1 - _BINS) / 8)
    sums = counts.select("group", "bin", F.sum("n").over(line).alias("upto"), F.sum("n").over(whole).alias("all"))
    return sums.filter(upper <= rate * F.col("upto") / F.col("all")).groupBy("group").agg(F.max("bin").alias("last_bin"))


def find_secrets(docs: DataFrame, rate: float = RATE, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, found`` of every row: spans (kind, start, end) by start, then kind; ends are exclusive.

    Kinds are those of the base patterns and ``random``.  Ids may repeat or be null.
    """
    rows = stored(marked(docs, id_col, text_col), "marked")
    limits = rejected_upto(rows.select(F.explode("candidates").alias("c")).select("c.group", "c.bin"), rate)
    # one map of at most one entry per length group
    limit = limits.agg(F.map_from_entries(F.collect_list(F.struct("group", "last_bin"))).alias("limits")).scalar()

    def named(kind: str, spans: Column) -> Column:
        order = KINDS.index(kind)
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    random = F.filter("candidates", lambda x: x["bin"] > F.coalesce(F.col("limits")[x["group"]], F.lit(-1)))
    every = F.array_sort(F.concat(*[named(k, F.col(k)) for k in KINDS[:3]], named("random", random)))
    return rows.withColumn("limits", limit).select("doc_id", F.transform(every, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("found"))


def digest(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[secret]", rate: float = RATE, id_col="doc_id", text_col="text") -> DataFrame:
    """All columns of ``docs`` with every secret in the text replaced; rows without one stay as they are.

    Rows are matched to their spans by id and a digest of the text; null texts stay null.
    """
    found = find_secrets(docs.withColumn("__id", F.xxhash64(F.coalesce(text_col, F.lit("")))), rate, "__id", text_col)
    spans = found.filter(F.size("found") > 0).dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("__id"), F.col("found").alias("__found"))
    keyed = docs.withColumn("__id", F.xxhash64(F.coalesce(text_col, F.lit(""))))
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        # an overlapping span only moves the end
        piece = F.when(x["start"] >= acc["at"], F.concat(F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    cut = F.aggregate("__found", start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    joined = keyed.join(spans, "__id", "left")
    return joined.withColumn(text_col, F.when(F.col("__found").isNotNull(), cut).otherwise(text)).select(docs.columns)
