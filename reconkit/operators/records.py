"""Keyed comparison of two tables.

Both sides are stacked with a side mark and grouped by key.  Grouping treats
null keys as equal, pre-aggregates before the one shuffle, and leaves a single
row per key however often the key occurs, so a hot key is never expanded into
its m x n pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from reconkit.operators.cumulative import cumulative
from reconkit.operators.ordering import first_n_per_group
from reconkit.session import checkpointed, local_rows

# Comparison tolerance and the number of sample rows per column.
TOLERANCE = 1e-6
SAMPLE_ROWS = 100
SWEPT_ROWS = 10_000  # rows of a key, both sides, that are paired in one place
PAIRED_ROWS = 64  # rows of a key, both sides, whose pairs are formed by a join
SLICES = 256  # of the keys, one of which tells whether they mostly occur once


def _comparable(a: T.DataType, b: T.DataType) -> bool:
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    families = (T.NumericType, dates, T.StringType)
    return a == b or any(isinstance(a, f) and isinstance(b, f) for f in families)


def _compared_value(df: DataFrame, c: str, as_text: bool) -> Column:
    """NaN counts as missing; maps are compared by their sorted entries."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(c)).cast("string")
    value = F.when(~F.isnan(c), F.col(c)) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(c)
    return value.cast("string") if as_text else value


def both_sides(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of both tables with counters ``_s`` and ``_t``.

    Types of one family are widened; others (say a number against text) are
    compared as text.  NaN becomes null here, once for every comparison below.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    text = {c: not _comparable(source.schema[c].dataType, target.schema[c].dataType) for c in columns}
    cells = lambda df: [_compared_value(df, c, text[c]).alias(c) for c in columns]
    a = source.select(*cells(source), one.alias("_s"), none.alias("_t"))
    b = target.select(*cells(target), none.alias("_s"), one.alias("_t"))
    return a.unionByName(b)


def match_records(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per distinct key: how many rows each side holds (s_rows, t_rows)."""
    return (
        both_sides(source, target, list(keys))
        .groupBy(*keys)
        .agg(F.sum("_s").alias("s_rows"), F.sum("_t").alias("t_rows"))
    )


def _match_counts() -> list[Column]:
    """Counts over one row per key with ``s_rows`` and ``t_rows``."""
    s, t = F.col("s_rows") > 0, F.col("t_rows") > 0
    return [
        F.count_if(s & ~t).alias("source_only"),
        F.count_if(~s & t).alias("target_only"),
        F.count_if(s & t).alias("common_keys"),
        F.coalesce(F.sum("s_rows"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t_rows"), F.lit(0)).alias("target_rows"),
        F.count_if((F.col("s_rows") > 1) | (F.col("t_rows") > 1)).alias("duplicate_keys"),
    ]


def _match_rate() -> Column:
    return F.coalesce(F.try_divide(F.col("common_keys"), F.greatest("source_rows", "target_rows")), F.lit(0.0))


def match_summary(matched: DataFrame) -> DataFrame:
    """One row of key counts, row counts and match rate."""
    return matched.agg(*_match_counts()).withColumn("match_rate", _match_rate())


def is_fractional(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType) and not isinstance(t, T.IntegralType)


def apart(a: Column, b: Column, limit: Column | float) -> Column:
    """Whether two doubles are not equal and further apart than ``limit``.

    Equal infinities are equal, any other pair with an infinity is apart, whatever the
    limit; null equals null only.
    """
    gap = F.abs(a - b)
    far = (gap > limit) | (gap == F.lit(float("inf"))) | F.isnan(gap)
    return ~a.eqNullSafe(b) & F.coalesce(far, F.lit(True))


def differs(a: Column, b: Column, fractional: bool, tolerance: float = TOLERANCE) -> Column:
    """Null equals null; a one-sided null differs; fractions compare within the tolerance."""
    if not fractional:
        return ~a.eqNullSafe(b)
    return apart(a.cast("double"), b.cast("double"), tolerance)


def _per_key(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: row counts and the largest value of each column on each side."""
    on_source, on_target = F.col("_s") > 0, F.col("_t") > 0
    return rows.groupBy(*keys).agg(
        F.sum("_s").alias("s_rows"),
        F.sum("_t").alias("t_rows"),
        *[F.max(F.when(on_source, F.col(c))).alias(f"s_{c}") for c in columns],
        *[F.max(F.when(on_target, F.col(c))).alias(f"t_{c}") for c in columns],
    )


def _common_columns(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in source.columns if c in target.columns and c not in keys]


def value_differences(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Per column: compared pairs and differing pairs over the keys both sides hold.

    A key with m source rows and n target rows stands for m x n pairs.  Keys that
    are unique on both sides are compared directly; the pairs of duplicated keys
    are counted from value multiplicities, without forming them.
    """
    return match_and_differences(source, target, keys, columns, tolerance)[1]


def match_and_differences(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    tolerance: float = TOLERANCE,
) -> tuple[Row, DataFrame]:
    """The row of ``match_summary`` and the table of ``value_differences``, from one grouping of both sides by key."""
    keys = list(keys)
    columns = list(columns or _common_columns(source, target, keys))
    rows = both_sides(source, target, [*keys, *columns])
    kinds = {f.name: is_fractional(f.dataType) for f in rows.schema}
    # Texts and the like go as two 64-bit hashes: fixed-width values are aggregated by
    # hashing before the shuffle, texts would have to be sorted.
    wide = [c for c in columns if not isinstance(rows.schema[c].dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    hashes = {c: [f"_h{i}_{c}" for i in range(2)] if c in wide else [c] for c in columns}
    short = rows.withColumns({h: F.xxhash64(F.lit(i), c) for c in wide for i, h in enumerate(hashes[c])}).drop(*wide)
    cells = [h for c in columns for h in hashes[c]]
    both = (F.col("s_rows") > 0) & (F.col("t_rows") > 0)

    def unlike(c: str) -> Column:
        parts = [differs(F.col(f"s_{h}"), F.col(f"t_{h}"), kinds[c] and c not in wide, tolerance) for h in hashes[c]]
        return reduce(lambda a, b: a | b, parts)

    if _often_repeated(rows.filter("_s > 0"), keys):
        return _paired_differences(rows, short, keys, columns, cells, kinds, tolerance, unlike)
    per_key = _per_key(short, keys, cells)
    unique = (F.col("s_rows") == 1) & (F.col("t_rows") == 1)

    facts = per_key.agg(
        *_match_counts(),
        F.coalesce(F.sum(F.col("s_rows") * F.col("t_rows")), F.lit(0)).alias("pairs"),
        F.count_if(both & ~unique).alias("repeated"),
        F.count_if(both & ~unique & (F.col("s_rows") + F.col("t_rows") > SWEPT_ROWS)).alias("large"),
        *[
            F.count_if(unique & unlike(c)).alias(f"d_{c}")
            for c in columns
        ],
    ).withColumn("match_rate", _match_rate()).first()
    spark = source.sparkSession
    direct = local_rows(
        spark,
        [(c, facts["pairs"], facts[f"d_{c}"]) for c in columns],
        "column_name string, compared bigint, different bigint",
    )
    if not facts["repeated"]:
        return facts, direct
    repeated = per_key.filter(both & ~unique).select(*keys, "s_rows", "t_rows")
    extra = _duplicate_differences(rows, repeated, keys, columns, kinds, tolerance, bool(facts["large"]))
    more = (F.col("different") + F.coalesce("more", F.lit(0))).cast("bigint")
    return facts, direct.join(extra, "column_name", "left").select("column_name", "compared", more.alias("different"))


def _often_repeated(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether more than one in twenty keys of a slice occurs again; it decides only on the way taken, not on results."""
    own = df.select(*keys).filter(F.pmod(F.xxhash64(*keys), F.lit(SLICES)) == 0)
    seen = own.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("again"), F.count(F.lit(1)).alias("n")).first()
    return seen["again"] * 20 > seen["n"]


def _paired_differences(rows, short, keys, columns, cells, kinds, tolerance, unlike) -> tuple[Row, DataFrame]:
    """``match_and_differences`` of tables whose keys often repeat.

    Counts come from a grouping of the keys alone.  Then a join forms the pairs of all keys of
    up to ``PAIRED_ROWS`` rows, so that each row is shuffled once, whether its key repeats or not.
    """
    matched = rows.groupBy(*keys).agg(F.sum("_s").alias("s_rows"), F.sum("_t").alias("t_rows"))
    size = F.col("s_rows") + F.col("t_rows")
    found = [F.count_if(size > PAIRED_ROWS).alias("frequent"), F.count_if((size > SWEPT_ROWS) & (F.col("s_rows") * F.col("t_rows") > 0)).alias("large")]
    pairs = F.coalesce(F.sum(F.col("s_rows") * F.col("t_rows")), F.lit(0)).alias("pairs")
    facts = matched.agg(*_match_counts(), pairs, *found).withColumn("match_rate", _match_rate()).first()
    frequent = checkpointed(matched.filter(size > PAIRED_ROWS)) if facts["frequent"] else None
    few = _rows_of(short, frequent, keys, "left_anti") if facts["frequent"] else short
    sides = []
    for side, here in (("s", "_s"), ("t", "_t")):
        sides.append(few.filter(F.col(here) > 0).select(*[F.col(c).alias(f"_{side}_{c}") for c in keys], *[F.col(c).alias(f"{side}_{c}") for c in cells]))
    on = reduce(lambda a, b: a & b, [F.col(f"_s_{k}").eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    formed = sides[0].join(sides[1], on).agg(*[F.count_if(unlike(c)).alias(f"d_{i}") for i, c in enumerate(columns)]).first()
    direct = local_rows(
        rows.sparkSession,
        [(c, facts["pairs"], formed[f"d_{i}"]) for i, c in enumerate(columns)],
        "column_name string, compared bigint, different bigint",
    )
    if not facts["frequent"]:
        return facts, direct
    extra = _duplicate_differences(rows, frequent.filter("s_rows > 0 AND t_rows > 0"), keys, columns, kinds, tolerance, bool(facts["large"]))
    more = (F.col("different") + F.coalesce("more", F.lit(0))).cast("bigint")
    return facts, direct.join(extra, "column_name", "left").select("column_name", "compared", more.alias("different"))


def _rows_of(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is in ``wanted`` (one row per key); adaptive execution splits hot keys of a semi-join."""
    names = {k: f"_k_{k}" for k in keys}
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys])
    return rows.join(wanted.select(*[F.col(k).alias(names[k]) for k in keys]), on, how)


def _duplicate_differences(rows, repeated, keys, columns, kinds, tolerance, large: bool) -> DataFrame:
    """(column_name, more): differing pairs among keys that occur more than once on a side.

    Keys of up to ``SWEPT_ROWS`` rows are swept where a shuffle by key puts them; the pairs of
    larger ones are counted from values ranked across the cluster.
    """
    repeated = checkpointed(repeated)
    pairs = repeated.agg(F.sum(F.col("s_rows") * F.col("t_rows")).alias("pairs")).scalar()
    size = F.col("s_rows") + F.col("t_rows")
    few = _rows_of(rows, repeated.filter(size <= SWEPT_ROWS) if large else repeated, keys)
    equal = [_swept_pairs(few, keys, columns, kinds, tolerance)]
    if large:
        many = _rows_of(rows, repeated.filter(size > SWEPT_ROWS), keys)
        equal += _ranked_pairs(checkpointed(many), keys, columns, kinds, tolerance)
    total = reduce(DataFrame.unionByName, equal).groupBy("column_name").agg(F.sum("same").alias("same"))
    return total.select("column_name", (pairs - F.col("same")).alias("more"))


def _equal_pairs(group: np.ndarray, source: np.ndarray, codes: Sequence[np.ndarray]) -> int:
    """Pairs of a source and a target row of one group whose codes are all equal."""
    order = np.lexsort([*codes, group])
    fresh = np.ones(len(group), bool)
    if len(group):
        fresh[1:] = np.any([c[order][1:] != c[order][:-1] for c in (group, *codes)], axis=0)
    run = np.cumsum(fresh) - 1
    mine = np.bincount(run, source[order], minlength=1)
    return int((mine * (np.bincount(run, minlength=1) - mine)).sum())


def _close_pairs(group: np.ndarray, source: np.ndarray, values: np.ndarray, tolerance: float) -> int:
    """Pairs of a source and a target value of one group no further apart than the tolerance."""
    theirs, mine = ~source, source
    at = np.concatenate([values[theirs], values[mine] - tolerance, values[mine] + tolerance])
    of = np.concatenate([group[theirs], group[mine], group[mine]])
    # at equal values: lower ends, then target values, then upper ends
    kind = np.repeat([1, 0, 2], [theirs.sum(), mine.sum(), mine.sum()])
    order = np.lexsort([kind, at, of])
    seen, kind = np.cumsum(kind[order] == 1), kind[order]
    return int(seen[kind == 2].sum() - seen[kind == 0].sum())


def _swept_pairs(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], kinds: dict, tolerance: float) -> DataFrame:
    """(column_name, same): equal pairs of keys whose rows fit in one place, after one shuffle of narrow rows."""
    marked = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    exact = [c for c in columns if not kinds[c]]
    fractional = [c for c in columns if kinds[c]]
    # a key and a value that is compared exactly stand as 128 bits each
    cells = [F.xxhash64(F.lit(i), *marked).alias(f"k{i}") for i in range(2)] + [(F.col("_s") > 0).alias("source")]
    cells += [F.xxhash64(F.lit(j), F.col(c).isNull(), c).alias(f"e{i}_{j}") for i, c in enumerate(exact) for j in range(2)]
    cells += [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(fractional)]
    ordered = rows.select(*cells).repartition("k0", "k1").sortWithinPartitions("k0", "k1")

    def run(batches):
        same, held = np.zeros(len(columns), np.int64), None

        def count(part: pa.Table) -> None:
            k0, k1 = part["k0"].to_numpy(), part["k1"].to_numpy()
            fresh = np.ones(len(k0), bool)
            fresh[1:] = (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1])
            group, source = np.cumsum(fresh), part["source"].to_numpy().astype(bool)
            for i, c in enumerate(exact):
                same[columns.index(c)] += _equal_pairs(group, source, [part[f"e{i}_{j}"].to_numpy() for j in range(2)])
            for i, c in enumerate(fractional):
                values = part[f"f{i}"].to_numpy()
                gone = np.isnan(values)
                same[columns.index(c)] += _equal_pairs(group[gone], source[gone], [])
                same[columns.index(c)] += _close_pairs(group[~gone], source[~gone], values[~gone], tolerance)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            k0, k1 = table["k0"].to_numpy(), table["k1"].to_numpy()
            last = np.flatnonzero((k0 != k0[-1]) | (k1 != k1[-1]))
            whole = int(last[-1]) + 1 if len(last) else 0  # the last key may go on in the next batch
            if whole:
                count(table.slice(0, whole))
            held = table.slice(whole)
        if held is not None:
            count(held)
        yield pa.RecordBatch.from_arrays([pa.array(columns, pa.string()), pa.array(same)], ["column_name", "same"])

    return ordered.mapInArrow(run, "column_name string, same long")


def _ranked_pairs(chosen: DataFrame, keys: Sequence[str], columns: Sequence[str], kinds: dict, tolerance: float) -> list[DataFrame]:
    """(column_name, same) of very frequent keys, from value multiplicities and running totals."""
    s, t = F.sum("_s").alias("s"), F.sum("_t").alias("t")
    equal = []
    exact = [c for c in columns if not kinds[c]]
    if exact:
        cells = chosen.select(*keys, "_s", "_t", *[F.col(c).cast("string").alias(c) for c in exact])
        long = cells.unpivot([*keys, "_s", "_t"], exact, "column_name", "v")
        same = long.groupBy(*keys, "column_name", "v").agg(s, t)
        equal.append(same.groupBy("column_name").agg(F.sum(F.col("s") * F.col("t")).alias("same")))
    fractional = [c for c in columns if kinds[c]]
    if fractional:
        cells = chosen.select(*keys, "_s", "_t", *[F.col(c).cast("double").alias(c) for c in fractional])
        long = cells.unpivot([*keys, "_s", "_t"], fractional, "column_name", "v")
        nulls = long.filter("v IS NULL").groupBy(*keys, "column_name").agg(s, t)
        equal.append(nulls.groupBy("column_name").agg(F.sum(F.col("s") * F.col("t")).alias("same")))
        equal.append(_pairs_within(long.filter("v IS NOT NULL"), keys, tolerance))
    return equal


def _pairs_within(long: DataFrame, keys: Sequence[str], tolerance: float) -> DataFrame:
    """(column_name, same): pairs of one key no further apart than the tolerance.

    For every source value v, target rows up to v + tolerance minus target rows
    below v - tolerance, read from running totals of the target counts.
    """
    none = F.lit(0).cast("bigint")

    def event(at: Column, c: Column = none, hi: Column = none, lo: Column = none) -> Column:
        return F.struct(at.alias("v"), c.alias("c"), hi.alias("hi"), lo.alias("lo"))

    counted = long.groupBy(*keys, "column_name", "v").agg(F.sum("_s").alias("s"), F.sum("_t").alias("t"))
    events = counted.select(
        *keys,
        "column_name",
        F.inline(
            F.array(
                event(F.col("v"), c=F.col("t")),
                event(F.col("v") + tolerance, hi=F.col("s")),
                event(F.col("v") - tolerance, lo=F.col("s")),
            )
        ),
    )
    points = events.groupBy(*keys, "column_name", "v").agg(
        F.sum("c").alias("c"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo")
    )
    ranked = cumulative(points, "v", ["c"], groups=[*keys, "column_name"])
    upto = F.col("hi") * (F.col("before_c") + F.col("c"))
    return ranked.groupBy("column_name").agg(F.sum(upto - F.col("lo") * F.col("before_c")).alias("same"))


def difference_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Long table (keys..., column_name, source_value, target_value) of differing values.

    A key that is repeated on a side stands for all pairs of its rows.  It is listed with
    the pairs furthest apart (smallest against largest value) and one pair for a null
    against a value: if any of its pairs differs, one of these does.
    """
    keys = list(keys)
    columns = list(columns or _common_columns(source, target, keys))
    rows = both_sides(source, target, [*keys, *columns])
    kinds = {f.name: is_fractional(f.dataType) for f in rows.schema}
    aggs = []
    for side, here in (("s", F.col("_s") > 0), ("t", F.col("_t") > 0)):
        for c in columns:
            value = F.when(here, F.col(c))
            aggs += [F.min(value).alias(f"{side}_lo_{c}"), F.max(value).alias(f"{side}_hi_{c}"), F.count(value).alias(f"{side}_n_{c}")]
    common = rows.groupBy(*keys).agg(F.sum("_s").alias("s_rows"), F.sum("_t").alias("t_rows"), *aggs)

    def pairs(c: str) -> Column:
        lo, hi, n = ({side: F.col(f"{side}_{part}_{c}") for side in "st"} for part in ("lo", "hi", "n"))
        none = F.lit(None).cast("string")
        pair = lambda a, b: F.struct(
            F.lit(c).alias("column_name"), a.cast("string").alias("source_value"), b.cast("string").alias("target_value")
        )
        both = (n["s"] > 0) & (n["t"] > 0)
        found = [
            F.when(both & differs(a, b, kinds[c], tolerance), pair(a, b)) for a, b in ((lo["s"], hi["t"]), (hi["s"], lo["t"]))
        ]
        found.append(F.when((n["s"] < F.col("s_rows")) & (n["t"] > 0), pair(none, lo["t"])))
        found.append(F.when((n["t"] < F.col("t_rows")) & (n["s"] > 0), pair(lo["s"], none)))
        return F.array_distinct(F.array_compact(F.array(*found)))

    listed = common.filter("s_rows > 0 AND t_rows > 0")
    return listed.select(*keys, F.inline(F.flatten(F.array(*[pairs(c) for c in columns]))))


def difference_sample(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    n: int = SAMPLE_ROWS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """At most ``n`` differing pairs per column, smallest keys first."""
    order = [*keys, "source_value", "target_value"]
    return first_n_per_group(difference_rows(source, target, keys, columns, tolerance), ["column_name"], order, n)
