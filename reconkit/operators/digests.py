"""Order-free digests of rows over key ranges, and their tree.

The first key's values are cut into ranges, the leaves; a value that fills several ranges
by itself is spread over them by a hash of all keys.  A leaf's digest is the sum of its
rows' 128-bit digests (four lanes of 32 bits, each modulo 2^32), so neither the order of
rows nor their partitioning matters, and digests of leaves add up to those of the nodes
above them.  Equal digests mean equal rows; different ones mean only "look closer".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

FANOUT = 16  # children of a node
LANES = ("d0", "d1", "d2", "d3")
_LANE = 1 << 32
BOUNDARY_ACCURACY = 20  # of a range's share, for choosing boundaries


def canonical(df: DataFrame, c: str) -> Column:
    """A value in a form that hashes alike wherever it compares alike exactly; NaN is null."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(c).cast("bigint")
    if isinstance(kind, T.NumericType):
        x = F.col(c).cast("double")
        return F.when(~F.isnan(x), x + F.lit(0.0))  # minus zero is zero
    if isinstance(kind, (T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(c)
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(c)).cast("string")
    return F.col(c).cast("string")


def _halves(columns: Sequence[Column]) -> list[Column]:
    # a null changes no running hash, so each value stands with its mark
    marked = [x for c in columns for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(seed), *marked) for seed in (17, 71)]


def _lanes(halves: Sequence[Column]) -> list[Column]:
    return [x for h in halves for x in (h.bitwiseAND(_LANE - 1), F.shiftrightunsigned(h, 32))]


def order_code(df: DataFrame, key: str) -> Column:
    """A double that grows with the key's values (not strictly); null for a missing value."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.NumericType):
        x = F.col(key).cast("double")
        return F.when(~F.isnan(x), x)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(key).cast("timestamp")).cast("double")
    # the first six bytes of anything else, as a number
    head = F.rpad(F.substring(F.hex(F.encode(F.col(key).cast("string"), "UTF-8")), 1, 12), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def boundaries(df: DataFrame, key: str, leaves: int) -> DataFrame:
    """One row: ``bounds``, the ``leaves - 1`` values of the key's code between equal shares of the rows."""
    if leaves < 2 or leaves & (leaves - 1):
        raise ValueError("leaves must be a power of two, 2 at least")
    shares = [i / leaves for i in range(1, leaves)]
    found = df.agg(F.percentile_approx(order_code(df, key), shares, BOUNDARY_ACCURACY * leaves).alias("bounds"))
    none = F.array_repeat(F.lit(0.0), leaves - 1)
    return found.select(F.coalesce("bounds", none).alias("bounds"))


def _rank(df: DataFrame, name: str, size: int) -> DataFrame:
    """Add ``name``: how many boundaries lie below ``_code``, by halving steps in generated code."""
    df = df.withColumn(name, F.lit(0))
    for i in range(1, size.bit_length()):
        step = size >> i
        below = F.get("_bounds", F.col(name) + (step - 1)) < F.col("_code")
        df = df.withColumn(name, F.col(name) + F.when(below, step).otherwise(0))
    return df


def with_leaf(df: DataFrame, keys: Sequence[str], bounds: DataFrame, leaves: int, name: str = "_leaf") -> DataFrame:
    """Add the number of each row's key range; rows without a first key are in range 0."""
    # of each boundary the number of those up to it: equal ones stand together
    upto = F.transform("bounds", lambda b: F.size(F.filter("bounds", lambda x: x <= b)))
    ends = bounds.select(upto.alias("ends")).scalar()
    coded = df.withColumns({"_code": order_code(df, keys[0]), "_bounds": bounds.scalar(), "_ends": ends})
    on = F.get("_bounds", F.col("_below")) == F.col("_code")
    ranked = _rank(coded, "_below", leaves).withColumn("_upto", F.when(on, F.get("_ends", F.col("_below"))).otherwise(F.col("_below")))
    spread = F.pmod(F.xxhash64(*[canonical(df, k) for k in keys]), F.col("_upto") - F.col("_below") + 1)
    leaf = F.when(F.col("_code").isNull(), 0).otherwise(F.col("_below") + spread).cast("int")
    return ranked.withColumn(name, leaf).drop("_code", "_bounds", "_ends", "_below", "_upto")


def leaf_digests(df: DataFrame, keys: Sequence[str], leaf: str = "_leaf") -> DataFrame:
    """``node, rows, pairs, repeated, d0..d3`` of each leaf that has rows.

    ``pairs`` are the key-equal pairs that the leaf would form with its own copy, ``repeated``
    the rows beyond a key's first.  Fewer than 2^31 rows fit in a leaf.
    """
    columns = sorted(c for c in df.columns if c != leaf)
    own = [canonical(df, k).alias(f"_k{i}") for i, k in enumerate(keys)]
    # rows stay where they are for the digests; only keys and counts are shuffled
    node = F.col(leaf).alias("node")
    per_key = df.select(node, *own).groupBy("node", *[f"_k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    counts = per_key.groupBy("node").agg(F.sum("n").alias("rows"), F.sum(n * n).alias("pairs"), F.sum(n - 1).alias("repeated"))
    hashes = df.select(node, *[h.alias(f"h{i}") for i, h in enumerate(_halves([canonical(df, c) for c in columns]))])
    lanes = [x.alias(d) for x, d in zip(_lanes([F.col("h0"), F.col("h1")]), LANES)]
    sums = hashes.select("node", *lanes).groupBy("node").agg(*[F.pmod(F.sum(d), F.lit(_LANE)).alias(d) for d in LANES])
    return counts.join(sums, "node").select("node", "rows", "pairs", "repeated", *LANES)


def parents(nodes: DataFrame) -> DataFrame:
    """The digests one level up."""
    up = F.floor(F.col("node") / FANOUT).cast("int").alias("node")
    counts = [F.sum(c).alias(c) for c in ("rows", "pairs", "repeated")]
    return nodes.groupBy(up).agg(*counts, *[F.pmod(F.sum(d), F.lit(_LANE)).alias(d) for d in LANES])


def levels(leaves: int) -> int:
    """Levels above the leaves, up to one root."""
    n = 0
    while leaves > 1:
        leaves, n = -(-leaves // FANOUT), n + 1
    return n


def column_digests(df: DataFrame, leaf: str = "_leaf") -> DataFrame:
    """``column_name, data_type, rows, d0..d3``: order-free digest of each column's values."""
    columns = [c for c in df.columns if c != leaf]
    # hashes first, then long sums by leaf: a leaf's fit, and decimals of the whole table are slow
    halves = {f"{i}_{j}": h for i, c in enumerate(columns) for j, h in enumerate(_halves([canonical(df, c)]))}
    hashes = df.select(leaf, *[h.alias(name) for name, h in halves.items()])
    sums = [F.sum(x).alias(f"{i}_{d}") for i in range(len(columns)) for x, d in zip(_lanes([F.col(f"{i}_0"), F.col(f"{i}_1")]), LANES)]
    per_leaf = hashes.groupBy(leaf).agg(F.count(F.lit(1)).alias("n"), *sums)
    folded = [F.pmod(F.coalesce(F.sum(F.pmod(c, F.lit(_LANE))), F.lit(0)), F.lit(_LANE)).alias(c) for c in per_leaf.columns[2:]]
    wide = per_leaf.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *folded)
    each = [
        F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"), F.col("n").alias("rows"), *[F.col(f"{i}_{d}").alias(d) for d in LANES])
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*each)))
