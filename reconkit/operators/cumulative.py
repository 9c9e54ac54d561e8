"""Order-dependent computations without a single ordered partition.

Two building blocks:

* ``cumulative`` works on a *value table* (one row per distinct value, with
  counts).  Large groups are cut into value ranges at approximate percentiles,
  running totals are taken inside each range, and the totals of all earlier
  ranges are added back.  Values are distinct, so none can dominate a range.
* ``range_buckets`` works on the rows themselves, for positional operators.
  Rows are range-partitioned on (group, order) and stored, so that a group
  holding a third of the table is spread over as many buckets as it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reconkit.session import checkpointed, parallelism


# Limits on bucket numbers, as bucket tables are aggregated and broadcast; the
# sample size per bucket for choosing value ranges; the largest hinted broadcast.
MAX_VALUE_BUCKETS, MAX_ROW_BUCKETS = 16_384, 131_072
SAMPLE_PER_BUCKET = 1000
MAX_BROADCAST_ROWS = 1 << 20


def _with_bucket(df: DataFrame, x: Column, bounds: Column, size: int) -> DataFrame:
    """Add ``_bucket``: for ``_large`` rows the number of boundaries below ``x``.

    ``size`` is a power of two, ``bounds`` has ``size - 1`` entries.  Each halving
    step is a projection of its own, so that all of them run as generated code.
    """
    df = df.withColumns({"_bounds": bounds, "_probe": x, "_bucket": F.lit(0)})
    for i in range(1, size.bit_length()):
        step = size >> i
        above = F.col("_large") & (F.get("_bounds", F.col("_bucket") + (step - 1)) < F.col("_probe"))
        df = df.withColumn("_bucket", F.col("_bucket") + F.when(above, step).otherwise(0))
    return df.drop("_bounds", "_probe")


def _same(names: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in names])


def cumulative(
    values: DataFrame,
    order: str,
    sums: Sequence[str] = (),
    maxima: Sequence[str] = (),
    groups: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Add running totals along ``order`` to a table of distinct ``order`` values.

    For each count column ``c`` of ``sums``: ``before_c`` (sum over smaller values) and
    ``total_c`` (sum over the group).  For each of ``maxima``: ``upto_c``, the
    largest value seen so far, this row included.  ``order`` must be numeric and
    not null; a null in ``groups`` is a group of its own.
    """
    groups = list(groups)
    n = 1 << ((buckets or parallelism(values.sparkSession, MAX_VALUE_BUCKETS)) - 1).bit_length()
    x = F.col(order).cast("double")
    # Reading the counts in every branch below keeps their plans equal, so Spark
    # computes the table and its shuffle once and reuses it.
    present = [F.col(c) >= 0 for c in sums] + [F.col(c).isNotNull() for c in maxima]
    values = values.filter(reduce(lambda a, b: a | b, present))

    rows = values.agg(F.count(F.lit(1)).alias("n")).scalar()

    # A group is cut into ranges only if it holds more than 1/n of the rows, so
    # there are at most n such groups and their list is safe to broadcast.
    large = values
    marked = values.withColumn("_large", F.lit(True))
    if groups:
        sizes = values.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
        top = sizes.filter(F.col("_size") * n > rows).select(
            *[F.col(g).alias(f"g_{g}") for g in groups], F.lit(True).alias("_large")
        )
        on = _same(groups, "g_")
        large = values.join(F.broadcast(top), on, "left_semi")
        marked = values.join(F.broadcast(top), on, "left").select(*values.columns, "_large")
    # Range limits come from a bounded choice of values; they affect only the balance.
    # Hashing the counts as well keeps the filter above the shared table.
    every = F.greatest(F.floor(rows / F.lit(SAMPLE_PER_BUCKET * n)), F.lit(1))
    chosen = large.filter(F.pmod(F.xxhash64(order, *sums, *maxima), every) == 0)
    bounds = chosen.agg(F.percentile_approx(x, [i / n for i in range(1, n)], 20 * n)).scalar()
    ranged = _with_bucket(marked, x, bounds, n)

    per_bucket = ranged.filter("_large").groupBy(*groups, "_bucket").agg(
        *[F.sum(c).alias(f"s_{c}") for c in sums], *[F.max(c).alias(f"m_{c}") for c in maxima]
    )
    # At most n rows per group, so this window never sees more than n rows at once.
    earlier = W.partitionBy(*groups).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*groups)
    offsets = per_bucket.select(
        *[F.col(g).alias(f"o_{g}") for g in groups],
        F.col("_bucket").alias("o__bucket"),
        *[F.sum(f"s_{c}").over(earlier).alias(f"off_{c}") for c in sums],
        *[F.sum(f"s_{c}").over(whole).alias(f"all_{c}") for c in sums],
        *[F.max(f"m_{c}").over(earlier).alias(f"off_{c}") for c in maxima],
    )

    if not groups or n * n <= MAX_BROADCAST_ROWS:
        offsets = F.broadcast(offsets)  # at most n groups of n ranges

    inside = W.partitionBy(*groups, "_bucket")
    before = inside.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    upto = inside.orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    ranged = ranged.select(
        "*",
        *[F.sum(c).over(before).alias(f"in_{c}") for c in sums],
        *[F.sum(c).over(inside).alias(f"bucket_{c}") for c in sums],
        *[F.max(c).over(upto).alias(f"in_{c}") for c in maxima],
    )
    zero = F.lit(0)
    return ranged.join(offsets, _same([*groups, "_bucket"], "o_"), "left").select(
        *values.columns,
        *[(F.coalesce(f"in_{c}", zero) + F.coalesce(f"off_{c}", zero)).alias(f"before_{c}") for c in sums],
        *[F.coalesce(f"all_{c}", f"bucket_{c}").alias(f"total_{c}") for c in sums],
        *[F.greatest(f"in_{c}", f"off_{c}").alias(f"upto_{c}") for c in maxima],
    )


def range_buckets(
    df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Rows stored in ``_bucket`` ranges of (partition_by, order_by), in that order, with their place ``_at``.

    ``order_by`` should end in a unique column.  The stored copy pins the bucket
    numbers: a second evaluation could sample other range limits.  ``_at`` grows
    along the whole order and by one from row to row inside a bucket.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_last() for c in [*partition_by, *order_by]]
    ranged = df.repartitionByRange(parallelism(spark, MAX_ROW_BUCKETS), *keys).sortWithinPartitions(*keys)
    return checkpointed(ranged.withColumns({"_bucket": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


def carry(
    bucketed: DataFrame,
    partition_by: Sequence[str],
    aggregates: Mapping[str, Column],
    combine: Mapping[str, Column],
    backwards: bool = False,
) -> DataFrame:
    """Attach, per row, values combined over its group's earlier (later) buckets.

    ``aggregates`` are evaluated per (group, bucket); ``combine`` then runs as
    window expressions over the neighbouring buckets.  Only a group that crosses
    a bucket limit needs a carry, and at most one group crosses each limit, so
    the broadcast side has fewer rows than there are buckets.
    """
    groups = list(partition_by)
    per_bucket = bucketed.groupBy(*groups, "_bucket").agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    order = F.col("_bucket").desc() if backwards else F.col("_bucket").asc()
    ordered = W.partitionBy(*groups).orderBy(order)
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    crossing = per_bucket.select(
        *[F.col(g).alias(f"o_{g}") for g in groups],
        F.col("_bucket").alias("o_bucket"),
        F.row_number().over(ordered).alias("o_rank"),
        *[c.over(earlier).alias(name) for name, c in combine.items()],
    ).filter("o_rank > 1")
    on = F.col("_bucket") == F.col("o_bucket")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"o_{g}"))
    return bucketed.join(F.broadcast(crossing), on, "left").drop(
        "o_bucket", "o_rank", *[f"o_{g}" for g in groups]
    )


def bucket_window(partition_by: Sequence[str] = ()):
    """Window over one bucket's share of a group, in row order."""
    return W.partitionBy("_bucket", *partition_by).orderBy("_at")


def with_position(
    df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "pos", keep_bucket: bool = False
) -> DataFrame:
    """1-based row position inside each group, like ``row_number`` but distributed.

    Without groups a row's place in its bucket and the sizes of the buckets before it
    say where it is, so the stored rows are not shuffled again.
    """
    rows = range_buckets(df, order_by, partition_by)
    if partition_by:
        out = carry(rows, partition_by, {"_n": F.count(F.lit(1))}, {"_skip": F.sum("_n")})
        local = F.row_number().over(bucket_window(partition_by))
        placed = out.withColumn(name, (local + F.coalesce("_skip", F.lit(0))).cast("bigint")).drop("_skip")
    else:
        sizes = rows.groupBy(F.col("_bucket").alias("_b")).agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
        earlier = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)  # one row a bucket
        skips = sizes.select("_b", "_low", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_skip"))
        met = rows.join(F.broadcast(skips), F.col("_bucket") == F.col("_b"))
        placed = met.withColumn(name, F.col("_at") - F.col("_low") + F.col("_skip") + 1).drop("_b", "_low", "_skip")
    return placed if keep_bucket else placed.drop("_bucket", "_at")


def with_halo(rows: DataFrame, size: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """``range_buckets`` rows, each bucket's preceded by the ``size - 1`` rows before it in its group, one partition a bucket.

    Only these few rows are copied to another bucket (``_halo`` marks the copies); a window
    partitioned by bucket and group needs no further shuffle.
    """
    groups = list(partition_by)
    per = rows.groupBy("_bucket", *groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    in_group = W.partitionBy(*groups)
    upto = F.sum("_n").over(in_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0))
    runs = per.select("*", upto.alias("_end"), F.lead("_bucket").over(in_group.orderBy("_bucket")).alias("_to"))
    # the next bucket needs the rows of all buckets that end less than ``size - 1`` rows before it begins
    near = in_group.orderBy("_end").rangeBetween(-max(size - 2, 0), 0)
    sources = F.collect_list(F.struct("_bucket", "_first", "_n", "_end")).over(near)
    asked = runs.withColumn("_sources", sources).filter("_to is not null")
    asked = asked.select("_to", F.col("_end").alias("_begin"), *[F.col(g).alias(f"w_{g}") for g in groups], F.explode("_sources").alias("s"))
    skipped = F.col("s._n") - (size - 1) + (F.col("_begin") - F.col("s._end"))
    wanted = asked.select(F.col("s._bucket").alias("_of"), "_to", (F.col("s._first") + F.greatest(skipped, F.lit(0))).alias("_least"), *[f"w_{g}" for g in groups])
    # at most one group crosses each limit, so there are few more rows than buckets
    own = (F.col("_bucket") == F.col("_of")) & (F.col("_at") >= F.col("_least")) & _same_all(groups, "w_")
    halo = rows.join(F.broadcast(wanted), own).withColumn("_bucket", F.col("_to")).select(rows.columns)
    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo.withColumn("_halo", F.lit(True)))
    return both.repartitionById(parallelism(rows.sparkSession, MAX_ROW_BUCKETS), "_bucket")


def _same_all(groups: Sequence[str], prefix: str) -> Column:
    return _same(groups, prefix) if groups else F.lit(True)
