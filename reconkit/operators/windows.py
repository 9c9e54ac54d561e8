"""Window-style operators that stay distributed when one group is very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from reconkit.operators.cumulative import bucket_window, carry, cumulative, range_buckets, with_halo, with_position
from reconkit.operators.quantiles import exact_quantiles


def pct_of_group(df: DataFrame, by: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """value / group sum.  Sums are pre-aggregated and joined back."""
    sums = df.dropna(subset=list(by)).groupBy(*by).agg(F.sum(value).alias("_sum"))
    share = F.col(value) / F.nullif(F.col("_sum"), F.lit(0))
    return df.join(sums, list(by)).withColumn(name, share).drop("_sum")


def rolling_mean(
    df: DataFrame, value: str, size: int, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "rolling"
) -> DataFrame:
    """Mean of the last ``size`` rows, null until ``size`` values are there.

    Rows stay in the range that holds them; only the last ``size - 1`` rows before a range
    limit are copied across it.
    """
    if size < 1:
        raise ValueError("window size must be positive")
    rows = with_halo(range_buckets(df, order_by, partition_by), size, partition_by)
    w = bucket_window(partition_by).rowsBetween(1 - size, 0)
    mean = F.when(F.count(value).over(w) == size, F.avg(value).over(w))
    return rows.withColumn(name, mean).filter("not _halo").drop("_halo", "_bucket", "_at")


def expanding_sum(
    df: DataFrame, value: str, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "running"
) -> DataFrame:
    """Running sum in row order."""
    rows = carry(range_buckets(df, order_by, partition_by), partition_by, {"_s": F.sum(value)}, {"_earlier": F.sum("_s")})
    upto = bucket_window(partition_by).rowsBetween(W.unboundedPreceding, 0)
    inside = F.sum(value).over(upto)
    total = F.when(
        inside.isNotNull() | F.col("_earlier").isNotNull(),
        F.coalesce(inside, F.lit(0)) + F.coalesce("_earlier", F.lit(0)),
    )
    return rows.withColumn(name, total).drop("_earlier", "_bucket", "_at")


def rank_min(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Competition rank of the non-null values in their own type; nulls and NaN stay unranked."""
    order = "_x"
    fractional = isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))
    present = df.withColumn(order, F.when(~F.isnan(value), F.col(value)) if fractional else F.col(value))
    counts = present.dropna(subset=[order, *by]).groupBy(*by, order).agg(F.count(F.lit(1)).alias("n"))
    ranks = cumulative(counts, order, ["n"], groups=by).select(
        *by, order, (F.col("before_n") + 1).cast("bigint").alias(name)
    )
    return present.join(ranks, [*by, order], "left").drop(order)


def zscore(df: DataFrame, value: str, name: str = "zscore") -> DataFrame:
    """(x - mean) / sample deviation, from one aggregate row."""
    stats = df.agg(F.struct(F.avg(value).alias("m"), F.stddev_samp(value).alias("s")).alias("_z")).scalar()
    z = (F.col(value) - F.col("_z.m")) / F.nullif(F.col("_z.s"), F.lit(0.0))
    return df.withColumn("_z", stats).withColumn(name, z).drop("_z")


def interpolate_linear(
    df: DataFrame, value: str, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "filled"
) -> DataFrame:
    """Fill nulls linearly by row position; trailing nulls repeat, leading stay null."""
    placed = with_position(df, order_by, partition_by, "_pos", keep_bucket=True)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(value).cast("double").alias("v")))
    rows = carry(placed.withColumn("_known", known), partition_by, {"_l": F.max("_known")}, {"_before": F.max("_l")})
    rows = carry(rows, partition_by, {"_f": F.min("_known")}, {"_after": F.min("_f")}, backwards=True)
    # Both frames grow from the bucket's edge; a frame that shrinks costs quadratic time.
    forward = W.partitionBy("_bucket", *partition_by).orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    backward = W.partitionBy("_bucket", *partition_by).orderBy(F.col("_pos").desc()).rowsBetween(W.unboundedPreceding, 0)
    left = F.coalesce(F.last("_known", True).over(forward), F.col("_before"))
    right = F.coalesce(F.last("_known", True).over(backward), F.col("_after"))
    rows = rows.withColumns({"_left": left, "_right": right})
    slope = (F.col("_right.v") - F.col("_left.v")) / (F.col("_right.p") - F.col("_left.p"))
    between = F.col("_left.v") + slope * (F.col("_pos") - F.col("_left.p"))
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value).cast("double"))
        .when(F.col("_left").isNull(), F.lit(None).cast("double"))
        .when(F.col("_right").isNull(), F.col("_left.v"))
        .otherwise(between)
    )
    return rows.withColumn(name, filled).drop(
        "_pos", "_known", "_before", "_after", "_left", "_right", "_bucket", "_at"
    )


def factorize(df: DataFrame, value: str, order: str, name: str = "code") -> DataFrame:
    """0-based code by first appearance in ``order``; null gets -1."""
    firsts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("_first"))
    codes = with_position(firsts, ["_first"], name="_pos").select(value, (F.col("_pos") - 1).alias(name))
    return df.join(codes, value, "left").fillna({name: -1})


def qcut(df: DataFrame, value: str, labels: Sequence[str], name: str = "quantile_bin") -> DataFrame:
    """Right-closed bins between exact quantiles; ties share a bin."""
    q = len(labels)
    probs = {f"e{i}": i / q for i in range(q + 1)}
    found = exact_quantiles(df, [value], probs)
    edges = found.agg(F.first(F.array(*probs)).alias("_e")).scalar()  # one variable, one row
    x, e = F.col(value), F.col("_e")
    label: Column = F.lit(None).cast("string")
    for i in reversed(range(q)):
        low = (x >= e[0]) if i == 0 else (x > e[i])
        label = F.when(low & (x <= e[i + 1]), F.lit(labels[i])).otherwise(label)
    return df.withColumn("_e", edges).withColumn(name, label).drop("_e")
