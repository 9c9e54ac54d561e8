"""Exact quantiles over any number of rows and groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from reconkit.operators.cumulative import cumulative


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, value double) with nulls and NaN dropped."""
    cells = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return cells.unpivot(list(by), list(columns), "variable", "value").filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Mapping[str, float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolated quantiles, one row per (by..., variable).

    ``percentile`` holds every distinct value of a group in one task; here the
    distinct values are ranked in range buckets and only the two neighbours of
    each requested rank are kept.
    """
    long = long_values(df, columns, by)
    if by:
        long = long.dropna(subset=list(by))
    counts = long.groupBy(*by, "variable", "value").agg(F.count(F.lit(1)).alias("n"))
    return quantiles_of_counts(counts, probs, by)


def quantiles_of_counts(counts: DataFrame, probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles from (by..., variable, value, n)."""
    keys = [*by, "variable"]
    ranked = cumulative(counts, "value", ["n"], groups=keys)
    picks = []
    for name, p in probs.items():
        at = (F.col("total_n") - 1) * F.lit(float(p))
        for part, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("before_n") <= rank) & (rank < F.col("before_n") + F.col("n"))
            picks.append(F.max(F.when(hit, F.col("value"))).alias(f"{name}_{part}"))
        picks.append(F.max(at - F.floor(at)).alias(f"{name}_w"))
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_w")).alias(n)
            for n in probs
        ],
    )
