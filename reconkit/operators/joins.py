"""Equi-joins with null-safe keys, provenance and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def null_safe(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> Column:
    pairs = [left[a].eqNullSafe(right[b]) for a, b in zip(left_on, right_on)]
    return reduce(lambda a, b: a & b, pairs)


def merge(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on shared keys; each key appears once and null keys match each other."""
    by = list(by)
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in by})
    joined = left.join(other, null_safe(left, other, by, [f"_r_{k}" for k in by]), how)
    if how in ("left_semi", "left_anti"):
        return joined
    rest = [c for c in left.columns if c not in by]
    return joined.select(
        *[F.coalesce(left[k], other[f"_r_{k}"]).alias(k) for k in by],
        *[left[c] for c in rest],
        *[other[c] for c in right.columns if c not in by],
    )


def sql_join(
    left: DataFrame,
    right: DataFrame,
    how: str = "inner",
    on: Sequence[str] | None = None,
    left_on: Sequence[str] | None = None,
    right_on: Sequence[str] | None = None,
) -> DataFrame:
    """Join on ``on`` or on two key lists; overlapping names get ``_left``/``_right``."""
    as_list = lambda x: [x] if isinstance(x, str) else list(x)
    if on:
        keys = as_list(on)
        overlap = (set(left.columns) & set(right.columns)) - set(keys)
        left = left.withColumnsRenamed({c: f"{c}_left" for c in overlap})
        right = right.withColumnsRenamed({c: f"{c}_right" for c in overlap})
        return merge(left, right, keys, how)
    if not (left_on and right_on):
        raise ValueError("give join keys: on, or left_on and right_on")
    lk, rk = as_list(left_on), as_list(right_on)
    overlap = set(left.columns) & set(right.columns)
    left = left.withColumnsRenamed({c: f"{c}_left" for c in overlap})
    right = right.withColumnsRenamed({c: f"{c}_right" for c in overlap})
    lk = [f"{c}_left" if c in overlap else c for c in lk]
    rk = [f"{c}_right" if c in overlap else c for c in rk]
    return left.join(right, null_safe(left, right, lk, rk), how)


def outer_with_provenance(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Full outer join with ``_merge``: both, left_only or right_only."""
    joined = merge(left.withColumn("_l", F.lit(True)), right.withColumn("_r", F.lit(True)), by, "full_outer")
    side = (
        F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    )
    return joined.withColumn("_merge", side).drop("_l", "_r")


def mapping_lookup(df: DataFrame, mapping: DataFrame, source_column: str) -> DataFrame:
    """Attach ``target_name`` from a (source_name, target_name) table, null when unmapped."""
    return df.join(mapping.select("source_name", "target_name"), F.col(source_column) == F.col("source_name"), "left").drop("source_name")


def unmapped(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source columns without a target name; target columns no source refers to.

    ``source``: (column_name, target_name, ...); ``target``: (column_name, ...).
    """
    free_source = source.filter(F.col("target_name").isNull())
    used = source.select("target_name").filter("target_name IS NOT NULL").distinct()
    free_target = target.join(used, target["column_name"] == used["target_name"], "left_anti")
    return free_source, free_target
