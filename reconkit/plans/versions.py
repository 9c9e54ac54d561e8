"""Stored table versions that compare by digests, so that only changed key ranges are read again.

A version is a folder with its rows, ordered by key range; the digests of the ranges, and
those of the nodes above them; the digests of its columns; and one row of facts.  Versions that are to be compared share their range boundaries: the second one is
written ``like`` the first.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from reconkit.operators.digests import FANOUT, LANES, boundaries, canonical, column_digests, leaf_digests, levels, parents, with_leaf
from reconkit.operators.records import TOLERANCE, difference_rows, match_records, value_differences
from reconkit.plans.align import column_multiset_compare
from reconkit.session import local_rows

LEAVES = 4096
PAGE_ROWS = 1000  # rows of a Parquet page, the least that a range read takes
MAX_INTERVALS = 256  # of a pushed filter; more changed ranges are joined with their wider parents
_COMPARED = ("rows", *LANES)


def write_version(
    df: DataFrame, path: str, keys: Sequence[str], leaves: int = LEAVES, like: str | None = None, page_rows: int = PAGE_ROWS
) -> str:
    """Store ``df`` with its digests; boundaries come from the version ``like``, else from ``df``.

    One shuffle orders the rows by range; digests are taken from what was written.  ``keys``
    must be the same for all versions that are compared.
    """
    spark, keys = df.sparkSession, list(keys)
    if like:
        facts = spark.read.parquet(os.path.join(like, "facts"))
        row = facts.select("keys", "leaves").first()
        if list(row["keys"]) != keys:
            raise ValueError(f"keys of {like} are {list(row['keys'])}")
        leaves = row["leaves"]
    else:
        facts = boundaries(df, keys[0], leaves).select(F.array(*[F.lit(k) for k in keys]).alias("keys"), F.lit(leaves).alias("leaves"), "bounds")
    facts.coalesce(1).write.parquet(os.path.join(path, "facts"))
    bounds = spark.read.parquet(os.path.join(path, "facts")).select("bounds")
    ranged = with_leaf(df, keys, bounds, leaves)
    # the hash lets a range with very many rows go to several tasks
    spread = F.xxhash64(*[canonical(df, c) for c in df.columns])
    ordered = ranged.withColumn("_spread", spread).repartitionByRange("_leaf", "_spread").sortWithinPartitions("_leaf").drop("_spread")
    ordered.write.option("parquet.page.row.count.limit", page_rows).parquet(os.path.join(path, "rows"))
    rows = spark.read.parquet(os.path.join(path, "rows"))
    column_digests(rows).coalesce(1).write.parquet(os.path.join(path, "columns"))
    depth = levels(leaves)
    leaf_digests(rows, keys).withColumn("level", F.lit(depth)).write.parquet(os.path.join(path, "digests"))
    nodes, above = _level(spark, path, depth), []
    for level in reversed(range(depth)):
        nodes = parents(nodes)
        above.append(nodes.withColumn("level", F.lit(level)))
    upper = reduce(DataFrame.unionByName, above).coalesce(1)  # a fifteenth of the ranges
    upper.write.parquet(os.path.join(path, "upper"))
    return path


def _level(spark: SparkSession, path: str, level: int, depth: int | None = None) -> DataFrame:
    """Digests of one level; the leaves are a table of their own."""
    name = "digests" if depth in (None, level) else "upper"
    return spark.read.parquet(os.path.join(path, name)).filter(F.col("level") == level).drop("level")


def _leaves(spark: SparkSession, path: str, other: str) -> int:
    a, b = (spark.read.parquet(os.path.join(p, "facts")) for p in (path, other))
    if not a.exceptAll(b).isEmpty():
        raise ValueError("versions with different key ranges; write one like the other")
    return a.select("leaves").first()[0]


def changed_ranges(spark: SparkSession, source: str, target: str) -> DataFrame:
    """``node, source_rows, target_rows`` of the key ranges whose digests differ.

    Top down: of each level only the children of differing nodes are compared.  A table has
    as many ranges as were asked for, whatever its size, so the lists are small.
    """
    depth = levels(_leaves(spark, source, target))
    found, above = None, None
    for level in range(depth + 1):
        sides = []
        for path, side in ((source, "source"), (target, "target")):
            nodes = _level(spark, path, level, depth)
            if above is not None:
                nodes = nodes.filter(F.floor(F.col("node") / FANOUT).isin(above)) if len(above) <= MAX_INTERVALS else nodes
            sides.append(nodes.select("node", *[F.col(c).alias(f"{side}_{c}") for c in _COMPARED]))
        unlike = reduce(lambda a, b: a | b, [~F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}")) for c in _COMPARED])
        found = sides[0].join(sides[1], "node", "full").filter(unlike)
        if level < depth:
            above = [r[0] for r in found.select("node").collect()]
    zero = F.lit(0).cast("bigint")
    return found.select("node", *[F.coalesce(f"{s}_rows", zero).alias(f"{s}_rows") for s in ("source", "target")])


def intervals(nodes: Sequence[int], most: int = MAX_INTERVALS) -> list[tuple[int, int]]:
    """Runs of neighbouring ranges; the narrowest gaps are closed until at most ``most`` runs are left."""
    nodes = sorted(nodes)
    cuts = [i for i in range(1, len(nodes)) if nodes[i] > nodes[i - 1] + 1]
    cuts = sorted(sorted(cuts, key=lambda i: nodes[i - 1] - nodes[i])[: most - 1])
    return [(nodes[a], nodes[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(nodes)])] if nodes else []


def rows_in(spark: SparkSession, path: str, runs: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of a version in these runs of ranges; the filter reaches the Parquet pages."""
    rows = spark.read.parquet(os.path.join(path, "rows"))
    inside = [F.col("_leaf").between(a, b) for a, b in runs]
    return rows.filter(reduce(lambda a, b: a | b, inside) if inside else F.lit(False)).drop("_leaf")


def _to_read(spark: SparkSession, source: str, target: str, repeats: bool) -> tuple[list[tuple[int, int]], int]:
    """Runs of ranges to read, and the key-equal pairs of all others."""
    depth = levels(_leaves(spark, source, target))
    nodes = _level(spark, source, depth)
    changed = {r[0] for r in changed_ranges(spark, source, target).select("node").collect()}  # at most one a range
    if repeats:
        changed |= {r[0] for r in nodes.filter("repeated > 0").select("node").collect()}
    runs = intervals(list(changed))
    inside = [F.col("node").between(a, b) for a, b in runs]
    rest = nodes.filter(~reduce(lambda a, b: a | b, inside)) if inside else nodes
    return runs, rest.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]


def value_differences_by_digest(
    spark: SparkSession, source: str, target: str, columns: Sequence[str] | None = None, tolerance: float = TOLERANCE
) -> DataFrame:
    """``value_differences`` of two stored versions, from the changed key ranges alone.

    Ranges with repeated keys are read as well: their rows form pairs among unequal
    copies even where both sides are the same.
    """
    keys = list(spark.read.parquet(os.path.join(source, "facts")).select("keys").first()[0])
    runs, pairs = _to_read(spark, source, target, True)
    found = value_differences(rows_in(spark, source, runs), rows_in(spark, target, runs), keys, columns, tolerance)
    return found.withColumn("compared", F.col("compared") + F.lit(pairs).cast("bigint"))


def difference_rows_by_digest(
    spark: SparkSession, source: str, target: str, columns: Sequence[str] | None = None, tolerance: float = TOLERANCE
) -> DataFrame:
    """``difference_rows`` of two stored versions, from the changed key ranges alone."""
    keys = list(spark.read.parquet(os.path.join(source, "facts")).select("keys").first()[0])
    runs, _ = _to_read(spark, source, target, True)
    return difference_rows(rows_in(spark, source, runs), rows_in(spark, target, runs), keys, columns, tolerance)


def unmatched_records_by_digest(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Keys (with ``s_rows, t_rows``) that the two versions hold unequally often."""
    keys = list(spark.read.parquet(os.path.join(source, "facts")).select("keys").first()[0])
    runs, _ = _to_read(spark, source, target, False)
    return match_records(rows_in(spark, source, runs), rows_in(spark, target, runs), keys).filter("s_rows <> t_rows")


def column_compare_by_digest(spark: SparkSession, source: str, target: str) -> DataFrame:
    """``column_multiset_compare`` of two versions; columns with equal digests are not read."""
    a, b = (spark.read.parquet(os.path.join(p, "columns")) for p in (source, target))
    both = a.alias("a").join(b.alias("b"), "column_name").collect()  # one row a column
    at = {r["column_name"]: r for r in both}
    same = {c: r for c, r in at.items() if all(r[i] == r[i + len(LANES) + 2] for i in range(2, 3 + len(LANES)))}
    rows = [(c, r[2], r[2], r[1] == r[len(LANES) + 3], r[1] == r[len(LANES) + 3], 0) for c, r in same.items()]
    known = local_rows(spark, rows, "column_name string, source_values bigint, target_values bigint, type_match boolean, values_match boolean, unequal bigint")
    left = [c for c in at if c not in same]
    if not left:
        return known
    read = lambda p: spark.read.parquet(os.path.join(p, "rows")).select(*left)
    return known.unionByName(column_multiset_compare(read(source), read(target)))
