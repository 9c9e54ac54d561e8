"""Sorting, limits, top-n, samples and listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reconkit.operators.cumulative import with_position

TAKEN_ROWS = 10_000  # rows that a task may hold in order; Spark sets room aside for all rows of a limit


def sort_keys(by: Sequence[str], ascending: bool | Sequence[bool] = True) -> list[Column]:
    """Sort columns with nulls last in either direction."""
    flags = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    if len(flags) != len(by):
        raise ValueError("one direction per sort key")
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in zip(by, flags)]


def proc_sort(df: DataFrame, by: Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    return df.orderBy(*sort_keys(by, ascending))


def sort_nodupkey(
    df: DataFrame, by: Sequence[str], tie_break: Sequence[str], ascending: bool | Sequence[bool] = True
) -> DataFrame:
    """First row per key in ``tie_break`` order.

    Spark cuts each map task to one row per key before the shuffle, so a hot key
    costs no more than the others.
    """
    w = W.partitionBy(*by).orderBy(*sort_keys(tie_break))
    firsts = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return proc_sort(firsts, by, ascending)


def order_by_text(df: DataFrame, order_by: str | Sequence[str]) -> DataFrame:
    """``"col DESC"`` texts to sort keys."""
    keys, flags = [], []
    for item in [order_by] if isinstance(order_by, str) else order_by:
        for part in item.split(","):
            words = part.split()
            if words[0] not in df.columns:
                raise ValueError(f"unknown column {words[0]}")
            keys.append(words[0])
            flags.append(len(words) < 2 or words[1].upper() != "DESC")
    return proc_sort(df, keys, flags)


def top_n(df: DataFrame, by: Sequence[str], n: int, largest: bool = True) -> DataFrame:
    """n largest or smallest rows; null values are left out.  End ``by`` in a unique column."""
    present = df.filter(F.col(by[0]).isNotNull())
    return present.orderBy(*sort_keys(by, [not largest] + [True] * (len(by) - 1))).limit(n)


def first_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First n rows of every group; end ``order`` in a unique column, or ties are cut at will.

    Up to Spark's group-limit threshold the rows are cut inside each map task
    before the shuffle; above it, positions are counted in range buckets.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        return with_position(df, order, by, "_rn").filter(F.col("_rn") <= n).drop("_rn")
    w = W.partitionBy(*by).orderBy(*sort_keys(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def sample_n(df: DataFrame, n: int, seed: int, key: Sequence[str]) -> DataFrame:
    """n rows in the order of a seeded digest of the key; the same rows on every run.

    Beyond ``TAKEN_ROWS`` the rows come in any order.  They are not sorted: counts per head of
    the digest tell which heads are taken whole, and only the rows of the next one are ranked.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    if n <= TAKEN_ROWS:
        return df.orderBy(digest, *[F.col(k) for k in key]).limit(n)
    marked = df.withColumns({"_digest": digest, "_head": F.substring(digest, 1, 4)})
    left = n
    for head, size in sorted(marked.groupBy("_head").count().collect()):  # 65 536 rows at most
        if size > left:
            last = with_position(marked.filter(F.col("_head") == head), ["_digest", *key], name="_pos")
            whole = marked.filter(F.col("_head") < head)
            return whole.unionByName(last.filter(F.col("_pos") <= left).drop("_pos")).drop("_digest", "_head")
        left -= size
    return df


def row_range(df: DataFrame, order: Sequence[str], start: int, end: int) -> DataFrame:
    """Rows start..end (1-based, inclusive) in the given order, which should end in a unique column.

    Positions are counted in range buckets, so no task sees the rows before ``start``.
    """
    return with_position(df, order, name="_pos").filter(F.col("_pos").between(start, end)).drop("_pos")


def listing(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    obs: int | None = None,
    where: str | None = None,
    by: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """where, then columns, then the first ``obs`` rows (of each group when ``by`` is given)."""
    if where:
        df = df.filter(where)
    if obs is not None:
        df = first_n_per_group(df, by, order, obs) if by else df.orderBy(*sort_keys(order)).limit(obs)
    return df.select(*columns) if columns else df
