"""Long/wide reshaping, list expansion and time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reconkit.operators.cumulative import with_position
from reconkit.operators.shaping import numeric_columns


def transpose_long(df: DataFrame, by: Sequence[str], variables: Sequence[str] | None = None) -> DataFrame:
    """One row per (by, variable): ``_NAME_`` and ``_VALUE_``."""
    names = list(variables) if variables else [c for c in numeric_columns(df) if c not in by]
    return df.unpivot(list(by), names, "_NAME_", "_VALUE_")


def transpose_wide(
    df: DataFrame,
    by: Sequence[str],
    id_var: str,
    value: str,
    ids: Sequence | None = None,
    prefix: str = "COL",
    fill: float = 0.0,
) -> DataFrame:
    """One column per id, mean per cell.  Pass ``ids`` to save a pass over the data."""
    wide = df.groupBy(*by).pivot(id_var, list(ids) if ids else None).agg(F.avg(value))
    cells = [c for c in wide.columns if c not in by]
    return wide.na.fill(fill, cells).withColumnsRenamed({c: f"{prefix}{c}" for c in cells})


def transpose_full(df: DataFrame, index: str, values: Sequence | None = None) -> DataFrame:
    """Rows to columns: ``key`` (the old column) and one column per index value.

    Pass ``values`` to save a pass over the index; repeated index values are an error,
    as is a number of values above ``spark.sql.pivotMaxValues``.
    """
    cells = [c for c in df.columns if c != index]
    mixed = len({f.dataType for f in df.schema if f.name != index}) > 1
    rows = df.select(F.col(index).cast("string").alias(index), *[F.col(c).cast("string").alias(c) if mixed else F.col(c) for c in cells])
    long = rows.unpivot([index], cells, "key", "_v")
    once = F.when(F.count(F.lit(1)) <= 1, F.first("_v")).otherwise(F.raise_error(F.lit(f"{index} repeats a value")))
    return long.groupBy("key").pivot(index, [str(v) for v in values] if values else None).agg(once)


def transpose_blocks(df: DataFrame, index: str, width: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Rows to columns for any number of rows, as blocks of at most ``width`` columns.

    Returns (cells, labels).  ``cells`` has ``key`` (the old column), ``block`` and ``values``, an
    array with the block's new columns in order of ``index``; ``labels`` has the index values
    of each block.  A cell group is one old column of one block, so no task holds a whole
    row of the result.  Values of different types become text; nulls of ``index`` come last;
    repeated index values keep a column each.
    """
    if width < 1:
        raise ValueError("a block has at least one column")
    cells = [c for c in df.columns if c != index]
    mixed = len({f.dataType for f in df.schema if f.name != index}) > 1
    placed = with_position(df, [index], name="_pos")
    at = F.col("_pos") - 1
    placed = placed.withColumns({"block": F.floor(at / width), "_slot": (at % width).cast("int")})

    def in_order(value: str) -> Column:
        listed = F.array_sort(F.collect_list(F.struct("_slot", F.struct(F.col(value).alias("v")).alias("c"))))
        return F.transform(listed, lambda x: x["c"]["v"])

    labels = placed.groupBy("block").agg(in_order(index).alias("labels"))
    if mixed:
        placed = placed.withColumns({c: F.col(c).cast("string") for c in cells})
    long = placed.unpivot(["block", "_slot"], cells, "key", "_v")
    return long.groupBy("key", "block").agg(in_order("_v").alias("values")), labels


def block_table(cells: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """One block of ``transpose_blocks`` as a table: ``key`` and a column for each index value (a repeated one gets a number)."""
    names, seen = [], {}
    for label in labels.filter(F.col("block") == block).first()["labels"]:  # at most a block's width
        name = str(label)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    mine = cells.filter(F.col("block") == block)
    return mine.select("key", *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(names)])


def pivot_sum(df: DataFrame, by: Sequence[str], columns: str, value: str, values: Sequence) -> DataFrame:
    return df.groupBy(*by).pivot(columns, list(values)).agg(F.sum(value))


def explode_list(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One row per list element; an empty or null list keeps one null row."""
    return df.withColumn(name or column, F.explode_outer(column))


def stack(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.unpivot(list(by), list(columns), "level", "value")


def unstack(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Back to one row per ``by``; each (by, level) must hold one value."""
    return df.groupBy(*by).pivot("level", list(columns)).agg(F.first("value"))


def resample_days(df: DataFrame, ts: str, value: str, days: int) -> DataFrame:
    """Sum per fixed bucket of ``days`` days, starting at the first day present."""
    first = df.agg(F.to_date(F.min(ts)).alias("d")).scalar()
    day = F.to_date(ts)
    index = F.floor(F.datediff(day, F.col("_first")) / F.lit(days)).cast("int")
    return (
        df.withColumn("_first", first)
        .groupBy(F.date_add(F.col("_first"), index * days).alias("bucket_start"))
        .agg(F.sum(value).alias(f"sum_{value}"), F.count(F.lit(1)).alias("n"))
    )
