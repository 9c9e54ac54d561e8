"""Column profiles from mergeable sketches, one set of them per period.

A period's row for a column holds counts, extremes, mean and squared deviations, a KLL
sketch of its numbers and a HyperLogLog sketch of its values, all taken in one scan: only
sketches are shuffled, never values.  Rows of any periods merge into the profile of their
union, so a day's profile is taken once and never read again.

Counts, extremes, means and deviations are exact.  Quantiles are off by at most
``RANK_ERROR`` of the rows in rank (99 % confidence at the default size), distinct counts by
some ``1.04 / sqrt(2 ** lg_k)`` of their value (one standard deviation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reconkit.functions.dates import DAY_SECONDS, date_text
from reconkit.functions.missing import nan_to_null
from reconkit.operators.digests import canonical
from reconkit.operators.shaping import without_lineage

QUANTILE_K = 800  # items a KLL sketch keeps on its top level
RANK_ERROR = 0.01
LG_K = 12
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _parts(df: DataFrame, field: T.StructField, quantile_k: int, lg_k: int) -> dict[str, Column]:
    """Aggregates of one column that can be merged; those of other kinds are null."""
    c, t = F.col(field.name), field.dataType
    number, text, date = isinstance(t, T.NumericType), isinstance(t, T.StringType), isinstance(t, _DATES)
    none = lambda kind: F.lit(None).cast(kind)
    x, length = c.cast("double"), F.length(c) if text else None
    micros = F.unix_micros(c.cast("timestamp")) if date else None
    return {
        "row_count": F.count(F.lit(1)),
        "null_count": F.count_if(c.isNull()),
        "min_value": F.min(x) if number else none("double"),
        "max_value": F.max(x) if number else none("double"),
        "mean_value": F.avg(x) if number else none("double"),
        "squares": F.var_pop(x) * F.count(x) if number else none("double"),
        "min_length": F.min(length).cast("bigint") if text else none("bigint"),
        "max_length": F.max(length).cast("bigint") if text else none("bigint"),
        "total_length": F.sum(length.cast("bigint")) if text else none("bigint"),
        "min_micros": F.min(micros) if date else none("bigint"),
        "max_micros": F.max(micros) if date else none("bigint"),
        "quantiles": F.kll_sketch_agg_double(x, quantile_k) if number else none("binary"),
        # a null must not count as a value, so it has no hash
        "distinct": F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(canonical(df, field.name))), F.lit(lg_k)),
    }


def column_sketches(df: DataFrame, period: str | Column | None = None, quantile_k: int = QUANTILE_K, lg_k: int = LG_K) -> DataFrame:
    """``period, column_name, data_type`` and the mergeable parts of each column, one scan.

    ``period`` is a column or expression (null is a period too); without it all rows are one.
    Store the result: it is what later profiles are merged from.
    """
    clean = nan_to_null(without_lineage(df))
    fields = [f for f in clean.schema if isinstance(f.dataType, T.AtomicType)]
    when = F.lit(None).cast("string") if period is None else F.col(period) if isinstance(period, str) else period
    rows = clean.withColumn("_period", when)
    parts = {f.name: _parts(clean, f, quantile_k, lg_k) for f in fields}
    wide = rows.groupBy("_period").agg(*[e.alias(f"{p}__{i}") for i, f in enumerate(fields) for p, e in parts[f.name].items()])
    each = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(i).alias("position"),
            *[F.col(f"{p}__{i}").alias(p) for p in parts[f.name]],
        )
        for i, f in enumerate(fields)
    ]
    return wide.select(F.col("_period").alias("period"), F.inline(F.array(*each)))


def merge_sketches(sketches: DataFrame, quantile_k: int = QUANTILE_K) -> DataFrame:
    """One row per column for all periods in ``sketches``; filter them first for a part."""
    n = F.col("row_count") - F.col("null_count")
    weight = F.sum(n)
    mean = F.try_divide(F.sum(F.col("mean_value") * n), weight)
    spread = F.sum("squares") + F.sum(n * F.col("mean_value") * F.col("mean_value")) - weight * mean * mean
    return sketches.groupBy("column_name", "data_type", "position").agg(
        *[F.sum(c).alias(c) for c in ("row_count", "null_count", "total_length")],
        *[F.min(c).alias(c) for c in ("min_value", "min_length", "min_micros")],
        *[F.max(c).alias(c) for c in ("max_value", "max_length", "max_micros")],
        mean.alias("mean_value"),
        F.when(spread.isNotNull(), F.greatest(spread, F.lit(0.0))).alias("squares"),
        F.kll_merge_agg_double("quantiles", quantile_k).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def profile_from_sketches(merged: DataFrame, quantiles: Sequence[float] = ()) -> DataFrame:
    """The columns of ``column_profile`` from merged sketches; ``q<p>`` for each further quantile.

    ``unique_count`` and ``median_value`` are estimates.
    """
    known = F.col("row_count") - F.col("null_count")
    share = lambda c: F.try_divide(F.col(c) * 100.0, F.col("row_count"))

    def at(p: float) -> Column:
        return F.when(F.col("min_value").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))))

    def day(micros: str) -> Column:
        moment = F.timestamp_micros(micros)
        return F.when(F.col("data_type") == "date", date_text(F.to_date(moment))).otherwise(date_text(moment))

    out = merged.withColumn("unique_count", F.least(F.hll_sketch_estimate("distinct"), known))
    return out.orderBy("position").select(
        "column_name", "data_type", "row_count", "null_count", "min_value", "max_value", "mean_value",
        F.when(known > 1, F.sqrt(F.col("squares") / (known - 1))).alias("std_value"),
        "min_length", "max_length", F.try_divide(F.col("total_length").cast("double"), known).alias("avg_length"),
        day("min_micros").alias("min_date"), day("max_micros").alias("max_date"),
        F.floor((F.col("max_micros") / 1e6 - F.col("min_micros") / 1e6) / DAY_SECONDS).cast("bigint").alias("date_range_days"),
        "unique_count", at(0.5).alias("median_value"), share("null_count").alias("null_percentage"), share("unique_count").alias("unique_percentage"),
        *[at(p).alias(f"q{p:g}") for p in quantiles],
    )
