"""Alignment of both sides before the value comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from reconkit.functions.missing import nan_to_null
from reconkit.functions.text import split_trim_list
from reconkit.operators.cumulative import cumulative
from reconkit.operators.records import apart, both_sides
from reconkit.session import checkpointed
from reconkit.sources.scan import cutoff_filter

# Relative and absolute tolerance of aligned numbers.
RTOL, ATOL = 1e-5, 1e-8


def aligned_columns(mapping: Mapping[str, str], mismatched: Sequence[str]) -> dict[str, str]:
    """Mapped columns whose target is not known to differ."""
    return {s: t for s, t in mapping.items() if t and t not in set(mismatched)}


def excluded_dates(report: DataFrame, tbl: str) -> DataFrame:
    """(date) rows of a table's mismatched-date list."""
    mine = report.filter(F.col("tbl") == tbl)
    return mine.select(F.explode(split_trim_list(F.col("mismatched_date"))).alias("date")).distinct()


def exclude_dates(df: DataFrame, date_column: str, dates: DataFrame) -> DataFrame:
    """Drop rows of the listed business dates; rows without a date stay."""
    excluded = dates.select(F.col("date").try_cast("date").alias("_day"))
    return df.join(excluded, F.to_date(date_column) == F.col("_day"), "left_anti")


def load_aligned(
    df: DataFrame,
    columns: Sequence[str],
    cutoff: datetime | None = None,
    date_column: str | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Cutoff, date exclusion and aligned columns of one side."""
    out = cutoff_filter(df, cutoff)
    if dates is not None:
        out = exclude_dates(out, date_column, dates)
    return out.select(*columns)


def column_multiset_compare(source: DataFrame, target: DataFrame) -> DataFrame:
    """Whether each common column holds the same sorted values on both sides.

    Output: (column_name, source_values, target_values, type_match, values_match,
    unequal), where ``unequal`` counts distinct value pairs at equal rank that
    are too far apart, or values whose counts differ.  NaN counts as null.
    """
    source, target = nan_to_null(source), nan_to_null(target)
    left = {f.name: f.dataType for f in source.schema}
    common = [f for f in target.schema if f.name in left]
    numbers = [f.name for f in common if isinstance(f.dataType, T.NumericType) and isinstance(left[f.name], T.NumericType)]
    others = [f.name for f in common if f.name not in numbers]
    parts = []
    if others:
        parts.append(_exact_compare(source, target, others))
    if numbers:
        parts.append(_numeric_compare(source, target, numbers))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    kinds = F.create_map(*[x for f in common for x in (F.lit(f.name), F.lit(f.dataType == left[f.name]))])
    type_match = F.element_at(kinds, F.col("column_name"))
    same = type_match & (F.col("source_values") == F.col("target_values")) & (F.col("unequal") == 0)
    return found.withColumns({"type_match": type_match, "values_match": same}).select(
        "column_name", "source_values", "target_values", "type_match", "values_match", "unequal"
    )


def _value_counts(source: DataFrame, target: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    rows = both_sides(
        source.select(*[F.col(c).cast(cast).alias(c) for c in columns]),
        target.select(*[F.col(c).cast(cast).alias(c) for c in columns]),
        columns,
    )
    long = rows.unpivot(["_s", "_t"], list(columns), "column_name", "v")
    return long.groupBy("column_name", "v").agg(F.sum("_s").alias("s"), F.sum("_t").alias("t"))


def _exact_compare(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _value_counts(source, target, columns, "string").groupBy("column_name").agg(
        F.sum("s").alias("source_values"),
        F.sum("t").alias("target_values"),
        F.count_if(F.col("s") != F.col("t")).alias("unequal"),
    )


def _rows_and_nulls(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    """(column_name, <side>_values, <side>_nulls) in one scan."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = wide.unpivot(["_n"], list(columns), "column_name", f"{side}_nulls")
    return long.withColumnRenamed("_n", f"{side}_values")


def _numeric_compare(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pair the k-th smallest values of both sides without sorting in one place.

    A value that starts at rank r keeps that rank until the next start on its
    side.  Stacking the starts of both sides in rank order, the value in force on
    either side is the largest one started so far, as values grow with rank.
    Nulls pair with nulls, so only their numbers are compared.
    """
    totals = _rows_and_nulls(source, columns, "source").join(_rows_and_nulls(target, columns, "target"), "column_name")
    counts = _value_counts(source, target, columns, "double").filter("v IS NOT NULL")
    ranked = cumulative(counts, "v", ["s", "t"], groups=["column_name"])
    none = F.lit(None).cast("double")
    start = lambda n, rank, sv, tv: F.struct(
        F.when(F.col(n) > 0, F.col(rank)).alias("rank"), sv.alias("sv"), tv.alias("tv")
    )
    both = F.array(start("s", "before_s", F.col("v"), none), start("t", "before_t", none, F.col("v")))
    starts = ranked.select("column_name", F.inline(both)).filter("rank IS NOT NULL")
    by_rank = starts.groupBy("column_name", "rank").agg(F.max("sv").alias("sv"), F.max("tv").alias("tv"))
    # Stored, or the second pass over ranks would carry the whole first one in each of its branches.
    filled = cumulative(checkpointed(by_rank), "rank", maxima=["sv", "tv"], groups=["column_name"])
    a, b = F.col("upto_sv"), F.col("upto_tv")
    far = apart(a, b, F.greatest(F.lit(RTOL) * F.greatest(F.abs(a), F.abs(b)), F.lit(ATOL)))
    gaps = filled.groupBy("column_name").agg(F.count_if(far).alias("gaps"))
    null_gap = F.abs(F.col("source_nulls") - F.col("target_nulls"))
    return totals.join(gaps, "column_name", "left").select(
        "column_name", "source_values", "target_values", (F.coalesce("gaps", F.lit(0)) + null_gap).alias("unequal")
    )


def alignment_summary(compared: DataFrame) -> DataFrame:
    """Share of the compared columns whose values agree."""
    n, ok = F.count(F.lit(1)), F.count_if("values_match")
    return compared.agg(
        n.alias("common_columns"),
        ok.alias("matching_columns"),
        F.coalesce(F.try_divide(ok * 100.0, n), F.lit(0.0)).alias("match_percentage"),
        F.max(F.col("source_values") == F.col("target_values")).alias("row_count_match"),
    )


@dataclass
class Alignment:
    status: str
    reason: str | None = None
    columns: DataFrame | None = None
    summary: DataFrame | None = None


def align_and_compare(
    source: DataFrame,
    target: DataFrame,
    mapping: Mapping[str, str],
    mismatched: Sequence[str] = (),
    cutoff: datetime | None = None,
    date_column: str | None = None,
    dates: DataFrame | None = None,
) -> Alignment:
    """Drop differing columns and dates, then compare the remaining values.

    ``mapping`` goes from source to target names; ``date_column`` is the target name.
    """
    kept = aligned_columns(mapping, mismatched)
    if not kept:
        return Alignment("failed", "No aligned columns found")
    if dates is not None:
        dates = checkpointed(dates)  # a list of days, used by every scan below
    renamed = source.withColumnsRenamed(dict(mapping))
    a = load_aligned(renamed, list(kept.values()), cutoff, date_column, dates)
    b = load_aligned(target, list(kept.values()), cutoff, date_column, dates)
    if a.isEmpty() or b.isEmpty():
        return Alignment("failed", "Empty datasets after alignment")
    compared = checkpointed(column_multiset_compare(a, b))  # one row per column
    return Alignment("success", None, compared, alignment_summary(compared))
