"""Per-date row counts: histograms, differences and the mismatch matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reconkit.functions.dates import date_text
from reconkit.functions.text import SEPARATOR, joined_list, split_trim_list
from reconkit.operators.joins import merge


def date_histogram(df: DataFrame, date_column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., date text, n_rows)."""
    counted = df.groupBy(*by, F.to_date(date_column).alias("date")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("date", date_text(F.col("date")))


def temporal_differences(source: DataFrame, target: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Dates whose counts differ or that only one side has.

    Inputs are histograms (by..., date, n_rows).  Output: (by..., date, source_n,
    target_n), a count being null where the side lacks the date.
    """
    a = source.withColumnRenamed("n_rows", "source_n")
    b = target.withColumnRenamed("n_rows", "target_n")
    both = merge(a, b, [*by, "date"], "full_outer")
    return both.filter(~F.col("source_n").eqNullSafe(F.col("target_n")))


def temporal_summary(differences: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mismatched dates as one sorted list per group."""
    return differences.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_dates"), joined_list(F.col("date"), SEPARATOR).alias("mismatched_date")
    )


def listed_dates(tables: DataFrame) -> DataFrame:
    """Distinct valid dates of the ``mismatched_date`` lists, as ``yyyy-MM-dd``."""
    text = F.explode(split_trim_list(F.col("mismatched_date")))
    return tables.select(text.alias("t")).select(_as_date(F.col("t")).alias("date")).filter("date IS NOT NULL").distinct()


def _as_date(text):
    return date_text(F.regexp_replace(text, "/", "-").try_cast("date"))


def mismatch_cells(tables: DataFrame, counts: DataFrame) -> DataFrame:
    """(tbl, date, label) for the listed dates where the two sides' counts differ.

    ``counts``: (tbl, side, date, n) with side ``source`` or ``target``; several
    rows for one date add up.  A date absent on one side counts 0; a table absent
    on one side has no mismatch.
    """
    dates = listed_dates(tables).withColumnRenamed("date", "day")
    days = counts.withColumn("day", _as_date(F.col("date").cast("string")))
    n = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n").try_cast("bigint"))), F.lit(0))
    present = days.groupBy("tbl").agg(F.count_distinct("side").alias("sides")).filter("sides = 2").select("tbl")
    cells = (
        days.join(dates, "day", "left_semi")
        .groupBy("tbl", "day")
        .agg(n("source").alias("s"), n("target").alias("t"))
        .filter("s <> t")
    )
    known = tables.select("tbl").distinct().join(present, "tbl", "left_semi")
    return cells.join(known, "tbl", "left_semi").select(
        "tbl", F.col("day").alias("date"), F.format_string("Yes (%d : %d)", "s", "t").alias("label")
    )


def mismatch_matrix(tables: DataFrame, counts: DataFrame, dates: Sequence[str] | None = None) -> DataFrame:
    """One row per listed table, one column per listed date, ``No`` or ``Yes (s : t)``.

    Only differing cells are computed and pivoted; all others are filled with ``No``.
    """
    if dates is None:
        dates = [r.date for r in listed_dates(tables).orderBy("date").collect()]  # the report's header
    wide = mismatch_cells(tables, counts).groupBy("tbl").pivot("date", list(dates)).agg(F.first("label"))
    return tables.select("tbl").join(wide, "tbl", "left").na.fill("No", list(dates))
