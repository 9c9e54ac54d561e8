"""Column profiles and their comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reconkit.functions.dates import DAY_SECONDS, date_text
from reconkit.functions.missing import nan_to_null
from reconkit.operators.joins import outer_with_provenance
from reconkit.operators.quantiles import quantiles_of_counts
from reconkit.operators.shaping import without_lineage

# Fixed value: tolerance between two statistics.
STAT_TOLERANCE = 0.001
DIGEST_FROM = 64  # characters from which a text is counted by its digest
COMPARED = ("row_count", "null_count", "unique_count", "min_value", "max_value", "mean_value")


def _column_stats(field: T.StructField) -> dict:
    """Aggregates of one column under common names; statistics of other kinds are null."""
    c, t = F.col(field.name), field.dataType
    none = F.lit(None)
    number = isinstance(t, T.NumericType)
    text = isinstance(t, T.StringType)
    date = isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))
    x = c.cast("double")
    seconds = F.unix_micros(c.cast("timestamp")) / 1e6 if date else none
    return {
        "row_count": F.count(F.lit(1)),
        "null_count": F.count_if(c.isNull()),
        "min_value": F.min(x) if number else none.cast("double"),
        "max_value": F.max(x) if number else none.cast("double"),
        "mean_value": F.avg(x) if number else none.cast("double"),
        "std_value": F.stddev_samp(x) if number else none.cast("double"),
        "min_length": F.min(F.length(c)).cast("bigint") if text else none.cast("bigint"),
        "max_length": F.max(F.length(c)).cast("bigint") if text else none.cast("bigint"),
        "avg_length": F.avg(F.length(c)) if text else none.cast("double"),
        "min_date": date_text(F.min(c)) if date else none.cast("string"),
        "max_date": date_text(F.max(c)) if date else none.cast("string"),
        "date_range_days": F.floor((F.max(seconds) - F.min(seconds)) / DAY_SECONDS).cast("bigint")
        if date else none.cast("bigint"),
    }


def _fixed_width(c: Column, t: T.DataType) -> Column | None:
    """A whole number that stands for the value one to one; None for texts, fractions and decimals."""
    if isinstance(t, T.IntegralType):
        return c.cast("bigint")
    if isinstance(t, T.BooleanType):
        return c.cast("int").cast("bigint")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(t, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    return None


def _distinct_and_median(df: DataFrame, fields: list[T.StructField], median: bool) -> DataFrame:
    """(column_name, unique_count, median_value) from the distinct values of each column.

    Every value goes to the slot of a type that holds it exactly, under its column's number.
    Numbers, dates and marks have fixed width, so they are counted apart from texts, whose
    long ones stand as digests.
    """
    fixed, texts, numbers = [], [], []
    for i, f in enumerate(fields):
        c, t = F.col(f.name), f.dataType
        whole, fraction = _fixed_width(c, t), isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType))
        if whole is not None or (fraction and not isinstance(t, T.DecimalType)):
            b, d = (whole, F.lit(None)) if whole is not None else (F.lit(None), c)
            fixed.append(F.struct(F.lit(i).alias("i"), b.cast("bigint").alias("b"), d.cast("double").alias("d")))
        else:
            text = F.when(F.length(c) > DIGEST_FROM, F.sha2(c, 256)).otherwise(c) if isinstance(t, T.StringType) else c.cast("string")
            d = c.cast("double") if fraction else F.lit(None).cast("double")
            texts.append(F.struct(F.lit(i).alias("i"), text.alias("s"), d.alias("d")))
        if isinstance(t, T.NumericType):
            numbers.append(i)
    one = F.count(F.lit(1)).alias("n")
    value = F.coalesce(F.col("d"), F.col("b").cast("double")).alias("value")
    counts = []
    if fixed:
        long = df.select(F.inline(F.array(*fixed))).filter("b IS NOT NULL OR d IS NOT NULL")
        counts.append(long.groupBy("i", "b", "d").agg(one).select("i", value, "n"))
    if texts:
        long = df.select(F.inline(F.array(*texts))).filter("s IS NOT NULL")
        counts.append(long.groupBy("i", "s").agg(F.first("d").alias("value"), one).select("i", "value", "n"))
    unique = reduce(DataFrame.unionByName, [c.groupBy("i").agg(F.count(F.lit(1)).alias("unique_count")) for c in counts])
    if median and numbers:
        # the count in the condition keeps it above the aggregation, which both branches then share
        mid = reduce(DataFrame.unionByName, counts).select(F.col("i").alias("variable"), "value", "n")
        mid = mid.filter(F.col("variable").isin(numbers) & (F.when(F.col("value").isNotNull(), F.col("n")) > 0))
        mid = quantiles_of_counts(mid, {"median_value": 0.5}).withColumnRenamed("variable", "i")
        unique = unique.join(F.broadcast(mid), "i", "left")  # one row per column
    names = F.array(*[F.lit(f.name) for f in fields])
    return unique.withColumn("column_name", F.get(names, F.col("i"))).drop("i")


def column_profile(df: DataFrame, approx_distinct: bool = False, median: bool = True) -> DataFrame:
    """One row per column.

    Plain statistics of all columns take one scan.  Exact distinct counts and
    medians share a second one that counts distinct values per column;
    ``approx_distinct`` with ``median=False`` does without it.  NaN counts as null.
    """
    df = nan_to_null(without_lineage(df))
    fields = [f for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    stats = {f.name: _column_stats(f) for f in fields}
    if approx_distinct:
        for name, s in stats.items():
            s["unique_count"] = F.approx_count_distinct(name)
    wide = df.agg(*[e.alias(f"{s}__{i}") for i, f in enumerate(fields) for s, e in stats[f.name].items()])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            *[F.col(f"{s}__{i}").alias(s) for s in stats[f.name]],
        )
        for i, f in enumerate(fields)
    ]
    out = wide.select(F.inline(F.array(*rows)))
    if median or not approx_distinct:
        exact = _distinct_and_median(df, fields, median)
        exact = exact.drop("unique_count") if approx_distinct else exact
        out = out.join(F.broadcast(exact), "column_name", "left")  # one row per column
    out = out.withColumn("unique_count", F.coalesce("unique_count", F.lit(0)))
    share = lambda c: F.try_divide(F.col(c) * 100.0, F.col("row_count"))
    return out.withColumns({"null_percentage": share("null_count"), "unique_percentage": share("unique_count")})


def profile_compare(source: DataFrame, target: DataFrame) -> DataFrame:
    """Differences of two profiles per column; one-sided columns never match."""
    keep = ["column_name", "data_type", *COMPARED]
    a = source.select("column_name", *[F.col(c).alias(f"{c}_source") for c in keep[1:]])
    b = target.select("column_name", *[F.col(c).alias(f"{c}_target") for c in keep[1:]])
    both = outer_with_provenance(a, b, ["column_name"])
    on_both = F.col("_merge") == "both"
    added = {}
    for c in COMPARED:
        left, right = F.col(f"{c}_source"), F.col(f"{c}_target")
        diff = (right - left).cast("double")
        added[f"{c}_diff"] = diff
        close = F.when(left.isNull() & right.isNull(), on_both).otherwise(F.abs(diff) < STAT_TOLERANCE)
        added[f"{c}_match"] = F.coalesce(close, F.lit(False))
    out = both.withColumns(added)
    match = F.col("row_count_match") & F.col("null_count_match") & F.col("unique_count_match")
    return out.withColumn("stats_match", match)


def profile_report(compared: DataFrame, table_name: str) -> DataFrame:
    """Totals of a profile comparison and the list of differing columns."""
    total = F.count(F.lit(1))
    matching = F.count_if("stats_match")
    return compared.agg(
        F.lit(table_name).alias("table_name"),
        total.alias("total_columns"),
        matching.alias("matching_columns"),
        F.try_divide((total - matching) * 100.0, total).alias("mismatch_percentage"),
        F.array_sort(F.collect_list(F.when(~F.col("stats_match"), F.col("column_name")))).alias("mismatched_columns"),
    )


def proc_contents(df: DataFrame) -> DataFrame:
    """Observations, variables and per column type, non-null, null and unique counts."""
    basic = column_profile(df, median=False)
    return basic.select(
        F.col("row_count").alias("observations"),
        F.lit(len(df.columns)).alias("variables"),
        "column_name",
        "data_type",
        (F.col("row_count") - F.col("null_count")).alias("non_null"),
        "null_count",
        "unique_count",
    )
