"""Frequencies, summary statistics and grouped aggregation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reconkit.functions.dates import date_text
from reconkit.functions.missing import nan_to_null
from reconkit.operators.ordering import sort_keys
from reconkit.operators.quantiles import exact_quantiles
from reconkit.operators.shaping import numeric_columns, text_columns

TOTAL = "Total"
ALL = "All"

_d = lambda c: F.col(c).cast("double")
BASIC: dict[str, Callable[[str], Column]] = {
    "n": F.count,
    "mean": lambda c: F.avg(_d(c)),
    "std": lambda c: F.stddev_samp(_d(c)),
    "min": lambda c: F.min(_d(c)),
    "max": lambda c: F.max(_d(c)),
    "sum": lambda c: F.sum(_d(c)),
    "var": lambda c: F.var_samp(_d(c)),
    "missing": lambda c: F.count_if(F.col(c).isNull()),
    "g1": lambda c: F.skewness(_d(c)),
    "g2": lambda c: F.kurtosis(_d(c)),
}
GROUP_FUNCTIONS = {
    "count": F.count,
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
}


def stats_long(
    df: DataFrame, columns: Sequence[str], stats: Mapping[str, Callable[[str], Column]], by: Sequence[str] = ()
) -> DataFrame:
    """All statistics of all columns in one pass, one row per (by..., variable).  NaN is missing."""
    df = nan_to_null(df)
    cells = {(c, s): f"{s}__{i}" for i, c in enumerate(columns) for s in stats}
    wide = df.groupBy(*by).agg(*[stats[s](c).alias(a) for (c, s), a in cells.items()])
    rows = [
        F.struct(F.lit(c).alias("variable"), *[F.col(cells[c, s]).alias(s) for s in stats]) for c in columns
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def proc_means(
    df: DataFrame,
    variables: Sequence[str] | None = None,
    by: Sequence[str] = (),
    stats: Sequence[str] = ("n", "mean", "std", "min", "max"),
) -> DataFrame:
    """Summary per variable (and group).  Rows with a null group key are left out."""
    variables = list(variables or [c for c in numeric_columns(df) if c not in by])
    if by:
        df = df.dropna(subset=list(by))
    known = {s: BASIC[s] for s in stats if s in BASIC}
    out = stats_long(df, variables, known or {"n": BASIC["n"]}, by)
    if "median" in stats:
        mid = exact_quantiles(df, variables, {"median": 0.5}, by)
        out = out.join(mid, [*by, "variable"], "left")
    return out


def proc_means_wide(
    df: DataFrame,
    variables: Sequence[str],
    by: Sequence[str],
    stats: Sequence[str] = ("mean", "std", "min", "max", "count"),
) -> DataFrame:
    """Grouped statistics as ``variable_stat`` columns, one row per group; ``median`` is exact."""
    named = ["count" if s == "n" else s for s in stats]
    if unknown := [s for s in named if s not in GROUP_FUNCTIONS and s != "median"]:
        raise ValueError(f"unsupported statistics {unknown}")
    rows = nan_to_null(df).dropna(subset=list(by))
    columns = [(v, s) for v in variables for s in named]
    out = rows.groupBy(*by).agg(
        *[GROUP_FUNCTIONS[s](v).alias(f"{v}_{s}") for v, s in columns if s != "median"] or [F.count(F.lit(1)).alias("_rows")]
    )
    if "median" in named:
        mid = exact_quantiles(rows, variables, {"median": 0.5}, by).groupBy(*by).pivot("variable", list(variables)).agg(F.first("median"))
        out = out.join(mid.withColumnsRenamed({v: f"{v}_median" for v in variables}), list(by), "left")
    return out.select(*by, *[f"{v}_{s}" for v, s in columns])


def _level_counts(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    cells = df.select(*[F.col(v).cast("string").alias(v) for v in variables])
    return cells.unpivot([], list(variables), "variable", "level").groupBy("variable", "level").agg(
        F.count(F.lit(1)).alias("frequency")
    )


def proc_freq_oneway(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Levels with frequency and percent of all rows, nulls counted in the base only."""
    counts = _level_counts(df, [v for v in variables if v in df.columns])
    rows = F.broadcast(counts.groupBy("variable").agg(F.sum("frequency").alias("_rows")))  # one per variable
    percent = F.round(F.col("frequency") * 100 / F.col("_rows"), 2)
    return counts.filter("level IS NOT NULL").join(rows, "variable").select(
        "variable", "level", "frequency", percent.alias("percent")
    )


def proc_freq_total(df: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
    """Levels with percent of the non-null rows, plus a Total row per variable."""
    counts = _level_counts(df, variables or text_columns(df)).filter("level IS NOT NULL")
    rows = counts.groupBy("variable").agg(F.sum("frequency").alias("_rows"))  # one per variable
    levels = counts.join(F.broadcast(rows), "variable").select(
        "variable", "level", "frequency", (F.col("frequency") * 100 / F.col("_rows")).alias("percent")
    )
    total = rows.select("variable", F.lit(TOTAL).alias("level"), F.col("_rows").alias("frequency"), F.lit(100.0).alias("percent"))
    return levels.unionByName(total)


def crosstab_margins(
    df: DataFrame, row: str, column: str, values: Sequence[str] | None = None, margin: str = ALL
) -> DataFrame:
    """Two-way counts with a margin row and column; rows with a null key are left out.

    A real level with the margin's name is an error: choose another ``margin``.
    """
    counts = df.dropna(subset=[row, column]).groupBy(row, column).agg(F.count(F.lit(1)).alias("_n"))
    cube = counts.cube(row, column).agg(
        F.sum("_n").alias("n"), F.grouping(row).alias("gr"), F.grouping(column).alias("gc")
    )

    def label(total: str, c: str) -> Column:
        level = F.col(c).cast("string")
        clash = F.raise_error(F.lit(f"a level of {c} is named like the margin: {margin}"))
        return F.when(F.col(total) == 1, margin).when(level == margin, clash).otherwise(level).alias(c)

    labelled = cube.select(label("gr", row), label("gc", column), "n")
    wide = labelled.groupBy(row).pivot(column, [*values, margin] if values else None).agg(F.sum("n"))
    return wide.na.fill(0)


def proc_freq_by(df: DataFrame, by: str, variable: str, values: Sequence[str] | None = None) -> DataFrame:
    """Group x value counts with a Total row and column."""
    return crosstab_margins(df, by, variable, values, TOTAL)


def proc_univariate(df: DataFrame, variables: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """n, mean, std, min, quartiles, max, bias-adjusted skew and kurtosis, missing."""
    variables = list(variables or numeric_columns(df))
    names = ("n", "mean", "std", "min", "max", "g1", "g2", "missing")
    base = stats_long(df, variables, {s: BASIC[s] for s in names}, by)
    quart = exact_quantiles(df, variables, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return (
        base.join(quart, [*by, "variable"], "left")
        .withColumns({"skew": skew, "kurtosis": kurt})
        .select(*by, "variable", "n", "mean", "std", "min", "q1", "median", "q3", "max", "skew", "kurtosis", "missing")
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over min..max of the finite values, empty bins included."""
    x = _d(column)
    data = df.select(x.alias("x")).filter(F.abs("x") < float("inf"))
    limits = data.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("r")).scalar()
    width = (F.col("r.hi") - F.col("r.lo")) / bins
    index = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("r.lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = data.withColumn("r", limits).groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), limits.alias("r"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("r.lo") + width * F.col("bin")).alias("lower"),
        (F.col("r.lo") + width * (F.col("bin") + 1)).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def group_by_having(
    df: DataFrame, group_cols: Sequence[str], agg_funcs: Mapping[str, str | Sequence[str]], having: str | None = None
) -> DataFrame:
    """Grouped aggregates as ``column_function``; HAVING sees those names."""
    aggs = []
    for column, names in agg_funcs.items():
        for name in [names] if isinstance(names, str) else names:
            if name not in GROUP_FUNCTIONS:
                raise ValueError(f"unsupported aggregate {name}")
            aggs.append(GROUP_FUNCTIONS[name](column).alias(f"{column}_{name}"))
    out = nan_to_null(df).dropna(subset=list(group_cols)).groupBy(*group_cols).agg(*aggs)
    return out.filter(having) if having else out


def describe_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles, max and missing per numeric column."""
    columns = list(columns or numeric_columns(df))
    names = ("n", "mean", "std", "min", "max", "missing")
    base = stats_long(df, columns, {s: BASIC[s] for s in names})
    quart = exact_quantiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return base.withColumnRenamed("n", "count").join(quart, "variable", "left").select(
        "variable", "count", "mean", "std", "min", "p25", "p50", "p75", "max", "missing"
    )


def first_per_group(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """First non-null value of every column per group, in ``order``."""
    rest = [c for c in df.columns if c not in by]
    return df.dropna(subset=list(by)).groupBy(*by).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest]
    )


def monthly_summary(df: DataFrame, date_column: str, value: str, start: str | None = None) -> DataFrame:
    """Sum, count and mean per calendar month, from ``start`` on."""
    if start:
        df = df.filter(F.col(date_column) >= F.lit(start).cast("timestamp_ntz"))
    return df.groupBy(date_text(F.date_trunc("month", date_column)).alias("month")).agg(
        F.sum(value).alias("total"), F.count(value).alias("n"), F.avg(value).alias("average")
    )


def totals_row(df: DataFrame, label_column: str, label: str = "TOTAL") -> DataFrame:
    """The table plus one row that sums the numeric columns."""
    sums = [F.sum(c).alias(c) for c in numeric_columns(df) if c != label_column]
    return df.unionByName(df.agg(F.lit(label).alias(label_column), *sums), allowMissingColumns=True)


def sorted_by_frequency(freq: DataFrame) -> DataFrame:
    return freq.orderBy("variable", *sort_keys(["frequency", "level"], [False, True]))
