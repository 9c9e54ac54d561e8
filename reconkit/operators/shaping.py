"""Projection, filtering, casting and data-step verbs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reconkit.functions.dates import month_text, year_text
from reconkit.session import local_rows

# Narrowing limits.
DICTIONARY_MAX_VALUES, DICTIONARY_MAX_RATIO = 1000, 0.5
LINEAGE_PREFIX = "_upload"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename_by_mapping(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename source columns to target names; names not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def pick_date_column(df: DataFrame) -> str | None:
    """First date or timestamp column, the default paging and partition column."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return next((f.name for f in df.schema if isinstance(f.dataType, kinds)), None)


def without_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(LINEAGE_PREFIX)])


def where_clause(df: DataFrame, where: str) -> DataFrame:
    """Filter by SQL predicate text."""
    try:
        out = df.filter(where)
        out.schema  # analysis errors surface here
        return out
    except PySparkException as e:
        raise ValueError(f"Invalid WHERE clause: {where}") from e


def compute_columns(df: DataFrame, compute: Mapping[str, str]) -> DataFrame:
    """Add expressions in order; later ones see earlier ones."""
    return reduce(lambda d, kv: d.withColumn(kv[0], F.expr(kv[1])), compute.items(), df)


def select_keep_drop(
    df: DataFrame,
    keep: Sequence[str] | None = None,
    drop: Sequence[str] | None = None,
    where: str | None = None,
    compute: Mapping[str, str] | None = None,
) -> DataFrame:
    """where, compute, drop, keep, in that order; unknown names are ignored."""
    if where:
        df = where_clause(df, where)
    df = compute_columns(df, compute or {})
    df = df.drop(*(drop or []))
    if keep:
        df = df.select(*[c for c in keep if c in df.columns])
    return df


def data_step(
    df: DataFrame,
    output_name: str | None = None,
    operations: Sequence[Callable[[DataFrame], DataFrame]] = (),
) -> DataFrame:
    """Chain of frame-to-frame functions, optionally kept under a name."""
    out = reduce(lambda d, op: d.transform(op), operations, df)
    if output_name:
        out.createOrReplaceTempView(output_name)
    return out


def conditional_logic(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Set columns from constants or from functions of the frame, in order."""
    for name, rule in rules.items():
        value = rule(df) if callable(rule) else rule
        df = df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    return df


def format_variables(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """``$`` formats give text, date formats a timestamp, ``w.d`` rounds to d places."""
    for name, fmt in formats.items():
        if name not in df.columns:
            continue
        if fmt.startswith("$"):
            value = F.col(name).cast("string")
        elif "date" in fmt.lower():
            value = F.col(name).try_cast("timestamp_ntz")
        elif "." in fmt:
            decimals = fmt.split(".")[-1]
            value = F.round(name, int(decimals)) if decimals.isdigit() else F.col(name)
        else:
            value = F.col(name)
        df = df.withColumn(name, value)
    return df


def partition_columns(df: DataFrame, date_column: str | None, run_date: str) -> DataFrame:
    """``year`` and two-digit ``month`` of the date column, or the run date alone."""
    df = df.withColumn("migration_date", F.lit(run_date))
    if date_column is None:
        return df
    return df.withColumns(
        {"year": year_text(F.col(date_column)), "month": month_text(F.col(date_column))}
    )


def date_lookup(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows of one day; a half-open range, so the filter reaches the scan."""
    start = F.lit(day).cast("timestamp_ntz")
    return df.filter((F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 DAY")))


def narrow_types(df: DataFrame, dictionary: bool = True, float_loss: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Smallest integer and float types that hold the whole table, in one pass.

    Doubles become float only if every value stays the same; ``float_loss`` allows an
    absolute error, which the value comparison may then report.

    Returns the narrowed frame and a report (column_name, data_type, narrow_type,
    dictionary_candidate).  Types are decided once per table, not per file.
    ``dictionary=False`` leaves out the distinct counts of text columns.
    """
    ints = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    floats = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    texts = text_columns(df) if dictionary else []
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in ints:
        aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    for c in floats:
        short = F.col(c).cast("float").cast("double")
        kept = F.col(c).eqNullSafe(short) | (F.abs(F.col(c) - short) <= float_loss)
        aggs += [F.count_if(~kept).alias(f"err_{c}"), F.count(c).alias(f"some_{c}")]
    for c in texts:
        aggs.append(F.count_distinct(c).alias(f"d_{c}"))
    facts = df.agg(*aggs).first().asDict()

    def fits(c):
        lo, hi = facts[f"lo_{c}"], facts[f"hi_{c}"]
        for name, bits in (("tinyint", 8), ("smallint", 16), ("int", 32)):
            if lo is not None and -(2 ** (bits - 1)) <= lo and hi < 2 ** (bits - 1):
                return name
        return df.schema[c].dataType.simpleString()

    narrow = {c: fits(c) for c in ints}
    for c in floats:
        narrow[c] = "float" if facts[f"some_{c}"] and not facts[f"err_{c}"] else "double"
    rows = []
    for f in df.schema:
        candidate = False
        if f.name in texts and facts["n"]:
            d = facts[f"d_{f.name}"]
            candidate = d < DICTIONARY_MAX_VALUES and d / facts["n"] < DICTIONARY_MAX_RATIO
        old = f.dataType.simpleString()
        rows.append((f.name, old, narrow.get(f.name, old), candidate))
    report = local_rows(
        df.sparkSession, rows, "column_name string, data_type string, narrow_type string, dictionary_candidate boolean"
    )
    return df.withColumns({c: F.col(c).cast(t) for c, t in narrow.items()}), report
