"""Missing values: null, NaN and empty text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Float NaN to null; apply once where data enters."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def is_missing_numeric(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def is_missing_char(s: Column) -> Column:
    return s.isNull() | (s == "")


def coalesce_text(*columns: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def coalesce_numeric(*columns: Column) -> Column:
    """First value that is neither null nor NaN."""
    return F.coalesce(*[F.when(~F.isnan(c), c) for c in columns])
