"""Display formats and informats in the style of statistical packages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Missing-value mark and length limits of the format rules.
MISSING = "."
MAX_CHAR_LENGTH = 32767
MIN_NUMERIC_LENGTH, MAX_NUMERIC_LENGTH = 3, 8
MAX_LABEL_LENGTH = 256


def format_numeric(x: Column, decimals: int = 0) -> Column:
    """Fixed decimals, or the truncated integer; missing shows as a dot."""
    if decimals > 0:
        text = F.format_string(f"%.{decimals}f", x.cast("double"))
    else:
        text = x.cast("bigint").cast("string")
    return F.when(x.isNull() | F.isnan(x.cast("double")), F.lit(MISSING)).otherwise(text)


def format_char(s: Column, width: int) -> Column:
    """Cut or pad with blanks to exactly ``width`` characters; missing shows as a dot."""
    return F.coalesce(F.rpad(s, width, " "), F.lit(MISSING))


def fixed_char_display(s: Column, length: int = 200) -> Column:
    """Fixed-length character value as shown: cut to length, no trailing blanks."""
    return F.rtrim(F.rpad(F.coalesce(s, F.lit("")), length, " "))


def format_date(d: Column) -> Column:
    return F.coalesce(F.upper(F.date_format(d, "ddMMMyyyy")), F.lit(MISSING))


def format_datetime(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "ddMMMyyyy:HH:mm:ss"), F.lit(MISSING))


def format_time(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "HH:mm:ss"), F.lit(MISSING))


def informat_numeric(s: Column) -> Column:
    """Read a number, ignoring thousands separators, currency and percent signs."""
    cleaned = F.regexp_replace(F.trim(s), "[,$%]", "")
    return F.nullif(cleaned, F.lit(MISSING)).try_cast("double")


def informat_char(s: Column, width: int) -> Column:
    text = F.nullif(F.nullif(F.trim(s), F.lit("")), F.lit(MISSING))
    return F.substring(text, 1, width)


def informat_date(s: Column) -> Column:
    """``15JAN2024`` to a date, anything else to null."""
    s = F.trim(s)
    proper = F.concat(F.substring(s, 1, 2), F.initcap(F.substring(s, 3, 3)), F.substring(s, 6, 100))
    return F.to_date(F.try_to_timestamp(proper, F.lit("ddMMMyyyy")))


def clamp_length(length: Column, is_character: bool = False) -> Column:
    if is_character:
        return F.least(length, F.lit(MAX_CHAR_LENGTH))
    return F.greatest(F.least(length, F.lit(MAX_NUMERIC_LENGTH)), F.lit(MIN_NUMERIC_LENGTH))


def with_labels(df, labels: dict[str, str]):
    """Attach column labels as metadata, cut to the allowed length."""
    for name, text in labels.items():
        df = df.withMetadata(name, {"label": text[:MAX_LABEL_LENGTH]})
    return df


def label_of(df, column: str) -> str | None:
    return df.schema[column].metadata.get("label")
