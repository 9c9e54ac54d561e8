"""Text expressions: prefixes, case-insensitive tests, lists, identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

SEPARATOR = "; "


def is_prefix_either(a: Column, b: Column) -> Column:
    """True when either text starts with the other."""
    return F.startswith(a, b) | F.startswith(b, a)


def ci_equals(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def ci_startswith(a: Column, b: Column) -> Column:
    return F.startswith(F.lower(a), F.lower(b))


def lower_contains(text: Column, needle: str) -> Column:
    return F.contains(F.lower(text), F.lit(needle.lower()))


def split_trim_list(text: Column, sep: str = ";") -> Column:
    """``'d1; d2'`` to an array; blank or null text gives an empty array."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), sep), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def joined_list(values: Column, sep: str = SEPARATOR) -> Column:
    """Aggregate: distinct non-null values, sorted, as one text."""
    return F.array_join(F.array_sort(F.collect_set(values)), sep)


def remove_from_list(text: Column, names: Sequence[str], sep: str = SEPARATOR) -> Column:
    """Drop whole names from a separated list."""
    kept = F.array_except(split_trim_list(text), F.array(*[F.lit(n) for n in names]).cast("array<string>"))
    return F.array_join(kept, sep)


def identifier_schema(name: Column) -> Column:
    """Part before the first dot."""
    return F.split(name, r"\.", 2)[0]


def identifier_table(name: Column) -> Column:
    """Part after the first dot, null when there is none."""
    return F.try_element_at(F.split(name, r"\.", 2), F.lit(2))


def row_digest(*columns: str) -> Column:
    """md5 over a key tuple, null parts included."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary"))
