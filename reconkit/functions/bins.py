"""Binning expressions and small column-group helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def cut(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins; outside the edges gives null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    out = F.lit(None).cast("string")
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        out = F.when((x > low) & (x <= high), F.lit(label)).otherwise(out)
    return out


def case_bucket(x: Column, rules: Sequence[tuple[Column, str]], default: str = "Unknown") -> Column:
    """First rule that holds names the bucket."""
    out = F.lit(default)
    for condition, label in reversed(rules):
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def where(x: Column, condition: Column, other: Column) -> Column:
    """Keep ``x`` where the condition holds."""
    return F.when(condition, x).otherwise(other)


def mask(x: Column, condition: Column, other: Column) -> Column:
    """Replace ``x`` where the condition holds."""
    return F.when(condition, other).otherwise(x)


class ColumnArray:
    """1-based access to a group of columns; an index out of range raises."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)

    def dim(self) -> Column:
        return F.lit(len(self.names))

    def get(self, index: Column | int) -> Column:
        return F.element_at(F.array(*self.names), index)

    def set(self, df: DataFrame, index: int, value: Column) -> DataFrame:
        if not 1 <= index <= len(self.names):
            raise IndexError(f"array index {index} outside 1..{len(self.names)}")
        return df.withColumn(self.names[index - 1], value)
