"""Set operations and the named-dataset catalog."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from reconkit.operators.ordering import order_by_text
from reconkit.operators.shaping import where_clause


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; columns missing on a side become null."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def key_intersect(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))


def key_except(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).distinct().exceptAll(right.select(*keys).distinct())


class Datasets:
    """Named datasets, kept as temporary views of a session."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def add(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)

    def names(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables() if t.isTemporary)

    def drop(self, name: str) -> bool:
        found = self.spark.catalog.dropTempView(name)
        if not found:
            warnings.warn(f"dataset {name} not found", stacklevel=2)
        return found

    def get(self, name: str) -> DataFrame:
        if name not in self.names():
            raise ValueError(f"dataset {name} not found")
        return self.spark.table(name)

    def sql(self, query: str, **frames: DataFrame) -> DataFrame:
        """SQL text over named datasets and the given frames."""
        for name, df in frames.items():
            self.add(name, df)
        return self.spark.sql(query)

    def select(
        self,
        dataset: str,
        columns: Sequence[str] | None = None,
        where: str | None = None,
        order_by: str | Sequence[str] | None = None,
        limit: int | None = None,
    ) -> DataFrame:
        """WHERE, columns, ORDER BY, LIMIT; an absent or zero limit keeps all rows."""
        df = self.get(dataset)
        if where:
            df = where_clause(df, where)
        if columns and list(columns) != ["*"]:
            absent = [c for c in columns if c not in df.columns]
            if absent:
                raise ValueError(f"columns not found: {absent}")
            df = df.select(*columns)
        if order_by:
            df = order_by_text(df, order_by)
        return df.limit(limit) if limit else df

    def create_table(self, name: str, query: DataFrame | str) -> DataFrame:
        """Keep a query result under a name."""
        df = self.spark.sql(query) if isinstance(query, str) else query
        self.add(name, df)
        return df
