"""Copying tables into partitioned Parquet with lineage and a manifest."""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType

from reconkit.functions.types import cast_by_source_type
from reconkit.operators.shaping import narrow_types, partition_columns, pick_date_column, rename_by_mapping
from reconkit.sources.write import (
    register_table,
    size_estimate,
    stamp_lineage,
    write_manifest,
    write_partitioned_parquet,
)

log = logging.getLogger(__name__)


@dataclass
class TableJob:
    name: str
    source: DataFrame
    source_types: Mapping[str, str]
    mapping: Mapping[str, str]
    date_column: str | None = None  # target name; found from the schema if absent
    narrow: bool = True  # one extra pass to choose the smallest types that lose nothing


def migrate_table(job: TableJob, root: str, at: datetime, mode: str = "overwrite") -> str:
    """cast, rename, narrow, derive partitions, stamp, write.  Returns the path.

    Appended rows take the types of the files that are there; a value that does not fit
    them is an error.
    """
    path = os.path.join(root, job.name)
    df = rename_by_mapping(cast_by_source_type(job.source, job.source_types), job.mapping)
    written = _written_types(df.sparkSession, path) if mode == "append" else {}
    if written:
        df = df.withColumns({c: F.col(c).cast(written[c]) for c in df.columns if c in written})
    elif job.narrow:
        df, _ = narrow_types(df, dictionary=False)
    date_column = job.date_column or pick_date_column(df)
    df = stamp_lineage(partition_columns(df, date_column, at.strftime("%Y-%m-%d")), at)
    parts = ["year", "month"] if date_column else ["migration_date"]
    return write_partitioned_parquet(df, path, parts, mode)


def _written_types(spark: SparkSession, path: str) -> dict[str, DataType]:
    """Column types of the table at ``path``; none if there is no table."""
    try:
        return {f.name: f.dataType for f in spark.read.parquet(path).schema}
    except AnalysisException:
        return {}


def run_migration(
    spark: SparkSession, jobs: Sequence[TableJob], root: str, manifest_path: str, register: bool = False
) -> list[tuple[str, str]]:
    """Copy all tables and write the manifest.  Returns (table, error) of failed ones."""
    started, done, failed = datetime.now(timezone.utc), [], []
    for job in jobs:
        try:
            at = datetime.now(timezone.utc)
            path = migrate_table(job, root, at)
            if register:
                register_table(spark, job.name, path, partitioned=True)
            rows = spark.read.parquet(path).count()
            size = size_estimate(spark, path).first().size_mb
            done.append((job.name, path, rows, size, at, at.strftime("%Y-%m-%d"), started))
        except Exception as e:  # noqa: BLE001 - other tables must still be copied
            log.exception("table %s failed", job.name)
            failed.append((job.name, str(e)))
    ended = datetime.now(timezone.utc)
    write_manifest(spark, [(*row, ended) for row in done], manifest_path)
    return failed
