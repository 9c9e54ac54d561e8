"""Writing tables, manifests and reports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: rows per output file.
ROWS_PER_FILE = 100_000
MANIFEST = (
    "table_name string, path string, row_count bigint, size_mb double, upload_timestamp timestamp, "
    "upload_date string, session_start timestamp, session_end timestamp"
)
# Microseconds, so that a cutoff read back still covers its own upload.
MANIFEST_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# Fixed value: the report's columns in their order.
REPORT_COLUMNS = [
    "product", "source_table", "target_table", "hydrated_only", "source_service", "status",
    "row_unmatch", "row_details", "col_details", "time_unmatch", "time_variable", "time_details",
    "type_unmatch", "type_details", "source_unique", "target_unique", "uncaptured",
]


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names with anything but letters, digits and ``_`` replaced."""
    return df.toDF(*[re.sub(r"[^0-9a-z_]+", "_", c.lower()) for c in df.columns])


def stamp_lineage(df: DataFrame, at: datetime) -> DataFrame:
    """Upload time, date and batch id, equal for all rows of a run."""
    return df.withColumns(
        {
            # fixed values: the lineage names
            "_upload_timestamp": F.lit(at).cast("timestamp"),
            "_upload_date": F.lit(at.strftime("%Y-%m-%d")),
            "_upload_batch_id": F.lit(at.strftime("%Y%m%d_%H%M%S")),
        }
    )


def write_partitioned_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    compression: str = "snappy",
    max_rows: int = ROWS_PER_FILE,
) -> str:
    """Modes ``overwrite``, ``append`` and ``overwrite_partitions``.

    Rows are written where they are; the row limit only splits files, so one
    large partition value is written by many tasks.
    """
    writer = sanitize_columns(df).write.option("maxRecordsPerFile", max_rows).option("compression", compression)
    if mode == "overwrite_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode in ("overwrite", "append"):
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    else:
        raise ValueError(f"unknown mode {mode}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """External Parquet table over a written folder, replacing an older one."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the data files below a folder; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(path).select("path", "length")


def size_estimate(spark: SparkSession, path: str) -> DataFrame:
    return written_files(spark, path).agg(
        F.count(F.lit(1)).alias("files"), (F.sum("length") / (1024.0 * 1024.0)).alias("size_mb")
    )


def write_manifest(spark: SparkSession, rows: Sequence[tuple], path: str) -> None:
    """One row per written table, in ``MANIFEST`` order."""
    manifest = spark.createDataFrame(list(rows), MANIFEST).coalesce(1)
    manifest.write.mode("overwrite").option("timestampFormat", MANIFEST_TIME).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("timestampFormat", MANIFEST_TIME).json(path)


def manifest_cutoff(manifest: DataFrame, table_name: str | None = None) -> datetime | None:
    """Upload time of a table, or the session start; None for an empty manifest."""
    if table_name:
        row = manifest.filter(F.col("table_name") == table_name).agg(F.max("upload_timestamp")).first()
        if row[0] is not None:
            return row[0]
    return manifest.agg(F.min("session_start")).first()[0]


def manifest_summary(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.sum("row_count").alias("total_rows"),
        (F.unix_micros(F.max("session_end")) - F.unix_micros(F.min("session_start"))).alias("_us"),
    ).select("total_tables", "total_rows", (F.col("_us") / 1e6).alias("duration_seconds"))


def write_results_csv(report: DataFrame, path: str, columns: Sequence[str] = REPORT_COLUMNS) -> None:
    """Report rows with a header, columns in fixed order."""
    report.select(*columns).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def persist_stage(df: DataFrame, path: str) -> DataFrame:
    """Store a stage result and read it back, so the next stage starts from files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
