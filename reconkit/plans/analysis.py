"""Metadata analysis of many table pairs: status, schema, rows and dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from reconkit.operators.schema import (
    SCHEMA,
    STATUS,
    clean_column_lists,
    metadata_diff,
    metadata_diff_no_mapping,
    pull_status,
    schema_rows,
)
from reconkit.operators.temporal import date_histogram, temporal_differences, temporal_summary
from reconkit.session import local_rows, scratch_path
from reconkit.sources.write import REPORT_COLUMNS

HISTOGRAM = "tbl string, date string, n_rows bigint"
PLACEHOLDER = "no_server_provided"
BATCH = 40  # tables whose histograms are one job


@dataclass
class TablePair:
    """One entry of the table list; a frame that does not exist is None."""

    tbl: str
    source: DataFrame | None
    target: DataFrame | None
    source_table: str = ""
    target_table: str = ""
    source_date: str = ""
    target_date: str = ""
    mapping: Mapping[str, str] | None = None
    product: str = ""
    hydrated_only: str = "N"
    service: str | None = None
    source_types: Mapping[str, str] = field(default_factory=dict)


def _histograms(spark, pairs, side) -> DataFrame:
    """Date histograms of all tables of one side; rows without a date keep a null date.

    Written (a row per table and day) in batches of tables, so that each table is read
    once and no plan grows with their number.
    """
    path, frames = scratch_path(spark, "histograms"), [local_rows(spark, [], HISTOGRAM)]
    for p in pairs:
        df, column = getattr(p, side), getattr(p, f"{side}_date")
        if df is None:
            continue
        h = (
            date_histogram(df, column)
            if column in df.columns
            else df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("date", F.lit(None).cast("string"))
        )
        frames.append(h.withColumn("tbl", F.lit(p.tbl)))
    for first in range(0, len(frames), BATCH):
        reduce(DataFrame.unionByName, frames[first : first + BATCH]).write.mode("append").parquet(path)
    return spark.read.schema(HISTOGRAM).parquet(path)


def _availability(spark: SparkSession, pairs: Sequence[TablePair]) -> DataFrame:
    rows = [
        (
            p.tbl, p.product, _service_name(p), p.target_table, p.hydrated_only, f"{p.source_date} : {p.target_date}",
            p.source is not None, p.mapping is not None, p.source is not None and p.source_date in p.source.columns,
            len(p.source.columns) if p.source is not None else 0,
            p.target is not None, p.target is not None and p.target_date in p.target.columns,
            len(p.target.columns) if p.target is not None else 0,
        )
        for p in pairs
    ]
    return local_rows(
        spark,
        rows,
        "tbl string, product string, source_table string, target_table string, hydrated_only string, time_variable string, "
        "has_source boolean, has_mapping boolean, has_source_date boolean, source_columns int, "
        "has_target boolean, has_target_date boolean, target_columns int",
    )


def _service_name(p: TablePair) -> str:
    if p.source_table.startswith(PLACEHOLDER) and p.service:
        return p.source_table.replace(PLACEHOLDER, p.service)
    return p.source_table


def run_analysis(
    spark: SparkSession,
    pairs: Sequence[TablePair],
    temporal_when: str = "always",
    drop_cols: Sequence[str] = (),
    add_cols: Sequence[str] = (),
) -> DataFrame:
    """The 17-column report, one row per table pair.

    Every table is scanned once, for its date histogram; row counts are the sums
    of the histograms.  ``temporal_when="mismatch"`` compares dates only where
    row counts differ.
    """
    unique = list({p.tbl: p for p in reversed(pairs)}.values())
    complete = [p for p in unique if p.source is not None and p.target is not None]

    def schemas(chosen, side):
        rows = []
        for p in chosen:
            listed = schema_rows(getattr(p, side), p.tbl, p.mapping, source_types=side == "source")
            types = p.source_types if side == "source" else {}
            rows += [(tbl, i, name, types.get(name, kind), to) for tbl, i, name, kind, to in listed]
        return local_rows(spark, rows, SCHEMA)

    mapped = [p for p in complete if p.mapping is not None]
    bare = [p for p in complete if p.mapping is None]
    hist_a, hist_b = _histograms(spark, complete, "source"), _histograms(spark, complete, "target")
    rows = hist_a.groupBy("tbl").agg(F.sum("n_rows").alias("source_rows")).join(
        hist_b.groupBy("tbl").agg(F.sum("n_rows").alias("target_rows")), "tbl", "full_outer"
    ).na.fill(0)
    meta = metadata_diff(schemas(mapped, "source"), schemas(mapped, "target").drop("target_name"), rows).unionByName(
        metadata_diff_no_mapping(schemas(bare, "source"), schemas(bare, "target").drop("target_name"), rows)
        .withColumns({"type_details": F.lit(""), "type_unmatch": F.lit(False)})
        .drop("carried_types")
    )
    dated = "date IS NOT NULL"
    dates = temporal_summary(temporal_differences(hist_a.filter(dated), hist_b.filter(dated), ["tbl"]), ["tbl"])

    pulled = _availability(spark, unique).withColumn(
        "status",
        pull_status(
            *[F.col(c) for c in ("has_source", "has_mapping", "has_source_date", "source_columns", "has_target", "has_target_date", "target_columns")]
        ),
    )
    closed = F.col("status").isin(STATUS["no_source"], STATUS["no_target_date"])
    gate = ~F.col("status").isin(STATUS["no_target_date"], STATUS["no_source_date"])
    if temporal_when == "mismatch":
        gate = gate & F.coalesce("row_unmatch", F.lit(False))
    shown = lambda c, default: F.when(closed, default).otherwise(F.coalesce(F.col(c), default)).alias(c)
    text = F.lit("")
    joined = pulled.join(meta, "tbl", "left").join(dates, "tbl", "left")
    report = joined.select(
        "product", "source_table", "target_table", "hydrated_only",
        F.substring_index("source_table", ".", 1).alias("source_service"),
        "status",
        shown("row_unmatch", F.lit(False)), shown("row_details", text), shown("col_details", text),
        F.when(gate, F.col("n_dates").isNotNull()).otherwise(False).alias("time_unmatch"),
        "time_variable",
        F.when(gate, F.coalesce("mismatched_date", text)).otherwise(text).alias("time_details"),
        shown("type_unmatch", F.lit(False)), shown("type_details", text),
        shown("source_unique", text), shown("target_unique", text), shown("uncaptured", text),
    )
    return clean_column_lists(report, list(drop_cols), list(add_cols)).select(*REPORT_COLUMNS)
