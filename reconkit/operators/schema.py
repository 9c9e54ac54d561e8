"""Schemas as data: comparison, mapping and status of table pairs.

Schema tables carry one row per column of a table; every operator here handles
any number of table pairs at once, told apart by ``tbl``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from reconkit.functions.text import joined_list, remove_from_list
from reconkit.functions.types import source_type_text, type_compatible
from reconkit.operators.joins import merge, unmapped
from reconkit.operators.matching import greedy_column_match
from reconkit.session import local_rows

# Status texts of a table pair.
NO_MAPPING = "Column Mapping Not Provided"
STATUS = {
    "no_source": "Nonexisting Source Table",
    "no_target": "Nonexisting Target Table",
    "no_source_date": "Nonexisting Date Variable in Source",
    "no_target_date": "Nonexisting Date Variable in Target",
    "empty_source": "Empty Source Table",
    "empty_target": "Empty Target Table",
    "no_mapping": NO_MAPPING,
    "success": "Successful Data Access",
}


SCHEMA = "tbl string, position int, column_name string, data_type string, target_name string"


def schema_rows(
    df: DataFrame, tbl: str, mapping: Mapping[str, str] | None = None, source_types: bool = False
) -> list[tuple]:
    """One ``SCHEMA`` row per column of a table."""
    kind = source_type_text if source_types else lambda f: f.dataType.simpleString()
    return [(tbl, i, f.name, kind(f), (mapping or {}).get(f.name)) for i, f in enumerate(df.schema, 1)]


def schema_as_table(
    df: DataFrame,
    tbl: str = "table",
    mapping: Mapping[str, str] | None = None,
    source_types: bool = False,
    counts: bool = False,
) -> DataFrame:
    """(tbl, position, column_name, data_type[, target_name][, non_null]).

    ``source_types`` renders types the way the source database lists them;
    ``counts`` adds the non-null rows per column, in one scan.
    """
    out = local_rows(df.sparkSession, schema_rows(df, tbl, mapping, source_types), SCHEMA)
    if mapping is None:
        out = out.drop("target_name")
    if counts:
        filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "non_null")
        out = out.join(F.broadcast(filled), "column_name").select(*out.columns, "non_null")  # one row per column
    return out


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of either side with both types and where they occur."""
    a = source.withColumnsRenamed({c: f"source_{c}" for c in source.columns if c not in ("tbl", "column_name")})
    b = target.withColumnsRenamed({c: f"target_{c}" for c in target.columns if c not in ("tbl", "column_name")})
    both = merge(a, b, ["tbl", "column_name"], "full_outer")
    side = (
        F.when(F.col("target_data_type").isNull(), "source_only")
        .when(F.col("source_data_type").isNull(), "target_only")
        .otherwise("common")
    )
    return both.withColumn("side", side)


def dtype_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Common columns whose types read differently."""
    return schema_diff(source, target).filter("side = 'common' AND source_data_type <> target_data_type")


def auto_mapping(source: DataFrame, target: DataFrame) -> DataFrame:
    """(tbl, position, source_name, target_name) for source columns without a mapping."""
    free_source, free_target = _unmapped_per_table(source, target)
    lowered = free_source.withColumn("column_name", F.lower("column_name"))
    found = greedy_column_match(lowered, free_target, ["tbl"])
    return found.withColumn("source_name", F.upper("source_name"))


def _unmapped_per_table(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    qualified = F.concat_ws("\u0001", "tbl", "column_name")
    mapped = F.when(F.col("target_name").isNotNull(), F.concat_ws("\u0001", "tbl", "target_name"))
    free_source, free_target = unmapped(
        source.withColumns({"_own": F.col("column_name"), "target_name": mapped}),
        target.withColumns({"_own": F.col("column_name"), "column_name": qualified}),
    )
    return free_source.drop("_own"), free_target.drop("column_name").withColumnRenamed("_own", "column_name")


def schema_merge(source: DataFrame, target: DataFrame, auto: DataFrame | None = None) -> DataFrame:
    """Match columns by mapping, then automatically, and compare their types.

    ``source``: (tbl, position, column_name, data_type, target_name); ``target``:
    the same without target_name.  Output: (tbl, source_name, source_type,
    target_name, target_type, side, auto_mapped, type_match).
    """
    auto = auto_mapping(source, target) if auto is None else auto
    found = auto.select("tbl", F.col("source_name").alias("_n"), F.col("target_name").alias("_auto"))
    a = source.alias("a")
    mapped = a.join(
        found.alias("f"),
        (F.col("a.tbl") == F.col("f.tbl")) & (F.upper("a.column_name") == F.col("f._n")) & F.col("a.target_name").isNull(),
        "left",
    ).select(
        F.col("a.tbl").alias("tbl"),
        F.col("a.column_name").alias("source_name"),
        F.col("a.data_type").alias("source_type"),
        F.coalesce("a.target_name", "f._auto").alias("column_name"),
        F.col("f._auto").isNotNull().alias("auto_mapped"),
    )
    b = target.select("tbl", "column_name", F.col("column_name").alias("target_name"), F.col("data_type").alias("target_type"))
    joined = mapped.join(b, ["tbl", "column_name"], "full_outer")
    side = (
        F.when(F.col("target_name").isNull(), "source_only")
        .when(F.col("source_name").isNull(), "target_only")
        .otherwise("both")
    )
    match = F.when(F.col("side") == "both", type_compatible(F.col("source_type"), F.col("target_type")))
    return (
        joined.withColumn("side", side)
        .withColumn("type_match", match)
        .withColumn("auto_mapped", F.coalesce("auto_mapped", F.lit(False)))
        .select("tbl", "source_name", "source_type", "target_name", "target_type", "side", "auto_mapped", "type_match")
    )


def schema_summary(merged: DataFrame) -> DataFrame:
    """Per table: unique columns of either side, type mismatches, automatic mappings."""
    arrow = lambda a, b: F.concat(a, F.lit("->"), b)
    pick = lambda cond, value: joined_list(F.when(cond, value))
    both = F.col("side") == "both"
    return merged.groupBy("tbl").agg(
        pick(F.col("side") == "source_only", F.upper("source_name")).alias("source_unique"),
        pick(F.col("side") == "target_only", F.lower("target_name")).alias("target_unique"),
        pick(both & ~F.col("type_match"), arrow(F.col("source_type"), F.col("target_type"))).alias("type_mismatch"),
        pick(F.col("auto_mapped"), arrow(F.upper("source_name"), F.col("target_name"))).alias("uncaptured"),
    )


def _counts_text(a: Column, b: Column) -> Column:
    return F.format_string("source(%d) : target(%d)", a, b)


def metadata_diff(source: DataFrame, target: DataFrame, rows: DataFrame) -> DataFrame:
    """One report row per table pair.  ``rows``: (tbl, source_rows, target_rows).

    A table without any mapping is matched on lower-case names and its types are
    not compared.
    """
    mapped = F.max(F.col("target_name").isNotNull()).over(W.partitionBy("tbl"))  # columns of one table
    marked = source.withColumn("_mapped", mapped)
    filled = marked.withColumn(
        "target_name", F.when(F.col("_mapped"), F.col("target_name")).otherwise(F.lower("column_name"))
    )
    flags = marked.groupBy("tbl").agg(F.first("_mapped").alias("_mapped"), F.count(F.lit(1)).alias("_sc"))
    widths = flags.join(target.groupBy("tbl").agg(F.count(F.lit(1)).alias("_tc")), "tbl")
    summary = schema_summary(schema_merge(filled.drop("_mapped"), target))
    types = F.when(F.col("_mapped"), F.col("type_mismatch")).otherwise("")
    return (
        summary.join(widths, "tbl")
        .join(rows, "tbl")
        .select(
            "tbl",
            (F.col("source_rows") != F.col("target_rows")).alias("row_unmatch"),
            _counts_text(F.col("source_rows"), F.col("target_rows")).alias("row_details"),
            _counts_text(F.col("_sc"), F.col("_tc")).alias("col_details"),
            types.alias("type_details"),
            (types != "").alias("type_unmatch"),
            "source_unique",
            "target_unique",
            F.when(F.col("_mapped"), F.col("uncaptured")).otherwise(NO_MAPPING).alias("uncaptured"),
        )
    )


def metadata_diff_no_mapping(source: DataFrame, target: DataFrame, rows: DataFrame) -> DataFrame:
    """Report rows for tables without a mapping: names matched automatically."""
    bare = source.drop("target_name").withColumn("target_name", F.lit(None).cast("string"))
    merged = schema_merge(bare, target)
    both = F.col("side") == "both"
    carried = merged.groupBy("tbl").agg(
        joined_list(F.when(both, F.concat(F.upper("source_name"), F.lit(":"), "source_type", F.lit("->"), "target_name", F.lit(":"), "target_type"))).alias("carried_types")
    )
    widths = source.groupBy("tbl").agg(F.count(F.lit(1)).alias("_sc")).join(
        target.groupBy("tbl").agg(F.count(F.lit(1)).alias("_tc")), "tbl"
    )
    return (
        schema_summary(merged)
        .join(widths, "tbl")
        .join(rows, "tbl")
        .join(carried, "tbl")
        .select(
            "tbl",
            (F.col("source_rows") != F.col("target_rows")).alias("row_unmatch"),
            _counts_text(F.col("source_rows"), F.col("target_rows")).alias("row_details"),
            _counts_text(F.col("_sc"), F.col("_tc")).alias("col_details"),
            "source_unique",
            "target_unique",
            "uncaptured",
            "carried_types",
        )
    )


def clean_column_lists(report: DataFrame, drop_cols: list[str], add_cols: list[str]) -> DataFrame:
    """Take known names out of the unique-column lists."""
    return report.withColumns(
        {
            "source_unique": remove_from_list(F.col("source_unique"), drop_cols),
            "target_unique": remove_from_list(F.col("target_unique"), add_cols),
        }
    )


def pull_status(
    has_source: Column,
    has_mapping: Column,
    has_source_date: Column,
    source_columns: Column,
    has_target: Column,
    has_target_date: Column,
    target_columns: Column,
) -> Column:
    """First failure wins, except that an empty target is always reported."""
    return (
        F.when(has_target & has_target_date & (target_columns == 0), STATUS["empty_target"])
        .when(~has_source, STATUS["no_source"])
        .when(~has_mapping, STATUS["no_mapping"])
        .when(~has_source_date, STATUS["no_source_date"])
        .when(source_columns == 0, STATUS["empty_source"])
        .when(~has_target, STATUS["no_target"])
        .when(~has_target_date, STATUS["no_target_date"])
        .otherwise(STATUS["success"])
    )
