"""Source-database type text: parsing, compatibility and conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def type_parts(type_text: Column) -> dict[str, Column]:
    """Base name and the one or two numbers in brackets of a type text."""
    pattern = r"^([A-Za-z0-9_ ]+?)(?:\((\d*)(?:,\s*(\d+))?\))?$"
    piece = lambda i: F.regexp_extract(type_text, pattern, i)
    return {
        "base": piece(1),
        "size": piece(2).try_cast("int"),
        "scale": piece(3).try_cast("int"),
    }


def type_compatible(source: Column, target: Column) -> Column:
    """Whether a target type can hold a source type under the fixed rule table."""
    src, tgt = type_parts(source), type_parts(target)
    same_scale = src["scale"].isNotNull() & (src["scale"] == tgt["scale"])
    is_timestamp = F.startswith(target, F.lit("timestamp"))
    size_kept = F.coalesce(src["size"] == 1, F.lit(False)) | ~F.lower(tgt["base"]).startswith("varchar")
    # Type names of the source database and the target lake.
    verdict = (
        F.when(source == "NUMBER", target == "double")
        .when(src["base"] == "NUMBER", (tgt["base"] == "decimal") & same_scale)
        .when(src["base"] == "VARCHAR2", (tgt["base"] == "varchar") & src["size"].eqNullSafe(tgt["size"]))
        .when(src["base"] == "CHAR", src["size"].isNotNull() & size_kept)
        .when(source == "DATE", (target == "date") | is_timestamp)
        .when(F.startswith(source, F.lit("TIMESTAMP")), is_timestamp)
    )
    return F.coalesce(verdict, F.lit(False))


def spark_type_for(type_text: str) -> T.DataType:
    """Spark type for a source-database type."""
    base = type_text.split("(")[0].strip().upper()
    if base == "NUMBER":
        plain = "(" in type_text and "," not in type_text
        return T.LongType() if plain else T.DoubleType()
    if base == "DATE" or base.startswith("TIMESTAMP"):
        return T.TimestampNTZType()
    if base in ("BOOLEAN", "BOOL"):
        return T.BooleanType()
    if base == "BLOB":
        return T.BinaryType()
    return T.StringType()


def cast_by_source_type(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Convert columns by source type text; values that do not convert become null."""
    present = {c: spark_type_for(t) for c, t in types.items() if c in df.columns}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in present.items()})


def source_type_text(field: T.StructField) -> str:
    """Render a Spark type the way the source database would list it."""
    t = field.dataType
    if isinstance(t, T.DecimalType):
        return f"NUMBER({t.precision},{t.scale})"
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # Decimal digits that hold each integer width.
        return f"NUMBER({ {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}[type(t)] })"
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return "NUMBER"
    if isinstance(t, T.DateType):
        return "DATE"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP(6)"
    if isinstance(t, T.VarcharType):
        return f"VARCHAR2({t.length})"
    if isinstance(t, T.CharType):
        return f"CHAR({t.length})"
    if isinstance(t, T.BinaryType):
        return "BLOB"
    return "CLOB"
