"""Reading tables: files, catalog, databases, cutoffs and partitioned extracts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_table(spark: SparkSession, name_or_query: str) -> DataFrame:
    """A catalog table, or the result of a query."""
    if name_or_query.lstrip().lower().startswith(("select", "with")):
        return spark.sql(name_or_query)
    return spark.table(name_or_query)


def jdbc_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    fetch_size: int = 50_000,
    **extra: str,
) -> dict[str, str]:
    """Options for a database read; ranged reads wrap the query as a derived table."""
    opts = {"url": url, "fetchsize": str(fetch_size), **extra}
    if partition_column is None:
        return {**opts, "query": query}
    low, high = bounds
    return {
        **opts,
        "dbtable": f"({query}) t",
        "partitionColumn": partition_column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def scan_jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()


def days(start: date, end: date) -> list[tuple[date, date]]:
    """Half-open day ranges from start to end, both included."""
    return [(start + timedelta(n), start + timedelta(n + 1)) for n in range((end - start).days + 1)]


def day_predicates(column: str, start: date, end: date) -> list[str]:
    """One predicate per day for ``spark.read.jdbc(predicates=...)``."""
    return [f"{column} >= DATE '{a}' AND {column} < DATE '{b}'" for a, b in days(start, end)]


def scan_jdbc_by_day(
    spark: SparkSession, url: str, table: str, date_column: str, start: date, end: date, properties: dict | None = None
) -> DataFrame:
    return spark.read.jdbc(url, table, predicates=day_predicates(date_column, start, end), properties=properties or {})


def date_bounds(df: DataFrame, date_column: str) -> DataFrame:
    return df.agg(F.min(date_column).alias("first_date"), F.max(date_column).alias("last_date"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("nrow"))


def file_facts(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """One row: ``nrow`` and ``min_<c>, max_<c>`` of a Parquet table, from file footers where they hold them.

    Counts and extremes of whole numbers, fractions, dates and marks are pushed into the
    scan, which then reads no column data; other kinds (texts, timestamps) make it a scan of these
    columns.  NaN is left out of neither: a fraction's footer says nothing of it.
    """
    aggregates = [F.count(F.lit(1)).alias("nrow")]
    for c in columns:
        aggregates += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    facts = _footer_reader(spark).read.parquet(path).agg(*aggregates)
    # files without rows have nothing to add up, although a count is never null by its type
    return facts.withColumn("nrow", F.coalesce(F.nullif("nrow", F.lit(-1)), F.lit(0)))


def _footer_reader(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet source takes aggregates; the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    others = [x for x in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def cutoff_filter(df: DataFrame, cutoff: datetime | None, column: str = "_upload_timestamp") -> DataFrame:
    """Rows loaded up to the cutoff, at full precision; no cutoff keeps all rows."""
    return df if cutoff is None else df.filter(F.col(column) <= F.lit(cutoff).cast("timestamp"))


def cutoff_date_filter(df: DataFrame, cutoff: datetime | None, column: str = "_upload_date") -> DataFrame:
    return df if cutoff is None else df.filter(F.col(column) <= cutoff.strftime("%Y-%m-%d"))


def scan_parquet_cutoff(spark: SparkSession, path: str, cutoff: datetime | None) -> DataFrame:
    return cutoff_filter(spark.read.parquet(path), cutoff)


def scan_table_cutoff(spark: SparkSession, name: str, cutoff: datetime | None) -> DataFrame:
    return cutoff_filter(spark.table(name), cutoff)


def extract_partitioned(
    df: DataFrame, columns: Sequence[str] | None = None, where: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Chosen columns and rows, spread evenly when a partition count is given."""
    out = df.filter(where) if where else df
    out = out.select(*columns) if columns else out
    return out.repartition(partitions) if partitions else out


def extract_by_day(
    df: DataFrame,
    date_column: str,
    start: date | None = None,
    end: date | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of whole days start..end; rows without a date are left out.

    A missing bound is taken as open: every dated row lies between the first and
    the last day, so the bounds need not be looked up.  The half-open filter is
    pushed to the scan.
    """
    out = df.filter(F.col(date_column).isNotNull())
    if start:
        out = out.filter(F.col(date_column) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        out = out.filter(F.col(date_column) < F.lit(end + timedelta(1)).cast("timestamp_ntz"))
    return out.select(*columns) if columns else out


def read_table_list(spark: SparkSession, path: str) -> DataFrame:
    """Table list with a header line."""
    return spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)


def read_column_mapping(
    spark: SparkSession, path: str, direction: str = "source2target", whole_file: bool = True
) -> DataFrame:
    """(map_name, source_name, target_name) from ``{map: {direction: {source: target}}}``.

    One document per file, or per line when ``whole_file`` is off.
    """
    nested = "map<string, map<string, map<string, string>>>"
    text = spark.read.text(path, wholetext=whole_file)
    return (
        text.select(F.explode(F.from_json("value", nested)).alias("map_name", "m"))
        .select("map_name", F.explode(F.col("m")[direction]).alias("source_name", "target_name"))
    )


def read_mismatch_csv(spark: SparkSession, path: str) -> DataFrame:
    """(tbl, mismatched_date) from a CSV with columns ``tbl, mismatched date``."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    return raw.toDF(*[c.strip().replace(" ", "_") for c in raw.columns]).select("tbl", "mismatched_date")
