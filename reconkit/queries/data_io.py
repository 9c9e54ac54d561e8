"""Source and sink queries.

What a query writes goes to a fresh path in the shared scratch folder and is
read back from there.  A database scan needs a server, so it is only tested for
the options it builds.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from reconkit.functions.dates import date_text
from reconkit.functions.text import split_trim_list
from reconkit.operators.records import value_differences
from reconkit.operators.temporal import date_histogram, temporal_differences, temporal_summary
from reconkit.plans.analysis import run_analysis
from reconkit.plans.migrate import TableJob, run_migration
from reconkit.queries import TARGET, Tables, altered_orders, query, rnd
from reconkit.queries.recon import PROFILE_PAIR, _profiles, table_pairs
from reconkit.operators.profile import profile_report
from reconkit.queries.shaping import BATCHES, MAPPING, stamped_batches
from reconkit.session import scratch_path
from reconkit.sources import batches, scan, write


@query(
    "scan_parquet",
    "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_discount > 0.05",
)
def scan_parquet(t: Tables):
    lines = scan.scan_parquet(t.spark, f"{t.folder}/lineitem.parquet")
    recent = F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return lines.filter(recent & (F.col("l_discount") > 0.05)).select("l_orderkey", "l_quantity")


@query("scan_table", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def scan_table(t: Tables):
    t.orders.createOrReplaceTempView("io_orders")
    return scan.scan_table(
        t.spark, "SELECT o_orderpriority, count(*) AS n FROM io_orders WHERE o_totalprice > 1000 GROUP BY 1"
    )


EARLY = """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
  WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1"""


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@query("scan_parquet_cutoff", EARLY)
def scan_parquet_cutoff(t: Tables):
    path = write.write_partitioned_parquet(stamped_batches(t), scratch_path(t.spark, "cutoff"))
    return _by_status(scan.scan_parquet_cutoff(t.spark, path, BATCHES[0]))


@query("scan_table_cutoff", EARLY)
def scan_table_cutoff(t: Tables):
    path = write.write_partitioned_parquet(stamped_batches(t), scratch_path(t.spark, "cutoff"))
    name = f"cutoff_{uuid.uuid4().hex[:12]}"
    write.register_table(t.spark, name, path)
    return _by_status(scan.scan_table_cutoff(t.spark, name, BATCHES[0]))


@query("extract_partitioned", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def extract_partitioned(t: Tables):
    return scan.extract_partitioned(t.orders, ["o_orderkey", "o_totalprice"], "o_orderstatus <> 'P'", 16)


@query(
    "extract_by_day",
    """SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'""",
)
def extract_by_day(t: Tables):
    return scan.extract_by_day(t.events, "ts", date(2024, 1, 5), date(2024, 1, 12), ["event_id", "event_type"])


@query(
    "date_bounds",
    "SELECT strftime(min(l_shipdate), '%Y-%m-%d') AS first_date, strftime(max(l_shipdate), '%Y-%m-%d') AS last_date FROM lineitem",
)
def date_bounds(t: Tables):
    out = scan.date_bounds(t.lineitem, "l_shipdate")
    return out.select(*[date_text(F.col(c)).alias(c) for c in out.columns])


@query("row_count", "SELECT count(*) AS nrow FROM lineitem")
def row_count(t: Tables):
    return scan.row_count(t.lineitem)


@query(
    "write_partitioned_parquet",
    """SELECT CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS year, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY ALL""",
)
def write_partitioned_parquet(t: Tables):
    path = scratch_path(t.spark, "orders")
    o = t.orders.withColumn("year", F.date_format("o_orderdate", "yyyy"))
    write.write_partitioned_parquet(o, path, ["year"])
    # One status is written again: only its own year folders are replaced.
    again = o.filter("year = '1997'")
    write.write_partitioned_parquet(again, path, ["year"], "overwrite_partitions")
    back = t.spark.read.parquet(path)
    return back.groupBy("year", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "stamp_lineage",
    """SELECT '2024-01-01' AS _upload_date, '20240101_000000' AS _upload_batch_id,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN '00:00:00.500000' ELSE '00:00:00.900000' END AS at, count(*) AS n
       FROM orders GROUP BY ALL""",
)
def stamp_lineage(t: Tables):
    at = F.date_format("_upload_timestamp", "HH:mm:ss.SSSSSS")
    return stamped_batches(t).groupBy("_upload_date", "_upload_batch_id", at.alias("at")).agg(F.count(F.lit(1)).alias("n"))


@query("register_table", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def register_table(t: Tables):
    path = write.write_partitioned_parquet(t.customer, scratch_path(t.spark, "customer"), ["c_mktsegment"])
    name = f"customer_{uuid.uuid4().hex[:12]}"
    write.register_table(t.spark, name, path, partitioned=True)
    return t.spark.table(name).filter("c_acctbal > 0").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "read_config_tables",
    """SELECT c_mktsegment AS "group", count(*) AS tables, count(DISTINCT 'lake.' || lower(c_name)) AS targets FROM customer GROUP BY 1""",
)
def read_config_tables(t: Tables):
    """A table list with one entry per customer, written as CSV and read back."""
    path = scratch_path(t.spark, "table_list")
    t.customer.select(
        F.concat(F.lit("svc."), "c_name").alias("source_table"),
        F.concat(F.lit("lake."), F.lower("c_name")).alias("target_table"),
        F.col("c_mktsegment").alias("group"),
    ).write.option("header", True).csv(path)
    listed = scan.read_table_list(t.spark, path)
    return listed.groupBy("group").agg(F.count(F.lit(1)).alias("tables"), F.count_distinct("target_table").alias("targets"))


@query(
    "read_column_mapping",
    "SELECT 'm' || c_nationkey AS map_name, count(*) AS columns, min(c_name) AS first_name FROM customer GROUP BY 1",
)
def read_column_mapping(t: Tables):
    """One mapping file per customer, in the nested form the mapping reader expects."""
    path = scratch_path(t.spark, "mapping")
    inner = F.create_map(F.col("c_name"), F.lower("c_name"))
    outer = F.create_map(F.concat(F.lit("m"), "c_nationkey"), F.create_map(F.lit("source2target"), inner))
    t.customer.select(F.to_json(outer).alias("value")).write.text(path)
    found = scan.read_column_mapping(t.spark, path, whole_file=False)
    return found.groupBy("map_name").agg(F.count(F.lit(1)).alias("columns"), F.min("source_name").alias("first_name"))


@query(
    "write_results_csv",
    f"""WITH {TARGET}, c AS (SELECT 'svc.orders' AS source_table, (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM target) AS b
       UNION ALL SELECT 'found.orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM target)
       UNION ALL SELECT 'svc.lineitem', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_quantity <> 1)
       UNION ALL SELECT 'svc.customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer))
       SELECT source_table, 'source(' || a || ') : target(' || b || ')' AS row_details, CAST(a <> b AS VARCHAR) AS row_unmatch FROM c
       UNION ALL SELECT 'svc.gone', NULL, 'false'""",
)
def write_results_csv(t: Tables):
    path = scratch_path(t.spark, "report")
    write.write_results_csv(run_analysis(t.spark, table_pairs(t)), path)
    back = t.spark.read.option("header", True).csv(path)
    return back.select("source_table", "row_details", "row_unmatch")


@query(
    "write_report_json",
    f"""{PROFILE_PAIR} SELECT 'orders' AS table_name, count(*) AS total_columns,
        string_agg(CASE WHEN NOT (rd = 0 AND nd = 0 AND ud = 0) THEN column_name END, '; ' ORDER BY column_name) AS mismatched_columns FROM j""",
)
def write_report_json(t: Tables):
    path = scratch_path(t.spark, "report")
    write.write_report_json(profile_report(_profiles(t), "orders"), path)
    back = t.spark.read.json(path)
    return back.select("table_name", "total_columns", F.array_join("mismatched_columns", "; ").alias("mismatched_columns"))


def _migrated(t: Tables):
    """orders, customer and lineitem copied with lineage; returns (root, manifest path)."""
    root, manifest = scratch_path(t.spark, "lake"), scratch_path(t.spark, "manifest")
    order_types = {"o_orderkey": "NUMBER(19)", "o_totalprice": "NUMBER(12,2)", "o_orderdate": "DATE", "o_orderstatus": "CHAR(1)"}
    jobs = [
        TableJob("orders", t.orders, order_types, MAPPING),
        TableJob("customer", t.customer, {"c_custkey": "NUMBER(19)"}, {"c_custkey": "customer_id"}),
        TableJob("lineitem", t.lineitem, {}, {}),
    ]
    failed = run_migration(t.spark, jobs, root, manifest)
    if failed:
        raise RuntimeError(f"migration failed: {failed}")
    return root, manifest


@query(
    "write_manifest",
    """SELECT 'orders' AS table_name, count(*) AS row_count, true AS has_size FROM orders
       UNION ALL SELECT 'customer', count(*), true FROM customer UNION ALL SELECT 'lineitem', count(*), true FROM lineitem""",
)
def write_manifest(t: Tables):
    manifest = write.read_manifest(t.spark, _migrated(t)[1])
    return manifest.select("table_name", "row_count", (F.col("size_mb") > 0).alias("has_size"))


@query(
    "migrate_and_compare",
    """SELECT CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS year, o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 1) AS total
       FROM orders GROUP BY ALL""",
)
def migrate_and_compare(t: Tables):
    """Copy, then read back everything loaded up to the manifest's cutoff."""
    root, manifest = _migrated(t)
    cutoff = write.manifest_cutoff(write.read_manifest(t.spark, manifest), "orders")
    back = scan.scan_parquet_cutoff(t.spark, f"{root}/orders", cutoff)
    return back.groupBy("year", "status").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("price"), 1).alias("total"))


_COPIED = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "migrated_values",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS compared, CAST(count_if(a.{c} IS DISTINCT FROM b.{c}) AS BIGINT) AS different
            FROM lineitem a JOIN lineitem b USING (l_orderkey, l_linenumber)"""
        for c in _COPIED
    ),
)
def migrated_values(t: Tables):
    """The copy of ``lineitem`` against the original: as many differing pairs as within the original, whose keys repeat."""
    back = t.spark.read.parquet(f"{_migrated(t)[0]}/lineitem")
    return value_differences(t.lineitem, back, ["l_orderkey", "l_linenumber"], _COPIED)


GAP_LISTS = f"""WITH {TARGET},
 s AS (SELECT o_orderstatus AS tbl, strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS n FROM orders GROUP BY ALL),
 g AS (SELECT o_orderstatus AS tbl, strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS n FROM target GROUP BY ALL)
 SELECT coalesce(s.tbl, g.tbl) AS tbl, coalesce(s.d, g.d) AS date FROM s FULL JOIN g ON s.tbl = g.tbl AND s.d = g.d WHERE s.n IS DISTINCT FROM g.n
"""


@query("read_mismatch_csv", GAP_LISTS)
def read_mismatch_csv(t: Tables):
    path = scratch_path(t.spark, "mismatch")
    hist = lambda df: date_histogram(df.withColumnRenamed("o_orderstatus", "tbl"), "o_orderdate", ["tbl"])
    lists = temporal_summary(temporal_differences(hist(t.orders), hist(altered_orders(t)), ["tbl"]), ["tbl"])
    lists.select("tbl", F.col("mismatched_date").alias("mismatched date")).write.option("header", True).csv(path)
    back = scan.read_mismatch_csv(t.spark, path)
    return back.select("tbl", F.explode(split_trim_list(F.col("mismatched_date"))).alias("date"))


@query("persist_stage", "SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, count(*) AS n_rows FROM lineitem GROUP BY 1")
def persist_stage(t: Tables):
    return write.persist_stage(date_histogram(t.lineitem, "l_shipdate"), scratch_path(t.spark, "stage"))


@query("size_estimate", "SELECT count(*) > 0 AS has_files, sum(l_quantity) > 0 AS has_size FROM lineitem")
def size_estimate(t: Tables):
    path = write.write_partitioned_parquet(t.lineitem, scratch_path(t.spark, "size"))
    return write.size_estimate(t.spark, path).select(
        (F.col("files") > 0).alias("has_files"), (F.col("size_mb") > 0).alias("has_size")
    )


@query(
    "append_twice",
    """SELECT o_orderstatus AS batch_id, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1""",
)
def append_twice(t: Tables):
    """One batch is written twice, one once, and one is staged but never committed."""
    path = scratch_path(t.spark, "batches")
    rows = lambda status: t.orders.filter(F.col("o_orderstatus") == status)
    batches.write_batch(rows("O").limit(10), path, "O")
    batches.write_batch(rows("F"), path, "F")
    batches.stage_batch(rows("P"), path, "P")
    batches.write_batch(rows("O"), path, "O")
    out = batches.read_committed(t.spark, path)
    return out.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "resumed_copy",
    """SELECT strftime(l_shipdate, '%Y') AS batch_id, count(*) AS row_count, true AS same FROM lineitem GROUP BY 1""",
)
def resumed_copy(t: Tables):
    """A copy by year that stops half-way and goes on; its commits are held against what is read back."""
    path = scratch_path(t.spark, "batches")
    year = F.date_format("l_shipdate", "yyyy")
    lines = t.lineitem.withColumn("month", F.month("l_shipdate"))
    years = sorted(r[0] for r in lines.select(year).distinct().collect())
    of = lambda y: lines.filter(year == y)
    batches.copy_batches(t.spark, path, years[: len(years) // 2], of, ["month"])
    batches.copy_batches(t.spark, path, years, of, ["month"])
    back = batches.read_committed(t.spark, path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("read"))
    commits = batches.committed_batches(t.spark, path).select("batch_id", "row_count")
    return commits.join(back, "batch_id").select("batch_id", "row_count", (F.col("read") == F.col("row_count")).alias("same"))


@query(
    "file_facts",
    """SELECT count(*) AS nrow, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey, min(l_quantity) AS min_l_quantity,
       max(l_quantity) AS max_l_quantity FROM lineitem""",
)
def file_facts(t: Tables):
    facts = scan.file_facts(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_quantity"])
    return t.spark.createDataFrame(facts.collect(), facts.schema)  # one row, from the session that reads footers


@query("file_facts_dates", "SELECT count(*) AS nrow, min(o_orderdate) AS min_o_orderdate, max(o_orderdate) AS max_o_orderdate FROM orders")
def file_facts_dates(t: Tables):
    """Timestamps have no pushed extremes: their column is read."""
    facts = scan.file_facts(t.spark, f"{t.folder}/orders.parquet", ["o_orderdate"])
    return t.spark.createDataFrame(facts.collect(), facts.schema)
