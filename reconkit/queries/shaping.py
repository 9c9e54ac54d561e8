"""Projection, filter, cast and data-step queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from reconkit.functions import bins, dates, types as st
from reconkit.operators import shaping as sh
from reconkit.operators.ordering import row_range
from reconkit.operators.sets import Datasets
from reconkit.plans import align
from reconkit.queries import TARGET, Tables, altered_orders, query
from reconkit.sources import scan, write


@query("normalize_columns", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def normalize_columns(t: Tables):
    shouted = t.orders.toDF(*[c.upper() for c in t.orders.columns])
    return sh.normalize_columns(shouted).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("rename_by_mapping", "SELECT c_custkey AS customer_id, c_acctbal AS balance, c_mktsegment FROM customer")
def rename_by_mapping(t: Tables):
    names = {"c_custkey": "customer_id", "c_acctbal": "balance", "not_there": "x"}
    return sh.rename_by_mapping(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment"), names)


@query(
    "select_keep_drop",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross
       FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 10""",
)
def select_keep_drop(t: Tables):
    return sh.select_keep_drop(
        t.lineitem,
        keep=["l_orderkey", "l_linenumber", "net", "gross", "unknown"],
        drop=["l_tax", "unknown"],
        where="l_returnflag = 'R' AND l_quantity >= 10",
        compute={
            "net": "l_extendedprice * (1 - l_discount)",
            "gross": "net * (1 + l_tax)",
        },
    )


@query(
    "proc_sql_select",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""",
)
def proc_sql_select(t: Tables):
    data = Datasets(t.spark)
    data.add("ds_orders", t.orders)
    return data.select(
        "ds_orders", ["o_orderkey", "o_totalprice"], "o_orderstatus = 'F'", ["o_totalprice DESC", "o_orderkey"], 50
    )


@query(
    "where_clause",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE (o_orderstatus = 'O' AND o_totalprice > 200000) OR o_orderpriority = '1-URGENT'""",
)
def where_clause(t: Tables):
    text = "(o_orderstatus == 'O' AND o_totalprice > 200000) OR o_orderpriority = '1-URGENT'"
    return sh.where_clause(t.orders, text).select("o_orderkey", "o_orderpriority")


@query(
    "compute_columns",
    "SELECT s_suppkey, s_acctbal * 2 AS doubled, s_acctbal * 2 + 100 AS gained FROM supplier",
)
def compute_columns(t: Tables):
    out = sh.compute_columns(t.supplier, {"doubled": "s_acctbal * 2", "gained": "doubled + 100"})
    return out.select("s_suppkey", "doubled", "gained")


@query(
    "conditional_logic",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END AS size_class,
       'batch' AS origin FROM orders""",
)
def conditional_logic(t: Tables):
    rules = {
        "size_class": lambda df: F.when(df["o_totalprice"] > 250000, "big").otherwise("small"),
        "origin": "batch",
    }
    return sh.conditional_logic(t.orders, rules).select("o_orderkey", "size_class", "origin")


@query(
    "case_bucket",
    """SELECT CASE WHEN c_acctbal < 2000 THEN 'Low' WHEN c_acctbal >= 2000 AND c_acctbal < 6000 THEN 'Medium'
       WHEN c_acctbal >= 6000 THEN 'High' ELSE 'Unknown' END AS level, count(*) AS n FROM customer GROUP BY 1""",
)
def case_bucket(t: Tables):
    x = F.col("c_acctbal")
    # fixed values: the level names
    rules = [(x < 2000, "Low"), ((x >= 2000) & (x < 6000), "Medium"), (x >= 6000, "High")]
    return t.customer.groupBy(bins.case_bucket(x, rules).alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "data_step",
    """SELECT o_orderkey, CAST(o_totalprice * 100 AS BIGINT) AS cents FROM orders WHERE o_orderstatus <> 'P'""",
)
def data_step(t: Tables):
    return sh.data_step(
        t.orders,
        "open_orders",
        [
            lambda df: df.filter("o_orderstatus <> 'P'"),
            lambda df: df.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint")),
            lambda df: df.select("o_orderkey", "cents"),
        ],
    )


BATCHES = (datetime(2024, 1, 1, 0, 0, 0, 500000), datetime(2024, 1, 1, 0, 0, 0, 900000))


def stamped_batches(t: Tables):
    """Orders loaded in two batches of the same second: before 1998, and from 1998 on."""
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return write.stamp_lineage(t.orders.filter(early), BATCHES[0]).unionByName(
        write.stamp_lineage(t.orders.filter(~early), BATCHES[1])
    )


@query(
    "cutoff_filter",
    """SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def cutoff_filter(t: Tables):
    kept = scan.cutoff_filter(scan.cutoff_date_filter(stamped_batches(t), BATCHES[0]), BATCHES[0])
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "exclude_dates",
    f"""WITH {TARGET},
       s AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
       g AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM target GROUP BY 1),
       bad AS (SELECT coalesce(s.d, g.d) AS d FROM s FULL JOIN g ON s.d = g.d WHERE s.n IS DISTINCT FROM g.n)
       SELECT o_orderstatus, count(*) AS n FROM orders
       WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM bad) GROUP BY 1""",
)
def exclude_dates(t: Tables):
    kept = align.exclude_dates(t.orders, "o_orderdate", order_date_gaps(t))
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def order_date_gaps(t: Tables):
    from reconkit.operators.temporal import date_histogram, temporal_differences

    a, b = date_histogram(t.orders, "o_orderdate"), date_histogram(altered_orders(t), "o_orderdate")
    return temporal_differences(a, b).select("date")


MAPPING = {
    "o_orderkey": "order_id",
    "o_custkey": "customer_id",
    "o_orderstatus": "status",
    "o_totalprice": "price",
    "o_orderdate": "order_date",
    "o_orderpriority": "priority",
}


@query(
    "aligned_projection",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders",
)
def aligned_projection(t: Tables):
    kept = align.aligned_columns(MAPPING, ["status", "price", "priority"])
    renamed = sh.rename_by_mapping(t.orders, MAPPING).select(*kept.values())
    return renamed.withColumn("order_date", dates.date_text(F.col("order_date")))


@query(
    "load_aligned",
    f"""WITH {TARGET},
       s AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
       g AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM target GROUP BY 1),
       bad AS (SELECT coalesce(s.d, g.d) AS d FROM s FULL JOIN g ON s.d = g.d WHERE s.n IS DISTINCT FROM g.n)
       SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderdate < TIMESTAMP '1998-01-01' AND CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM bad)""",
)
def load_aligned(t: Tables):
    return align.load_aligned(
        stamped_batches(t), ["o_orderkey", "o_custkey"], BATCHES[0], "o_orderdate", order_date_gaps(t)
    )


@query("skip_lineage_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def skip_lineage_columns(t: Tables):
    return sh.without_lineage(stamped_batches(t)).select("o_orderkey", "o_orderstatus")


@query(
    "cast_by_source_type",
    """SELECT event_id, CAST(round(value, 2) AS DOUBLE) AS amount,
       TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS user_no,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events""",
)
def cast_by_source_type(t: Tables):
    as_text = t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.format_string("%.2f", "value").alias("amount"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("user_id").cast("string")).alias("user_no"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
    )
    types = {"event_id": "NUMBER(19)", "amount": "NUMBER(12,2)", "user_no": "NUMBER(10)", "ts": "DATE", "gone": "CLOB"}
    out = st.cast_by_source_type(as_text, types)
    return out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "narrow_types",
    """WITH c AS (
         SELECT 'l_orderkey' AS column_name, 'bigint' AS data_type, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem
         UNION ALL SELECT 'l_partkey', 'bigint', min(l_partkey), max(l_partkey) FROM lineitem
         UNION ALL SELECT 'l_suppkey', 'bigint', min(l_suppkey), max(l_suppkey) FROM lineitem
         UNION ALL SELECT 'l_linenumber', 'int', min(l_linenumber), max(l_linenumber) FROM lineitem),
       f AS (
         SELECT 'l_quantity' AS column_name, max(abs(l_quantity - CAST(CAST(l_quantity AS FLOAT) AS DOUBLE))) AS e FROM lineitem
         UNION ALL SELECT 'l_extendedprice', max(abs(l_extendedprice - CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE))) FROM lineitem
         UNION ALL SELECT 'l_discount', max(abs(l_discount - CAST(CAST(l_discount AS FLOAT) AS DOUBLE))) FROM lineitem
         UNION ALL SELECT 'l_tax', max(abs(l_tax - CAST(CAST(l_tax AS FLOAT) AS DOUBLE))) FROM lineitem),
       s AS (
         SELECT 'l_returnflag' AS column_name, count(DISTINCT l_returnflag) AS d, count(*) AS n FROM lineitem
         UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus), count(*) FROM lineitem)
       SELECT column_name, data_type, CASE WHEN lo >= -128 AND hi < 128 THEN 'tinyint'
         WHEN lo >= -32768 AND hi < 32768 THEN 'smallint' WHEN lo >= -2147483648 AND hi < 2147483648 THEN 'int'
         ELSE data_type END AS narrow_type, false AS dictionary_candidate FROM c
       UNION ALL SELECT column_name, 'double', CASE WHEN e = 0 THEN 'float' ELSE 'double' END, false FROM f
       UNION ALL SELECT column_name, 'string', 'string', d < 1000 AND d * 1.0 / n < 0.5 FROM s
       UNION ALL SELECT 'l_shipdate', 'timestamp_ntz', 'timestamp_ntz', false""",
)
def narrow_types(t: Tables):
    return sh.narrow_types(t.lineitem)[1]


@query(
    "partition_columns",
    """SELECT '2024-05-01' AS migration_date, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
       count(*) AS n FROM orders GROUP BY ALL""",
)
def partition_columns(t: Tables):
    out = sh.partition_columns(t.orders, "o_orderdate", "2024-05-01")
    return out.groupBy("migration_date", "year", "month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pick_date_column",
    """SELECT 'o_orderdate' AS column_name, CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_date,
       CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_date FROM orders""",
)
def pick_date_column(t: Tables):
    c = sh.pick_date_column(t.orders)
    return scan.date_bounds(t.orders, c).select(
        F.lit(c).alias("column_name"),
        dates.date_text(F.col("first_date")).alias("first_date"),
        dates.date_text(F.col("last_date")).alias("last_date"),
    )


@query(
    "numeric_columns",
    """SELECT * FROM (
       SELECT 'l_orderkey' AS column_name, count(l_orderkey) AS n FROM lineitem
       UNION ALL SELECT 'l_partkey', count(l_partkey) FROM lineitem
       UNION ALL SELECT 'l_suppkey', count(l_suppkey) FROM lineitem
       UNION ALL SELECT 'l_linenumber', count(l_linenumber) FROM lineitem
       UNION ALL SELECT 'l_quantity', count(l_quantity) FROM lineitem
       UNION ALL SELECT 'l_extendedprice', count(l_extendedprice) FROM lineitem
       UNION ALL SELECT 'l_discount', count(l_discount) FROM lineitem
       UNION ALL SELECT 'l_tax', count(l_tax) FROM lineitem)""",
)
def numeric_columns(t: Tables):
    names = sh.numeric_columns(t.lineitem)
    return t.lineitem.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "n")


@query(
    "row_range",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM (
         SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       WHERE rn BETWEEN 501 AND 900""",
)
def rows_in_range(t: Tables):
    out = row_range(t.orders, ["o_orderdate", "o_orderkey"], 501, 900)
    return out.select("o_orderkey", dates.date_text(F.col("o_orderdate")).alias("o_orderdate"))


@query(
    "format_variables",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, round(value, 1) AS value,
       CAST(strftime(ts, '%Y-%m-%d') AS TIMESTAMP) AS day FROM events""",
)
def format_variables(t: Tables):
    raw = t.events.select("event_id", (F.col("value") + 0.01).alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    raw = raw.withColumn("value", F.round(F.col("value") - 0.01, 2))
    return sh.format_variables(raw, {"event_id": "$20.", "value": "8.1", "day": "date9.", "gone": "8.2"})


@query(
    "normalize_date_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def normalize_date_text(t: Tables):
    return t.events.select("event_id", dates.date_text(F.col("ts")).alias("day"))


@query(
    "date_lookup",
    """SELECT event_id, event_type, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' AND event_type = 'click'""",
)
def date_lookup(t: Tables):
    day = sh.date_lookup(t.events, "ts", "2024-01-10")
    return day.filter(F.col("event_type") == "click").select("event_id", "event_type", "value")
