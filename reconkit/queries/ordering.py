"""Window, sort, set and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reconkit.functions.dates import date_text
from reconkit.operators import ordering as O, reshape as X, windows as V
from reconkit.operators.sets import Datasets, union_all, union_distinct
from reconkit.queries import Tables, query, rnd


@query(
    "sort_nodupkey",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) = 1""",
)
def sort_nodupkey(t: Tables):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    out = O.sort_nodupkey(t.lineitem, ["l_orderkey"], order)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(
    "pct_of_group",
    """SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 9) AS share FROM orders""",
)
def pct_of_group(t: Tables):
    return V.pct_of_group(t.orders, ["o_orderpriority"], "o_totalprice").select("o_orderkey", rnd("share", 9).alias("share"))


EVENT_ORDER = ["ts", "event_id"]


@query(
    "rolling_mean",
    """SELECT event_id, round(CASE WHEN count(value) OVER w = 3 THEN avg(value) OVER w END, 4) AS rolling FROM events
       WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean(t: Tables):
    e = t.events.select("event_id", "ts", "event_type", "value")
    out = V.rolling_mean(e, "value", 3, EVENT_ORDER, ["event_type"])
    return out.select("event_id", rnd("rolling", 4).alias("rolling"))


@query(
    "expanding_sum",
    "SELECT event_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running FROM events",
)
def expanding_sum(t: Tables):
    e = t.events.select("event_id", "ts", "event_type", "value")
    out = V.expanding_sum(e, "value", EVENT_ORDER, ["event_type"])
    return out.select("event_id", rnd("running", 2).alias("running"))


@query(
    "rank_min",
    """SELECT event_id, CASE WHEN v IS NOT NULL THEN rank() OVER (ORDER BY v NULLS LAST) END AS rank
       FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""",
)
def rank_min(t: Tables):
    e = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return V.rank_min(e, "v").select("event_id", "rank")


@query(
    "zscore",
    """SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_samp(c_acctbal) FROM customer), 6) AS zscore
       FROM customer""",
)
def zscore(t: Tables):
    return V.zscore(t.customer, "c_acctbal").select("c_custkey", rnd("zscore").alias("zscore"))


@query(
    "interpolate_linear",
    """WITH p AS (SELECT event_id, CASE WHEN value > 15 THEN value END AS v, row_number() OVER (ORDER BY ts, event_id) AS p FROM events),
       k AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN p END) OVER (ORDER BY p) AS lp,
         min(CASE WHEN v IS NOT NULL THEN p END) OVER (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rp FROM p)
       SELECT k.event_id, round(CASE WHEN k.v IS NOT NULL THEN k.v WHEN a.v IS NULL THEN NULL WHEN b.v IS NULL THEN a.v
         ELSE a.v + (b.v - a.v) / (rp - lp) * (k.p - lp) END, 6) AS filled
       FROM k LEFT JOIN p a ON a.p = k.lp LEFT JOIN p b ON b.p = k.rp""",
)
def interpolate_linear(t: Tables):
    e = t.events.select("event_id", "ts", F.when(F.col("value") > 15, F.col("value")).alias("v"))
    return V.interpolate_linear(e, "v", EVENT_ORDER).select("event_id", rnd("filled").alias("filled"))


@query(
    "positional_pairing",
    """WITH a AS (SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) AS k, c_custkey FROM customer WHERE c_nationkey < 12),
       b AS (SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) AS k, c_custkey FROM customer WHERE c_nationkey >= 12)
       SELECT a.k AS pos, a.c_custkey AS left_key, b.c_custkey AS right_key FROM a JOIN b USING (k)""",
)
def positional_pairing(t: Tables):
    from reconkit.operators.cumulative import with_position

    order = ["c_acctbal", "c_custkey"]
    side = lambda where, name: with_position(t.customer.filter(where), order).select("pos", F.col("c_custkey").alias(name))
    return side("c_nationkey < 12", "left_key").join(side("c_nationkey >= 12", "right_key"), "pos")


@query(
    "factorize",
    """WITH f AS (SELECT p_brand, dense_rank() OVER (ORDER BY min(p_partkey)) - 1 AS code FROM part GROUP BY 1)
       SELECT p_partkey, code FROM part JOIN f USING (p_brand)""",
)
def factorize(t: Tables):
    return V.factorize(t.part, "p_brand", "p_partkey").select("p_partkey", "code")


@query(
    "qcut",
    """WITH e AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.75) AS c FROM events)
       SELECT event_id, CASE WHEN value <= a THEN 'q1' WHEN value <= b THEN 'q2' WHEN value <= c THEN 'q3' ELSE 'q4' END AS quantile_bin
       FROM events, e""",
)
def qcut(t: Tables):
    return V.qcut(t.events, "value", ["q1", "q2", "q3", "q4"]).select("event_id", "quantile_bin")


# ---- sorts and limits -----------------------------------------------------


@query("proc_sort", "SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS bal FROM customer ORDER BY c_mktsegment, bal DESC NULLS LAST")
def proc_sort(t: Tables):
    c = t.customer.select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("bal"))
    return O.proc_sort(c, ["c_mktsegment", "bal"], [True, False])


@query("order_by_text", "SELECT s_suppkey, s_nationkey FROM supplier ORDER BY s_nationkey DESC, s_suppkey")
def order_by_text(t: Tables):
    return O.order_by_text(t.supplier.select("s_suppkey", "s_nationkey"), ["s_nationkey DESC", "s_suppkey ASC"])


@query("limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def limit(t: Tables):
    return O.listing(t.orders, ["o_orderkey", "o_totalprice"], obs=25, order=["o_totalprice", "o_orderkey"])


@query(
    "top_n",
    """(SELECT 'top' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)
       UNION ALL (SELECT 'bottom', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20)""",
)
def top_n(t: Tables):
    cols = ["o_orderkey", "o_totalprice"]
    pick = lambda name, largest: O.top_n(t.orders.select(*cols), ["o_totalprice", "o_orderkey"], 20, largest).withColumn("part", F.lit(name))
    return pick("top", True).unionByName(pick("bottom", False))


@query("sample_n", "SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 100")
def sample_n(t: Tables):
    return O.sample_n(t.orders, 100, 42, ["o_orderkey"])


@query(
    "proc_print",
    """SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
       QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) <= 10""",
)
def proc_print(t: Tables):
    return O.listing(
        t.orders, ["o_orderpriority", "o_orderkey", "o_totalprice"], 10, "o_orderstatus = 'O'",
        ["o_orderpriority"], ["o_totalprice", "o_orderkey"],
    )


# ---- sets and catalog -----------------------------------------------------


def _parts_and_customers(t: Tables):
    a = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("label"))
    b = t.part.select(F.col("p_type").alias("label"), F.col("p_size").alias("size"))
    return [a, b]


@query(
    "union_distinct",
    """SELECT c_nationkey AS nationkey, c_mktsegment AS label, CAST(NULL AS INTEGER) AS size FROM customer
       UNION SELECT NULL, p_type, p_size FROM part""",
)
def union_distinct_query(t: Tables):
    return union_distinct(_parts_and_customers(t))


@query(
    "union_all",
    """SELECT label, count(*) AS n, count(size) AS sizes FROM (SELECT c_nationkey AS nationkey, c_mktsegment AS label, CAST(NULL AS INTEGER) AS size FROM customer
       UNION ALL SELECT NULL, p_type, p_size FROM part) GROUP BY 1""",
)
def union_all_query(t: Tables):
    return union_all(_parts_and_customers(t)).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count("size").alias("sizes"))


@query("create_table_as", "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 300000")
def create_table_as(t: Tables):
    data = Datasets(t.spark)
    data.add("ds_all_orders", t.orders)
    data.create_table("ds_large_orders", "SELECT o_orderkey, o_custkey FROM ds_all_orders WHERE o_totalprice > 300000")
    return data.get("ds_large_orders")


REVENUE = """SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM {orders}
  JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name"""


@query("sql_over_datasets", REVENUE.format(orders="orders", customer="customer", nation="nation"))
def sql_over_datasets(t: Tables):
    names = {"orders": "ds_o", "customer": "ds_c", "nation": "ds_n"}
    return Datasets(t.spark).sql(REVENUE.format(**names), ds_o=t.orders, ds_c=t.customer, ds_n=t.nation)


@query(
    "dataset_catalog",
    "SELECT 'ds_cat_customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'ds_cat_supplier', count(*) FROM supplier",
)
def dataset_catalog(t: Tables):
    data = Datasets(t.spark)
    for name, df in (("customer", t.customer), ("supplier", t.supplier), ("part", t.part)):
        data.add(f"ds_cat_{name}", df)
    data.drop("ds_cat_part")
    kept = [n for n in data.names() if n.startswith("ds_cat_")]
    return union_all([data.get(n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in kept])


# ---- reshaping ------------------------------------------------------------


@query(
    "transpose_long",
    """SELECT o_orderkey, 'o_custkey' AS _NAME_, CAST(o_custkey AS DOUBLE) AS _VALUE_ FROM orders
       UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice FROM orders""",
)
def transpose_long(t: Tables):
    o = t.orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_totalprice")
    return X.transpose_long(o, ["o_orderkey"])


@query(
    "transpose_wide",
    """SELECT l_suppkey, coalesce(avg(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0.0) AS "COLA",
       coalesce(avg(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0.0) AS "COLN",
       coalesce(avg(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0.0) AS "COLR" FROM lineitem GROUP BY 1""",
)
def transpose_wide(t: Tables):
    return X.transpose_wide(t.lineitem, ["l_suppkey"], "l_returnflag", "l_quantity", ["A", "N", "R"])


@query(
    "transpose_full",
    """SELECT 'n' AS key, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS "F", CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS "O",
         CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS "P" FROM orders
       UNION ALL SELECT 'customers', count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END),
         count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END), count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) FROM orders""",
)
def transpose_full(t: Tables):
    table = t.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("customers")
    )
    return X.transpose_full(table, "o_orderstatus")


@query(
    "transpose_blocks",
    """SELECT 'o_custkey' AS key, o_orderkey, o_custkey::DOUBLE AS value, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS block FROM orders
       UNION ALL SELECT 'o_totalprice', o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 FROM orders""",
)
def transpose_blocks(t: Tables):
    """Every order a column, a thousand a block; told in long form."""
    table = t.orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_totalprice")
    cells, labels = X.transpose_blocks(table, "o_orderkey")
    both = cells.join(labels, "block").select("key", "block", F.explode(F.arrays_zip("labels", "values")).alias("x"))
    return both.select("key", F.col("x.labels").alias("o_orderkey"), F.col("x.values").alias("value"), "block")


@query(
    "pivot_table",
    """SELECT l_suppkey, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS "A", sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS "N",
       sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS "R" FROM lineitem GROUP BY 1""",
)
def pivot_table(t: Tables):
    return X.pivot_sum(t.lineitem, ["l_suppkey"], "l_returnflag", "l_quantity", ["A", "N", "R"])


@query(
    "explode_list",
    """SELECT word, count(*) AS n FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_size <> 1
       UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size = 1) GROUP BY 1""",
)
def explode_list(t: Tables):
    words = t.part.select("p_partkey", F.when(F.col("p_size") != 1, F.split("p_name", " ")).alias("words"))
    return X.explode_list(words, "words", "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stack_unstack",
    "SELECT c_custkey, c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey FROM customer",
)
def stack_unstack(t: Tables):
    c = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"))
    return X.unstack(X.stack(c, ["c_custkey"], ["c_acctbal", "c_nationkey"]), ["c_custkey"], ["c_acctbal", "c_nationkey"])


@query(
    "resample",
    """WITH f AS (SELECT CAST(min(ts) AS DATE) AS d0 FROM events)
       SELECT strftime(d0 + CAST(floor(datediff('day', d0, CAST(ts AS DATE)) / 3) AS INTEGER) * 3, '%Y-%m-%d') AS bucket_start,
         round(sum(value), 2) AS sum_value, count(*) AS n FROM events, f GROUP BY 1""",
)
def resample(t: Tables):
    out = X.resample_days(t.events, "ts", "value", 3)
    return out.withColumns({"bucket_start": date_text(F.col("bucket_start")), "sum_value": rnd("sum_value", 2)})
