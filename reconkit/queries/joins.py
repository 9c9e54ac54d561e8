"""Join and name-matching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reconkit.operators import joins as J, matching as M
from reconkit.queries import TARGET, Tables, altered_orders, query, rnd


def _customers(t: Tables):
    """All customers by nation; a few nations are unknown."""
    key = F.when(F.col("c_acctbal") < 9500, F.col("c_nationkey"))
    return t.customer.select(key.alias("nationkey"), "c_custkey", "c_acctbal")


def _suppliers(t: Tables):
    """All suppliers, counted by shifted nation and balance: repeated, unknown and unmatched keys."""
    key = F.when(F.col("s_acctbal") < 9000, F.col("s_nationkey") + 5)
    return t.supplier.groupBy(key.alias("nationkey"), (F.col("s_acctbal") > 4000).alias("rich")).agg(
        F.count("s_suppkey").alias("suppliers")
    )


SIDES = """
cust AS (SELECT CASE WHEN c_acctbal < 9500 THEN c_nationkey END AS nationkey, c_custkey, c_acctbal FROM customer),
sup AS (SELECT CASE WHEN s_acctbal < 9000 THEN s_nationkey + 5 END AS nationkey, s_acctbal > 4000 AS rich,
        count(s_suppkey) AS suppliers FROM supplier GROUP BY ALL)
"""

for _how, _sql in (("inner", "JOIN"), ("left", "LEFT JOIN"), ("right", "RIGHT JOIN"), ("outer", "FULL JOIN")):

    @query(
        f"merge_{_how}",
        f"""WITH {SIDES} SELECT coalesce(cust.nationkey, sup.nationkey) AS nationkey, c_custkey, c_acctbal, rich, suppliers
            FROM cust {_sql} sup ON cust.nationkey IS NOT DISTINCT FROM sup.nationkey""",
    )
    def merged(t: Tables, how=_how):
        return J.merge(_customers(t), _suppliers(t), ["nationkey"], how)


@query(
    "proc_sql_join",
    """SELECT o.o_orderkey, o.name AS name_left, c.name AS name_right, c.c_custkey
       FROM (SELECT o_orderkey, o_custkey, o_orderpriority AS name FROM orders) o
       LEFT JOIN (SELECT c_custkey + 10 AS c_custkey, c_name AS name FROM customer) c ON o.o_custkey = c.c_custkey""",
)
def proc_sql_join(t: Tables):
    left = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("name"))
    right = t.customer.select((F.col("c_custkey") + 10).alias("c_custkey"), F.col("c_name").alias("name"))
    out = J.sql_join(left, right, "left", left_on="o_custkey", right_on="c_custkey")
    return out.select("o_orderkey", "name_left", "name_right", "c_custkey")


@query(
    "outer_with_provenance",
    f"""WITH {TARGET} SELECT CASE WHEN t.o_orderkey IS NULL THEN 'left_only' WHEN s.o_orderkey IS NULL THEN 'right_only'
        ELSE 'both' END AS _merge, count(*) AS n FROM orders s FULL JOIN target t ON s.o_orderkey = t.o_orderkey GROUP BY 1""",
)
def outer_with_provenance(t: Tables):
    a, b = t.orders.select("o_orderkey"), altered_orders(t).select("o_orderkey")
    return J.outer_with_provenance(a, b, ["o_orderkey"]).groupBy("_merge").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mapping_lookup",
    """SELECT target_name, count(*) AS n FROM part LEFT JOIN (
         SELECT p_brand AS source_name, lower(p_brand) || '_std' AS target_name FROM part
         GROUP BY p_brand HAVING max(p_size) >= 50) m ON p_brand = source_name GROUP BY 1""",
)
def mapping_lookup(t: Tables):
    big = t.part.groupBy(F.col("p_brand").alias("source_name")).agg(F.max("p_size").alias("s")).filter("s >= 50")
    names = big.withColumn("target_name", F.concat(F.lower("source_name"), F.lit("_std")))
    return J.mapping_lookup(t.part, names, "p_brand").groupBy("target_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "unmapped_columns",
    """WITH s AS (SELECT DISTINCT p_brand AS column_name, CASE WHEN p_size > 45 THEN lower(p_type) END AS target_name FROM part),
       g AS (SELECT DISTINCT lower(p_type) AS column_name FROM part UNION SELECT DISTINCT lower(p_brand) FROM part)
       SELECT 'source' AS side, column_name FROM s WHERE target_name IS NULL
       UNION ALL SELECT 'target', column_name FROM g WHERE column_name NOT IN
         (SELECT target_name FROM s WHERE target_name IS NOT NULL)""",
)
def unmapped_columns(t: Tables):
    s = t.part.select(
        F.col("p_brand").alias("column_name"), F.when(F.col("p_size") > 45, F.lower("p_type")).alias("target_name")
    ).distinct()
    g = t.part.select(F.lower("p_type").alias("column_name")).union(t.part.select(F.lower("p_brand"))).distinct()
    a, b = J.unmapped(s, g)
    return a.select(F.lit("source").alias("side"), "column_name").unionByName(
        b.select(F.lit("target").alias("side"), "column_name")
    )


@query(
    "prefix_match_join",
    """WITH a AS (SELECT DISTINCT p_brand AS a FROM part),
       b AS (SELECT DISTINCT substr(p_brand, 1, CASE WHEN p_size % 2 = 0 THEN 7 ELSE 9 END) AS b FROM part)
       SELECT a, b FROM a JOIN b ON starts_with(a, b) OR starts_with(b, a)""",
)
def prefix_match_join(t: Tables):
    a = t.part.select(F.col("p_brand").alias("a"))
    b = t.part.select(F.expr("substr(p_brand, 1, if(p_size % 2 = 0, 7, 9))").alias("b"))
    return M.prefix_match_join(a, b, "a", "b")


@query(
    "prefix_match_long",
    """WITH a AS (SELECT DISTINCT text AS a FROM documents),
       b AS (SELECT DISTINCT CASE WHEN doc_id % 3 = 0 THEN substr(text, 1, 60) ELSE text END AS b FROM documents)
       SELECT md5(a) AS a, md5(b) AS b FROM a JOIN b ON substr(a, 1, 10) = substr(b, 1, 10) AND (starts_with(a, b) OR starts_with(b, a))
       UNION ALL SELECT md5(a), md5(b) FROM a JOIN b ON length(a) > 0 AND length(b) > 0 AND least(length(a), length(b)) < 10 AND (starts_with(a, b) OR starts_with(b, a))
         AND substr(a, 1, 10) <> substr(b, 1, 10)""",
)
def prefix_match_long(t: Tables):
    """Whole texts against texts and beginnings of texts."""
    a = t.documents.select(F.col("text").alias("a"))
    b = t.documents.select(F.expr("if(doc_id % 3 = 0, substr(text, 1, 60), text)").alias("b"))
    return M.prefix_match_join(a, b, "a", "b").select(F.md5("a").alias("a"), F.md5("b").alias("b"))


def _brand_lists(t: Tables):
    """Brand codes and their first seven letters per part type, in name order."""
    from pyspark.sql import Window as W

    order = W.partitionBy("tbl").orderBy("column_name")  # brand codes of one type: a bounded list
    rank = F.row_number().over(order)
    names = t.part.select(F.col("p_type").alias("tbl"), F.col("p_brand").alias("column_name"))
    short = names.withColumn("column_name", F.substring("column_name", 1, 7))
    return names.distinct().withColumn("position", rank), short.distinct().withColumn("position", rank)


# A short name starts several codes and goes to the first of them; no code starts two short names.
@query(
    "greedy_column_match",
    """WITH a AS (SELECT tbl, column_name, row_number() OVER (PARTITION BY tbl ORDER BY column_name) AS position
         FROM (SELECT DISTINCT p_type AS tbl, p_brand AS column_name FROM part))
       SELECT tbl, CAST(min(position) AS INTEGER) AS position, min(column_name) AS source_name, substr(column_name, 1, 7) AS target_name
       FROM a GROUP BY tbl, substr(column_name, 1, 7)""",
)
def greedy_column_match(t: Tables):
    a, b = _brand_lists(t)
    return M.greedy_column_match(a, b, ["tbl"])


@query(
    "list_difference",
    """WITH a AS (SELECT DISTINCT c_name AS a FROM customer),
       n AS (SELECT DISTINCT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS b FROM orders WHERE o_custkey IS NOT NULL)
       SELECT a FROM a WHERE NOT EXISTS (SELECT 1 FROM n WHERE starts_with(a, b) OR starts_with(b, a))
         AND NOT regexp_matches(a, '^(Customer#0000000|Customer#.*9$)')""",
)
def list_difference(t: Tables):
    b = t.orders.select(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("b"))
    a = t.customer.select(F.col("c_name").alias("a"))
    return M.list_difference(a, b, "a", "b", "prefix", ["Customer#0000000", "Customer#.*9$"])


@query(
    "list_difference_exact",
    """SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS a FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def list_difference_exact(t: Tables):
    a = t.customer.select(F.col("c_custkey").cast("string").alias("a"))
    b = t.supplier.select(F.col("s_suppkey").cast("string").alias("b"))
    return M.list_difference(a, b, "a", "b", "exact")


@query(
    "paired_key_join",
    """SELECT c_mktsegment, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders,
       round(sum(o_totalprice), 2) AS total FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def paired_key_join(t: Tables):
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("total")
    )
    joined = t.customer.join(per_customer, "c_custkey", "left")
    return joined.groupBy("c_mktsegment").agg(
        F.count("c_custkey").alias("customers"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orders"),
        rnd(F.sum("total"), 2).alias("total"),
    )
