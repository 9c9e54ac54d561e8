"""Reconciliation queries: schemas, profiles, records, values, dates and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from reconkit.functions import text
from reconkit.operators import profile as P, records as R, schema as S, sketches as K, temporal as D
from reconkit.operators.quantiles import long_values
from reconkit.plans import align, analysis, compare, versions as V
from reconkit.queries import LINES, ORACLE, TARGET, Tables, altered_lineitem, altered_orders, query, rnd
from reconkit.session import checkpointed, scratch_path

KEYS = ["l_orderkey", "l_linenumber"]


# ---- records and values ---------------------------------------------------

MATCHED = f"""WITH {TARGET},
 s AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1),
 g AS (SELECT o_orderkey, count(*) AS n FROM target GROUP BY 1)
"""


@query(
    "match_records",
    f"""{MATCHED} SELECT coalesce(s.o_orderkey, g.o_orderkey) AS o_orderkey, coalesce(s.n, 0) AS s_rows,
        coalesce(g.n, 0) AS t_rows FROM s FULL JOIN g ON s.o_orderkey = g.o_orderkey""",
)
def match_records(t: Tables):
    return R.match_records(t.orders, altered_orders(t), ["o_orderkey"])


SUMMARY = """SELECT CAST(count_if(b.k IS NULL) AS BIGINT) AS source_only, CAST(count_if(a.k IS NULL) AS BIGINT) AS target_only,
  CAST(count_if(a.k IS NOT NULL AND b.k IS NOT NULL) AS BIGINT) AS common_keys,
  CAST(sum(coalesce(a.n, 0)) AS BIGINT) AS source_rows, CAST(sum(coalesce(b.n, 0)) AS BIGINT) AS target_rows,
  CAST(count_if(a.n > 1 OR b.n > 1) AS BIGINT) AS duplicate_keys,
  round(count_if(a.k IS NOT NULL AND b.k IS NOT NULL) / greatest(sum(coalesce(a.n, 0)), sum(coalesce(b.n, 0))), 6) AS match_rate
  FROM a FULL JOIN b ON a.k = b.k"""


@query(
    "match_summary",
    f"""WITH {TARGET}, a AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1),
        b AS (SELECT o_orderkey AS k, count(*) AS n FROM target GROUP BY 1) {SUMMARY}""",
)
def match_summary(t: Tables):
    out = R.match_summary(R.match_records(t.orders, altered_orders(t), ["o_orderkey"]))
    return out.withColumn("match_rate", rnd("match_rate"))


@query(
    "match_rate",
    f"""WITH {LINES}, a AS (SELECT (l_orderkey, l_linenumber) AS k, count(*) AS n FROM lineitem GROUP BY 1),
        b AS (SELECT (l_orderkey, l_linenumber) AS k, count(*) AS n FROM lines GROUP BY 1) {SUMMARY}""",
)
def match_rate(t: Tables):
    out = R.match_summary(R.match_records(t.lineitem, altered_lineitem(t), KEYS))
    return out.withColumn("match_rate", rnd("match_rate"))


@query(
    "value_differences",
    f"""WITH {TARGET}, j AS (SELECT s.o_custkey AS a1, t.o_custkey AS b1, s.o_orderstatus AS a2, t.o_orderstatus AS b2,
          s.o_totalprice AS a3, t.o_totalprice AS b3, s.o_orderdate AS a4, t.o_orderdate AS b4,
          s.o_orderpriority AS a5, t.o_orderpriority AS b5 FROM orders s JOIN target t ON s.o_orderkey = t.o_orderkey)
        SELECT 'o_custkey' AS column_name, count(*) AS compared, CAST(count_if(a1 IS DISTINCT FROM b1) AS BIGINT) AS different FROM j
        UNION ALL SELECT 'o_orderstatus', count(*), CAST(count_if(a2 IS DISTINCT FROM b2) AS BIGINT) FROM j
        UNION ALL SELECT 'o_totalprice', count(*), CAST(count_if(abs(a3 - b3) > 1e-6) AS BIGINT) FROM j
        UNION ALL SELECT 'o_orderdate', count(*), CAST(count_if(a4 IS DISTINCT FROM b4) AS BIGINT) FROM j
        UNION ALL SELECT 'o_orderpriority', count(*), CAST(count_if(a5 IS DISTINCT FROM b5) AS BIGINT) FROM j""",
)
def value_differences(t: Tables):
    return R.value_differences(t.orders, altered_orders(t), ["o_orderkey"])


@query(
    "value_differences_duplicate_keys",
    f"""WITH {LINES}, j AS (SELECT s.l_partkey AS a1, t.l_partkey AS b1, s.l_discount AS a2, t.l_discount AS b2,
          s.l_returnflag AS a3, t.l_returnflag AS b3 FROM lineitem s JOIN lines t USING (l_orderkey, l_linenumber))
        SELECT 'l_partkey' AS column_name, count(*) AS compared, CAST(count_if(a1 IS DISTINCT FROM b1) AS BIGINT) AS different FROM j
        UNION ALL SELECT 'l_discount', count(*), CAST(count_if(abs(a2 - b2) > 1e-6) AS BIGINT) FROM j
        UNION ALL SELECT 'l_returnflag', count(*), CAST(count_if(a3 IS DISTINCT FROM b3) AS BIGINT) FROM j""",
)
def value_differences_duplicate_keys(t: Tables):
    columns = ["l_partkey", "l_discount", "l_returnflag"]
    return R.value_differences(t.lineitem, altered_lineitem(t), KEYS, columns)


def _versions(t: Tables) -> tuple[str, str]:
    """``orders`` and its altered copy as stored versions with the same key ranges."""
    source = V.write_version(t.orders, scratch_path(t.spark, "version"), ["o_orderkey"], leaves=256)
    return source, V.write_version(altered_orders(t), scratch_path(t.spark, "version"), ["o_orderkey"], like=source)


@query("value_differences_by_digest", ORACLE["value_differences"])
def value_differences_by_digest(t: Tables):
    return V.value_differences_by_digest(t.spark, *_versions(t))


@query("value_differences_by_digest_duplicate_keys", ORACLE["value_differences_duplicate_keys"])
def value_differences_by_digest_duplicate_keys(t: Tables):
    """The hot first key of a two-part key is spread over ranges by the whole key."""
    source = V.write_version(t.lineitem, scratch_path(t.spark, "version"), KEYS, leaves=256)
    target = V.write_version(altered_lineitem(t), scratch_path(t.spark, "version"), KEYS, like=source)
    return V.value_differences_by_digest(t.spark, source, target, ["l_partkey", "l_discount", "l_returnflag"])


@query(
    "column_compare_by_digest",
    """WITH n AS (SELECT count(*) AS n, count_if(o_totalprice >= 450000) AS changed FROM orders)
       SELECT c AS column_name, n AS source_values, n AS target_values, true AS type_match, c <> 'o_totalprice' OR changed = 0 AS values_match
       FROM n, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) x(c)""",
)
def column_compare_by_digest(t: Tables):
    """Only the column whose digests differ is read and compared."""
    price = F.col("o_totalprice")
    target = t.orders.withColumn("o_totalprice", F.when(price >= 450000, price * 2).otherwise(price))
    source = V.write_version(t.orders, scratch_path(t.spark, "version"), ["o_orderkey"], leaves=256)
    target = V.write_version(target, scratch_path(t.spark, "version"), ["o_orderkey"], like=source)
    return V.column_compare_by_digest(t.spark, source, target).drop("unequal")


@query(
    "unmatched_records_by_digest",
    f"""{MATCHED} SELECT coalesce(s.o_orderkey, g.o_orderkey) AS o_orderkey, coalesce(s.n, 0) AS s_rows,
        coalesce(g.n, 0) AS t_rows FROM s FULL JOIN g ON s.o_orderkey = g.o_orderkey WHERE s.n IS DISTINCT FROM g.n""",
)
def unmatched_records_by_digest(t: Tables):
    return V.unmatched_records_by_digest(t.spark, *_versions(t))


@query(
    "difference_sample",
    f"""WITH {TARGET}, j AS (SELECT s.o_orderkey, s.o_orderstatus AS a2, t.o_orderstatus AS b2,
          s.o_orderpriority AS a5, t.o_orderpriority AS b5 FROM orders s JOIN target t ON s.o_orderkey = t.o_orderkey),
        d AS (SELECT o_orderkey, 'o_orderstatus' AS column_name, a2 AS source_value, b2 AS target_value FROM j WHERE a2 IS DISTINCT FROM b2
          UNION ALL SELECT o_orderkey, 'o_orderpriority', a5, b5 FROM j WHERE a5 IS DISTINCT FROM b5)
        SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY o_orderkey) <= 100""",
)
def difference_sample(t: Tables):
    return R.difference_sample(t.orders, altered_orders(t), ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


def _extremes_sql(c: str) -> str:
    """Differing pairs of the smallest against the largest value, and of a null against a value, per order."""
    return f"""SELECT l_orderkey, '{c}' AS column_name, unnest(list_distinct(list_filter([
        CASE WHEN sn > 0 AND tn > 0 AND slo IS DISTINCT FROM thi THEN {{'a': CAST(slo AS VARCHAR), 'b': CAST(thi AS VARCHAR)}} END,
        CASE WHEN sn > 0 AND tn > 0 AND shi IS DISTINCT FROM tlo THEN {{'a': CAST(shi AS VARCHAR), 'b': CAST(tlo AS VARCHAR)}} END,
        CASE WHEN sn < srows AND tn > 0 THEN {{'a': NULL, 'b': CAST(tlo AS VARCHAR)}} END,
        CASE WHEN tn < trows AND sn > 0 THEN {{'a': CAST(slo AS VARCHAR), 'b': NULL}} END], lambda x: x IS NOT NULL))) AS p
      FROM (SELECT l_orderkey, min({c}) AS slo, max({c}) AS shi, count({c}) AS sn, count(*) AS srows FROM lineitem GROUP BY 1)
      JOIN (SELECT l_orderkey, min({c}) AS tlo, max({c}) AS thi, count({c}) AS tn, count(*) AS trows FROM lines GROUP BY 1) USING (l_orderkey)"""


@query(
    "difference_sample_duplicate_keys",
    f"""WITH {LINES}, d AS ({_extremes_sql('l_returnflag')} UNION ALL {_extremes_sql('l_linenumber')})
        SELECT l_orderkey, column_name, p.a AS source_value, p.b AS target_value FROM d
        QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY l_orderkey, p.a NULLS LAST, p.b NULLS LAST) <= 100""",
)
def difference_sample_duplicate_keys(t: Tables):
    return R.difference_sample(t.lineitem, altered_lineitem(t), ["l_orderkey"], ["l_returnflag", "l_linenumber"])


def _special(t: Tables, target: bool):
    """Orders with NaN, infinite, missing and decimal values, some of them changed in the target."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    step = F.when(key % 7 == 0, nan).when(key % 7 == 1, inf).when(key % 7 == 2, -inf)
    number = F.when(key % 11 == 5, None).otherwise(step.otherwise(price))
    if target:
        number = F.when(key % 13 == 0, 5.0).when(key % 17 == 0, nan).when(key % 19 == 0, inf).otherwise(number)
    cents = (price + F.when(key % 5 == 0, 0.01).otherwise(0.0) * int(target)).cast("decimal(14,4)")
    tiny = cents.cast("decimal(20,9)") + F.lit(0.0000001).cast("decimal(20,9)") * int(target)
    return t.orders.select("o_orderkey", number.alias("number"), cents.alias("cents"), tiny.alias("tiny"))


# NaN is missing, infinities are values: -1 stands for missing, 1e300 and -1e300 for the infinities.
SPECIAL = """
s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 5 THEN NULL WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 1e300
        WHEN o_orderkey % 7 = 2 THEN -1e300 ELSE o_totalprice END AS x FROM orders),
g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 5.0 WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 1e300 ELSE x END AS x FROM s)
"""


@query(
    "value_differences_special",
    f"""WITH {SPECIAL}, n AS (SELECT count(*) AS n FROM orders)
        SELECT 'number' AS column_name, n AS compared, (SELECT count(*) FROM s JOIN g USING (o_orderkey) WHERE s.x IS DISTINCT FROM g.x
          AND (s.x IS NULL OR g.x IS NULL OR abs(s.x - g.x) > 1e-6)) AS different FROM n
        UNION ALL SELECT 'cents', n, (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) FROM n
        UNION ALL SELECT 'tiny', n, (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) FROM n""",
)
def value_differences_special(t: Tables):
    return R.value_differences(_special(t, False), _special(t, True), ["o_orderkey"])


@query(
    "value_differences_special_repeated",
    f"""WITH {SPECIAL}, a AS (SELECT o_orderkey // 2 AS k, x FROM s), b AS (SELECT o_orderkey // 2 AS k, x FROM g)
        SELECT 'number' AS column_name, count(*) AS compared, CAST(count_if(a.x IS DISTINCT FROM b.x
          AND (a.x IS NULL OR b.x IS NULL OR abs(a.x - b.x) > 1e-6)) AS BIGINT) AS different FROM a JOIN b USING (k)""",
)
def value_differences_special_repeated(t: Tables):
    half = lambda df: df.select(F.expr("o_orderkey div 2").alias("k"), "number")
    return R.value_differences(half(_special(t, False)), half(_special(t, True)), ["k"])


@query(
    "column_multiset_compare_nan",
    f"""WITH {SPECIAL}, a AS (SELECT x, row_number() OVER (ORDER BY x) AS r FROM s WHERE x IS NOT NULL),
          b AS (SELECT x, row_number() OVER (ORDER BY x) AS r FROM g WHERE x IS NOT NULL),
          nulls AS (SELECT count_if(s.x IS NULL) AS a, count_if(g.x IS NULL) AS b FROM s JOIN g USING (o_orderkey))
        SELECT 'number' AS column_name, (SELECT count(*) FROM s) AS source_values, (SELECT count(*) FROM g) AS target_values, true AS type_match,
          nulls.a = nulls.b AND NOT EXISTS (SELECT 1 FROM a FULL JOIN b USING (r) WHERE a.x IS NULL OR b.x IS NULL
            OR (a.x <> b.x AND (abs(a.x) = 1e300 OR abs(b.x) = 1e300 OR abs(a.x - b.x) > greatest(1e-5 * greatest(abs(a.x), abs(b.x)), 1e-8)))) AS values_match
        FROM nulls""",
)
def column_multiset_compare_nan(t: Tables):
    pick = lambda target: _special(t, target).select("number")
    return align.column_multiset_compare(pick(False), pick(True)).drop("unequal")


@query(
    "column_profile_nan",
    f"""WITH {SPECIAL} SELECT 'number' AS column_name, count(*) AS row_count, CAST(count_if(x IS NULL) AS BIGINT) AS null_count,
        count(DISTINCT x) AS unique_count, min(x) AS min_value, max(x) AS max_value, round(avg(x), 4) AS mean_value
        FROM (SELECT CASE WHEN abs(x) < 1e299 THEN x END AS x FROM s)""",
)
def column_profile_nan(t: Tables):
    finite = F.when(F.abs("number") < float("inf"), F.col("number")).otherwise(F.lit(float("nan")))
    out = P.column_profile(_special(t, False).select(finite.alias("number")))
    keep = ["column_name", "row_count", "null_count", "unique_count", "min_value", "max_value"]
    return out.select(*keep, rnd("mean_value", 4).alias("mean_value"))


@query(
    "compare_tables_empty_side",
    """SELECT 'orders' AS table_name, count(*) AS source_count, CAST(0 AS BIGINT) AS target_count, count(*) AS source_only,
       CAST(0 AS BIGINT) AS different_values, 'RECORD_COUNT_MISMATCH' AS match_status FROM orders""",
)
def compare_tables_empty_side(t: Tables):
    """The whole table against an empty copy with a column that is null throughout."""
    source = t.orders.withColumn("nothing", F.lit(None).cast("double"))
    out = compare.compare_tables(source, source.filter("o_orderkey IS NULL"), "orders", ["o_orderkey"]).summary
    return out.select("table_name", "source_count", "target_count", "source_only", F.coalesce("different_values", F.lit(0)).alias("different_values"), "match_status")


@query(
    "key_intersect_except",
    f"""WITH {TARGET} SELECT 'both' AS part, count(*) AS n FROM (SELECT o_orderkey FROM orders INTERSECT SELECT o_orderkey FROM target)
        UNION ALL SELECT 'source', count(*) FROM (SELECT o_orderkey FROM orders EXCEPT SELECT o_orderkey FROM target)
        UNION ALL SELECT 'target', count(*) FROM (SELECT o_orderkey FROM target EXCEPT SELECT o_orderkey FROM orders)""",
)
def key_intersect_except(t: Tables):
    from reconkit.operators.sets import key_except, key_intersect

    a, b = t.orders, altered_orders(t)
    count = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    both = count(key_intersect(a, b, ["o_orderkey"]), "both")
    return both.unionByName(count(key_except(a, b, ["o_orderkey"]), "source")).unionByName(
        count(key_except(b, a, ["o_orderkey"]), "target")
    )


# ---- schemas --------------------------------------------------------------


def _target_table(t: Tables):
    """The altered orders as the target would declare them: one column renamed, one dropped, one added."""
    g = altered_orders(t)
    return g.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderstatus").alias("o_orderstatus_cd"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.current_date().alias("etl_date"),
    )


NON_NULL = f"""WITH {TARGET},
 s AS (SELECT 'o_orderkey' AS column_name, 'bigint' AS t, 1 AS p, count(o_orderkey) AS n FROM orders
   UNION ALL SELECT 'o_custkey', 'bigint', 2, count(o_custkey) FROM orders
   UNION ALL SELECT 'o_orderstatus', 'string', 3, count(o_orderstatus) FROM orders
   UNION ALL SELECT 'o_totalprice', 'double', 4, count(o_totalprice) FROM orders
   UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', 5, count(o_orderdate) FROM orders
   UNION ALL SELECT 'o_orderpriority', 'string', 6, count(o_orderpriority) FROM orders),
 g AS (SELECT 'o_orderkey' AS column_name, 'bigint' AS t, 1 AS p, count(o_orderkey) AS n FROM target
   UNION ALL SELECT 'o_custkey', 'string', 2, count(o_custkey) FROM target
   UNION ALL SELECT 'o_orderstatus_cd', 'string', 3, count(o_orderstatus) FROM target
   UNION ALL SELECT 'o_totalprice', 'decimal(12,2)', 4, count(o_totalprice) FROM target
   UNION ALL SELECT 'o_orderdate', 'date', 5, count(o_orderdate) FROM target
   UNION ALL SELECT 'etl_date', 'date', 6, count(*) FROM target)
"""


def _schemas(t: Tables):
    return (
        S.schema_as_table(t.orders, "orders", counts=True),
        S.schema_as_table(_target_table(t), "orders", counts=True),
    )


@query(
    "schema_as_table",
    f"{NON_NULL} SELECT 'orders' AS tbl, p AS position, column_name, t AS data_type, n AS non_null FROM g",
)
def schema_as_table(t: Tables):
    return _schemas(t)[1]


@query(
    "schema_diff",
    f"""{NON_NULL} SELECT coalesce(s.column_name, g.column_name) AS column_name,
        s.t AS source_data_type, g.t AS target_data_type, s.n AS source_non_null, g.n AS target_non_null,
        CASE WHEN g.t IS NULL THEN 'source_only' WHEN s.t IS NULL THEN 'target_only' ELSE 'common' END AS side
        FROM s FULL JOIN g ON s.column_name = g.column_name""",
)
def schema_diff(t: Tables):
    return S.schema_diff(*_schemas(t)).drop("tbl", "source_position", "target_position")


@query(
    "dtype_diff",
    f"""{NON_NULL} SELECT column_name, s.t AS source_data_type, g.t AS target_data_type, s.n AS source_non_null,
        g.n AS target_non_null FROM s JOIN g USING (column_name) WHERE s.t <> g.t""",
)
def dtype_diff(t: Tables):
    return S.dtype_diff(*_schemas(t)).drop("tbl", "side", "source_position", "target_position")


def _type_pairs(t: Tables):
    """Type texts built from part sizes: every declared pair of the rule table occurs."""
    n = F.col("p_size").cast("string")
    m = F.when(F.col("p_partkey") > F.col("p_size") * 20, n).otherwise("7")
    src = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("NUMBER(12,"), n, F.lit(")")))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit("VARCHAR2("), n, F.lit(")")))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("CHAR("), n, F.lit(")")))
        .when(F.col("p_size") < 25, "DATE")
        .otherwise("TIMESTAMP(6)")
    )
    tgt = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("decimal(38,"), m, F.lit(")")))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit("varchar("), m, F.lit(")")))
        .when(F.col("p_type") == "PROMO", F.when(F.col("p_retailprice") < 950, F.lit("VARCHAR(9)")).otherwise("char(9)"))
        .when(F.col("p_retailprice") < 950, "date")
        .otherwise("timestamp")
    )
    return t.part.select("p_partkey", src.alias("src"), tgt.alias("tgt"))


TYPE_PAIRS = """pairs AS (SELECT p_partkey, p_size,
  CASE WHEN p_partkey > p_size * 20 THEN p_size ELSE 7 END AS m, p_type, p_retailprice FROM part)"""


@query(
    "type_compatible",
    f"""WITH {TYPE_PAIRS} SELECT p_partkey, CASE
          WHEN p_type IN ('ECONOMY', 'STANDARD') THEN p_size = m
          WHEN p_type = 'PROMO' THEN p_size = 1 OR p_retailprice >= 950
          WHEN p_size < 25 THEN true ELSE p_retailprice >= 950 END AS compatible FROM pairs""",
)
def type_compatible(t: Tables):
    from reconkit.functions.types import type_compatible as ok

    return _type_pairs(t).select("p_partkey", ok(F.col("src"), F.col("tgt")).alias("compatible"))


@query(
    "regexp_type_parts",
    f"""WITH {TYPE_PAIRS} SELECT p_partkey,
        CASE WHEN p_type = 'ECONOMY' THEN 'NUMBER' WHEN p_type = 'STANDARD' THEN 'VARCHAR2' WHEN p_type = 'PROMO' THEN 'CHAR'
          WHEN p_size < 25 THEN 'DATE' ELSE 'TIMESTAMP' END AS base,
        CAST(CASE WHEN p_type = 'ECONOMY' THEN 12 WHEN p_type IN ('STANDARD', 'PROMO') THEN p_size
          WHEN p_size < 25 THEN NULL ELSE 6 END AS INTEGER) AS size,
        CAST(CASE WHEN p_type = 'ECONOMY' THEN p_size END AS INTEGER) AS scale FROM pairs""",
)
def regexp_type_parts(t: Tables):
    from reconkit.functions.types import type_parts

    parts = type_parts(F.col("src"))
    return _type_pairs(t).select("p_partkey", *[c.alias(n) for n, c in parts.items()])


def _merge_inputs(t: Tables):
    mapping = {"o_orderkey": "o_orderkey", "o_totalprice": "o_totalprice", "o_orderdate": "o_orderdate", "o_custkey": "o_custkey"}
    source = S.schema_as_table(t.orders, "orders", mapping, source_types=True, counts=True)
    return source, S.schema_as_table(_target_table(t), "orders", counts=True)


@query(
    "schema_merge",
    f"""{NON_NULL},
        m AS (SELECT * FROM (VALUES ('o_orderkey', 'o_orderkey', 'NUMBER(19)', false, false), ('o_custkey', 'o_custkey', 'NUMBER(19)', false, false),
          ('o_orderstatus', 'o_orderstatus_cd', 'CLOB', true, false), ('o_totalprice', 'o_totalprice', 'NUMBER', false, false),
          ('o_orderdate', 'o_orderdate', 'TIMESTAMP(6)', false, false), ('o_orderpriority', NULL, 'CLOB', false, NULL)) v(s, t, st, auto_mapped, ok))
        SELECT m.s AS source_name, m.st AS source_type, g.column_name AS target_name, g.t AS target_type,
          CASE WHEN g.t IS NULL THEN 'source_only' WHEN m.s IS NULL THEN 'target_only' ELSE 'both' END AS side,
          coalesce(m.auto_mapped, false) AS auto_mapped, m.ok AS type_match, s.n AS source_non_null, g.n AS target_non_null
        FROM m LEFT JOIN s ON s.column_name = m.s FULL JOIN g ON g.column_name = m.t""",
)
def schema_merge(t: Tables):
    source, target = _merge_inputs(t)
    merged = S.schema_merge(source, target)
    counts = lambda df, side: df.select(
        F.col("column_name").alias(f"{side}_name"), F.col("non_null").alias(f"{side}_non_null")
    )
    out = merged.join(counts(source, "source"), "source_name", "left").join(counts(target, "target"), "target_name", "left")
    return out.drop("tbl")


def _row_counts(t: Tables):
    a = t.orders.agg(F.count(F.lit(1)).alias("source_rows"))
    b = altered_orders(t).agg(F.count(F.lit(1)).alias("target_rows"))
    return a.withColumn("tbl", F.lit("orders")).join(b.withColumn("tbl", F.lit("orders")), "tbl")


@query(
    "metadata_diff",
    f"""WITH {TARGET}, c AS (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM target) AS b)
        SELECT 'orders' AS tbl, a <> b AS row_unmatch, 'source(' || a || ') : target(' || b || ')' AS row_details,
          'source(6) : target(6)' AS col_details,
          'CLOB->string; NUMBER(19)->bigint; NUMBER(19)->string; NUMBER->decimal(12,2); TIMESTAMP(6)->date' AS type_details,
          true AS type_unmatch, 'O_ORDERPRIORITY' AS source_unique, 'etl_date' AS target_unique,
          'O_ORDERSTATUS->o_orderstatus_cd' AS uncaptured FROM c""",
)
def metadata_diff(t: Tables):
    source, target = _merge_inputs(t)
    return S.metadata_diff(source.drop("non_null"), target.drop("non_null"), _row_counts(t))


@query(
    "metadata_diff_no_mapping",
    f"""WITH {TARGET}, c AS (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM target) AS b)
        SELECT 'orders' AS tbl, a <> b AS row_unmatch, 'source(' || a || ') : target(' || b || ')' AS row_details,
          'source(6) : target(6)' AS col_details, 'O_ORDERPRIORITY' AS source_unique, 'etl_date' AS target_unique,
          'O_CUSTKEY->o_custkey; O_ORDERDATE->o_orderdate; O_ORDERKEY->o_orderkey; O_ORDERSTATUS->o_orderstatus_cd; O_TOTALPRICE->o_totalprice' AS uncaptured,
          'O_CUSTKEY:NUMBER(19)->o_custkey:string; O_ORDERDATE:TIMESTAMP(6)->o_orderdate:date; O_ORDERKEY:NUMBER(19)->o_orderkey:bigint; O_ORDERSTATUS:CLOB->o_orderstatus_cd:string; O_TOTALPRICE:NUMBER->o_totalprice:decimal(12,2)' AS carried_types FROM c""",
)
def metadata_diff_no_mapping(t: Tables):
    source, target = _merge_inputs(t)
    return S.metadata_diff_no_mapping(source.drop("non_null"), target.drop("non_null"), _row_counts(t))


@query(
    "clean_column_lists",
    """SELECT p_brand, coalesce(string_agg(DISTINCT p_type, '; ' ORDER BY p_type) FILTER (WHERE p_type NOT IN ('PROMO', 'ECONOMY')), '') AS source_unique,
       coalesce(string_agg(DISTINCT lower(p_type), '; ' ORDER BY lower(p_type)) FILTER (WHERE p_type <> 'STANDARD'), '') AS target_unique
       FROM part GROUP BY 1""",
)
def clean_column_lists(t: Tables):
    """Name lists per brand (part types: a short fixed domain), with known names taken out."""
    lists = t.part.groupBy("p_brand").agg(
        text.joined_list(F.col("p_type")).alias("source_unique"),
        text.joined_list(F.lower("p_type")).alias("target_unique"),
    )
    return S.clean_column_lists(lists, ["PROMO", "ECONOMY"], ["standard"])


@query(
    "pull_status",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS n, count_if(o_orderstatus = 'F') AS f, count_if(o_orderstatus = 'P') AS p,
         count_if(o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY 1)
       SELECT CASE WHEN n > 2 AND p > 0 AND f = 0 THEN 'Empty Target Table' WHEN n < 5 THEN 'Nonexisting Source Table'
         WHEN u = 0 THEN 'Column Mapping Not Provided' WHEN f = 1 THEN 'Nonexisting Date Variable in Source'
         WHEN u = 1 THEN 'Empty Source Table' WHEN n <= 2 THEN 'Nonexisting Target Table'
         WHEN p = 0 THEN 'Nonexisting Date Variable in Target' ELSE 'Successful Data Access' END AS status, count(*) AS n
       FROM a GROUP BY 1""",
)
def pull_status(t: Tables):
    """Availability facts of one table per customer, derived from their orders."""
    a = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_orderstatus") == "P").alias("p"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u"),
    )
    n, f, p, u = (F.col(c) for c in "nfpu")
    status = S.pull_status(n >= 5, u > 0, f != 1, u - 1, n > 2, p > 0, f)
    return a.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


# ---- profiles -------------------------------------------------------------


def _profile_sql(table: str, cols: list[tuple[str, str, str]]) -> str:
    parts = []
    for name, kind, dtype in cols:
        num = (lambda e: e) if kind == "n" else (lambda e: "CAST(NULL AS DOUBLE)")
        txt = (lambda e: e) if kind == "s" else (lambda e: "NULL")
        dat = (lambda e: e) if kind == "d" else (lambda e: "NULL")
        parts.append(
            f"""SELECT '{name}' AS column_name, '{dtype}' AS data_type, count(*) AS row_count,
            count(*) - count({name}) AS null_count, count(DISTINCT {name}) AS unique_count,
            {num(f'CAST(min({name}) AS DOUBLE)')} AS min_value, {num(f'CAST(max({name}) AS DOUBLE)')} AS max_value,
            {num(f'round(avg({name}), 4)')} AS mean_value, {num(f'round(stddev_samp({name}), 4)')} AS std_value,
            {num(f'round(quantile_cont(CAST({name} AS DOUBLE), 0.5), 4)')} AS median_value,
            CAST({txt(f'min(length({name}))')} AS BIGINT) AS min_length, CAST({txt(f'max(length({name}))')} AS BIGINT) AS max_length,
            CAST({txt(f'round(avg(length({name})), 6)')} AS DOUBLE) AS avg_length,
            CAST({dat(f"strftime(min({name}), '%Y-%m-%d')")} AS VARCHAR) AS min_date,
            CAST({dat(f"strftime(max({name}), '%Y-%m-%d')")} AS VARCHAR) AS max_date,
            CAST({dat(f"datediff('day', min({name}), max({name}))")} AS BIGINT) AS date_range_days,
            round((count(*) - count({name})) * 100.0 / count(*), 4) AS null_percentage,
            round(count(DISTINCT {name}) * 100.0 / count(*), 4) AS unique_percentage FROM {table}"""
        )
    return " UNION ALL ".join(parts)


ORDER_COLUMNS = [
    ("o_orderkey", "n", "bigint"), ("o_custkey", "n", "bigint"), ("o_orderstatus", "s", "string"),
    ("o_totalprice", "n", "double"), ("o_orderdate", "d", "timestamp_ntz"), ("o_orderpriority", "s", "string"),
]
LINE_COLUMNS = [
    ("l_orderkey", "n", "bigint"), ("l_partkey", "n", "bigint"), ("l_suppkey", "n", "bigint"), ("l_linenumber", "n", "int"),
    ("l_quantity", "n", "double"), ("l_extendedprice", "n", "double"), ("l_discount", "n", "double"), ("l_tax", "n", "double"),
    ("l_returnflag", "s", "string"), ("l_linestatus", "s", "string"), ("l_shipdate", "d", "timestamp_ntz"),
]


def _rounded(p):
    out = {c: rnd(c, 4) for c in ("mean_value", "std_value", "median_value", "null_percentage", "unique_percentage")}
    return p.withColumns({**out, "avg_length": rnd("avg_length")})


@query("column_profile", _profile_sql("lineitem", LINE_COLUMNS))
def column_profile(t: Tables):
    return _rounded(P.column_profile(t.lineitem))


@query("column_profile_nulls", f"WITH {TARGET} " + _profile_sql("target", ORDER_COLUMNS))
def column_profile_nulls(t: Tables):
    return _rounded(P.column_profile(altered_orders(t)))


@query(
    "profile_from_sketches",
    f"""SELECT column_name, data_type, row_count, null_count, min_value, max_value, mean_value, std_value, min_length, max_length, avg_length,
        min_date, max_date, date_range_days, null_percentage, true AS median_close, true AS distinct_close
        FROM ({_profile_sql('lineitem', LINE_COLUMNS)})""",
)
def profile_from_sketches(t: Tables):
    """Monthly sketches, stored and merged; estimates are held against exact ranks and counts."""
    path = scratch_path(t.spark, "sketches")
    K.column_sketches(t.lineitem, F.date_format("l_shipdate", "yyyy-MM")).write.parquet(path)
    profile = checkpointed(K.profile_from_sketches(K.merge_sketches(t.spark.read.parquet(path))))
    medians = profile.filter("median_value IS NOT NULL").select(F.col("column_name").alias("variable"), "median_value")
    long = long_values(t.lineitem, [c for c, kind, _ in LINE_COLUMNS if kind == "n"]).join(F.broadcast(medians), "variable")  # one row a column
    below, upto = (F.count_if(c) / F.count(F.lit(1)) for c in (F.col("value") < F.col("median_value"), F.col("value") <= F.col("median_value")))
    close = (below <= 0.5 + K.RANK_ERROR) & (upto >= 0.5 - K.RANK_ERROR)
    ranks = long.groupBy(F.col("variable").alias("column_name")).agg(close.alias("median_close"))
    exact = P.column_profile(t.lineitem, median=False).select("column_name", F.col("unique_count").alias("exact"))
    met = profile.join(ranks, "column_name", "left").join(exact, "column_name")
    met = met.withColumns(
        {
            "median_close": F.coalesce("median_close", F.lit(True)),
            "distinct_close": F.abs(F.col("unique_count") - F.col("exact")) <= 0.08 * F.col("exact"),
            "mean_value": rnd("mean_value", 4), "std_value": rnd("std_value", 4), "avg_length": rnd("avg_length"), "null_percentage": rnd("null_percentage", 4),
        }
    )
    return met.drop("exact", "unique_count", "unique_percentage", "median_value")


@query(
    "profile_of_period",
    f"""WITH days AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01')
        SELECT column_name, row_count, null_count, min_value, max_value, mean_value, std_value, max_length, min_date, max_date
        FROM ({_profile_sql('days', LINE_COLUMNS)})""",
)
def profile_of_period(t: Tables):
    """The profile of a month from the sketches of its days."""
    path = scratch_path(t.spark, "sketches")
    K.column_sketches(t.lineitem, F.to_date("l_shipdate")).write.parquet(path)
    month = t.spark.read.parquet(path).filter("period >= DATE'1997-03-01' AND period < DATE'1997-04-01'")
    out = K.profile_from_sketches(K.merge_sketches(month))
    rounded = {c: rnd(c, 4) for c in ("mean_value", "std_value")}
    return out.withColumns(rounded).select(
        "column_name", "row_count", "null_count", "min_value", "max_value", "mean_value", "std_value", "max_length", "min_date", "max_date"
    )


PROFILE_PAIR = f"""WITH {TARGET}, a AS ({_profile_sql('orders', ORDER_COLUMNS)}), b AS ({_profile_sql('target', ORDER_COLUMNS)}),
 j AS (SELECT a.column_name, b.row_count - a.row_count AS rd, b.null_count - a.null_count AS nd, b.unique_count - a.unique_count AS ud,
   b.min_value - a.min_value AS mind, b.max_value - a.max_value AS maxd FROM a JOIN b USING (column_name))
"""


def _profiles(t: Tables):
    return P.profile_compare(P.column_profile(t.orders, median=False), P.column_profile(altered_orders(t), median=False))


@query(
    "profile_compare",
    f"""{PROFILE_PAIR} SELECT column_name, CAST(rd AS DOUBLE) AS row_count_diff, CAST(nd AS DOUBLE) AS null_count_diff,
        CAST(ud AS DOUBLE) AS unique_count_diff, round(mind, 4) AS min_value_diff, round(maxd, 4) AS max_value_diff,
        rd = 0 AND nd = 0 AND ud = 0 AS stats_match FROM j""",
)
def profile_compare(t: Tables):
    out = _profiles(t)
    return out.select(
        "column_name", "row_count_diff", "null_count_diff", "unique_count_diff",
        rnd("min_value_diff", 4).alias("min_value_diff"), rnd("max_value_diff", 4).alias("max_value_diff"), "stats_match",
    )


def _match_sql(stat: str, of: str) -> str:
    """Difference and match of one statistic, over the columns of ``orders``."""
    parts = []
    for c, kind, _ in ORDER_COLUMNS:
        value = of.format(c=c) if kind == "n" or stat.endswith("count") else "CAST(any_value(NULL) AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, (SELECT {value} FROM orders) AS a, (SELECT {value} FROM target) AS b")
    return f"""(SELECT column_name, CAST(b - a AS DOUBLE) AS {stat}_diff, coalesce(abs(b - a) < 0.001, a IS NULL AND b IS NULL) AS {stat}_match
      FROM ({' UNION ALL '.join(parts)}))"""


MATCHED_STATS = {
    "row_count": "count(*)", "null_count": "count(*) - count({c})", "unique_count": "count(DISTINCT {c})",
    "min_value": "min({c})::DOUBLE", "max_value": "max({c})::DOUBLE", "mean_value": "avg({c})",
}


@query(
    "profile_compare_matches",
    f"""WITH {TARGET} SELECT column_name, {', '.join(f'{c}_match' for c in MATCHED_STATS)}, round(mean_value_diff, 4) AS mean_value_diff,
        row_count_match AND null_count_match AND unique_count_match AS stats_match
        FROM {' JOIN '.join(_match_sql(c, e) + (' USING (column_name)' if i else '') for i, (c, e) in enumerate(MATCHED_STATS.items()))}""",
)
def profile_compare_matches(t: Tables):
    """Every match mark and the difference of the means."""
    out = _profiles(t)
    return out.select("column_name", *[f"{c}_match" for c in P.COMPARED], rnd("mean_value_diff", 4).alias("mean_value_diff"), "stats_match")


@query(
    "profile_report",
    f"""{PROFILE_PAIR} SELECT 'orders' AS table_name, count(*) AS total_columns,
        CAST(count_if(rd = 0 AND nd = 0 AND ud = 0) AS BIGINT) AS matching_columns,
        round((count(*) - count_if(rd = 0 AND nd = 0 AND ud = 0)) * 100.0 / count(*), 4) AS mismatch_percentage,
        string_agg(CASE WHEN NOT (rd = 0 AND nd = 0 AND ud = 0) THEN column_name END, '; ' ORDER BY column_name) AS mismatched_columns FROM j""",
)
def profile_report(t: Tables):
    out = P.profile_report(_profiles(t), "orders")
    return out.withColumns(
        {"mismatch_percentage": rnd("mismatch_percentage", 4), "mismatched_columns": F.array_join("mismatched_columns", "; ")}
    )


@query(
    "proc_contents",
    "SELECT row_count AS observations, 6 AS variables, column_name, data_type, row_count - null_count AS non_null, null_count, "
    f"unique_count FROM (WITH {TARGET} {_profile_sql('target', ORDER_COLUMNS)})",
)
def proc_contents(t: Tables):
    return P.proc_contents(altered_orders(t))


# ---- dates ----------------------------------------------------------------

GAPS = f"""WITH {TARGET},
 s AS (SELECT o_orderstatus AS tbl, strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS n FROM orders GROUP BY ALL),
 g AS (SELECT o_orderstatus AS tbl, strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS n FROM target GROUP BY ALL),
 gaps AS (SELECT coalesce(s.tbl, g.tbl) AS tbl, coalesce(s.d, g.d) AS date, s.n AS source_n, g.n AS target_n
   FROM s FULL JOIN g ON s.tbl = g.tbl AND s.d = g.d WHERE s.n IS DISTINCT FROM g.n)
"""


def _histograms(t: Tables):
    a = D.date_histogram(t.orders.withColumnRenamed("o_orderstatus", "tbl"), "o_orderdate", ["tbl"])
    b = D.date_histogram(altered_orders(t).withColumnRenamed("o_orderstatus", "tbl"), "o_orderdate", ["tbl"])
    return a, b


@query(
    "date_histogram",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS n_rows FROM orders GROUP BY 1",
)
def date_histogram(t: Tables):
    return D.date_histogram(t.orders, "o_orderdate")


@query("temporal_differences", f"{GAPS} SELECT * FROM gaps")
def temporal_differences(t: Tables):
    return D.temporal_differences(*_histograms(t), ["tbl"])


@query(
    "sorted_dates",
    f"{GAPS} SELECT tbl, count(*) AS n_dates, string_agg(date, '; ' ORDER BY date) AS mismatched_date FROM gaps GROUP BY 1",
)
def sorted_dates(t: Tables):
    return D.temporal_summary(D.temporal_differences(*_histograms(t), ["tbl"]), ["tbl"])


def _matrix_inputs(t: Tables):
    """Per status and year: the listed years and the counts of both sides."""
    a, b = _histograms(t)
    first = F.concat(F.substring("date", 1, 4), F.lit("-01-01"))
    year = lambda h, side: h.groupBy("tbl", first.alias("date")).agg(
        F.sum("n_rows").alias("n")
    ).withColumn("side", F.lit(side))
    counts = checkpointed(year(a, "source").unionByName(year(b, "target")))  # a row per table and year
    lists = counts.groupBy("tbl").agg(text.joined_list(F.col("date")).alias("mismatched_date"))
    return lists, counts


YEARS = [f"{y}-01-01" for y in range(1995, 2002)]
YEAR_COUNTS = f"""WITH {TARGET},
 s AS (SELECT o_orderstatus AS tbl, strftime(o_orderdate, '%Y-01-01') AS d, count(*) AS n FROM orders GROUP BY ALL),
 g AS (SELECT o_orderstatus AS tbl, strftime(o_orderdate, '%Y-01-01') AS d, count(*) AS n FROM target GROUP BY ALL),
 known AS (SELECT tbl FROM s INTERSECT SELECT tbl FROM g),
 cells AS (SELECT tbl, d, coalesce(s.n, 0) AS a, coalesce(g.n, 0) AS b FROM s FULL JOIN g USING (tbl, d)),
 labels AS (SELECT tbl, d AS date, 'Yes (' || a || ' : ' || b || ')' AS label FROM cells WHERE a <> b AND tbl IN (SELECT tbl FROM known))
"""


@query("mismatch_cells", f"{YEAR_COUNTS} SELECT * FROM labels")
def mismatch_cells(t: Tables):
    return D.mismatch_cells(*_matrix_inputs(t))


@query(
    "mismatch_matrix",
    f"""{YEAR_COUNTS} SELECT c.tbl, {', '.join(f"coalesce(max(CASE WHEN l.date = '{y}' THEN label END), 'No') AS \"{y}\"" for y in YEARS)}
        FROM (SELECT DISTINCT tbl FROM cells) c LEFT JOIN labels l ON c.tbl = l.tbl GROUP BY c.tbl""",
)
def mismatch_matrix(t: Tables):
    return D.mismatch_matrix(*_matrix_inputs(t), YEARS)


# ---- aligned comparison, reports ------------------------------------------


@query(
    "column_multiset_compare",
    f"""WITH {TARGET},
       a AS (SELECT row_number() OVER (ORDER BY o_totalprice) AS k, o_totalprice AS x FROM orders WHERE o_totalprice IS NOT NULL),
       b AS (SELECT row_number() OVER (ORDER BY o_totalprice) AS k, o_totalprice AS x FROM target WHERE o_totalprice IS NOT NULL),
       num AS (SELECT coalesce(bool_and(coalesce(abs(a.x - b.x) <= greatest(1e-5 * greatest(abs(a.x), abs(b.x)), 1e-8), false)), true) AS ok FROM a FULL JOIN b USING (k)),
       c AS (SELECT coalesce(bool_and(coalesce(s.n, 0) = coalesce(g.n, 0)), true) AS ok FROM (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1) s
         FULL JOIN (SELECT o_orderstatus AS v, count(*) AS n FROM target GROUP BY 1) g ON s.v IS NOT DISTINCT FROM g.v),
       n AS (SELECT (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM target) AS t)
       SELECT 'o_totalprice' AS column_name, n.s AS source_values, n.t AS target_values, num.ok AND n.s = n.t AS values_match FROM num, n
       UNION ALL SELECT 'o_orderstatus', n.s, n.t, c.ok AND n.s = n.t FROM c, n""",
)
def column_multiset_compare(t: Tables):
    cols = ["o_totalprice", "o_orderstatus"]
    out = align.column_multiset_compare(t.orders.select(*cols), altered_orders(t).select(*cols))
    return out.drop("unequal", "type_match")


@query(
    "column_multiset_compare_close",
    """WITH t AS (SELECT CASE WHEN l_quantity = 50 THEN l_extendedprice * 1.000001 WHEN l_quantity = 49 AND l_tax = 0 THEN l_extendedprice + 40
         ELSE l_extendedprice END AS p, l_quantity * 1.000001 AS q FROM lineitem),
       a AS (SELECT row_number() OVER (ORDER BY l_extendedprice) AS k, l_extendedprice AS x FROM lineitem),
       b AS (SELECT row_number() OVER (ORDER BY p) AS k, p AS x FROM t),
       c AS (SELECT row_number() OVER (ORDER BY l_quantity) AS k, l_quantity AS x FROM lineitem),
       d AS (SELECT row_number() OVER (ORDER BY q) AS k, q AS x FROM t),
       far AS (SELECT DISTINCT a.x AS v, b.x AS w FROM a JOIN b USING (k) WHERE abs(a.x - b.x) > greatest(1e-5 * greatest(abs(a.x), abs(b.x)), 1e-8)),
       far2 AS (SELECT DISTINCT c.x AS v, d.x AS w FROM c JOIN d USING (k) WHERE abs(c.x - d.x) > greatest(1e-5 * greatest(abs(c.x), abs(d.x)), 1e-8))
       SELECT 'l_extendedprice' AS column_name, (SELECT count(*) FROM lineitem) AS source_values, (SELECT count(*) FROM t) AS target_values,
         (SELECT count(*) FROM far) = 0 AS values_match, (SELECT count(*) FROM far) AS unequal, true AS type_match
       UNION ALL SELECT 'l_quantity', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM t), (SELECT count(*) FROM far2) = 0, (SELECT count(*) FROM far2), true""",
)
def column_multiset_compare_close(t: Tables):
    """Prices moved a little, some by more than the tolerance."""
    p, q = F.col("l_extendedprice"), F.col("l_quantity")
    moved = F.when(q == 50, p * 1.000001).when((q == 49) & (F.col("l_tax") == 0), p + 40).otherwise(p)
    target = t.lineitem.select(moved.alias("l_extendedprice"), (q * 1.000001).alias("l_quantity"))
    return align.column_multiset_compare(t.lineitem.select("l_extendedprice", "l_quantity"), target)


def _aligned(t: Tables):
    bad = D.temporal_differences(
        D.date_histogram(t.orders, "o_orderdate"), D.date_histogram(altered_orders(t), "o_orderdate")
    ).select("date")
    mapping = {c: c for c in t.orders.columns}
    return align.align_and_compare(
        t.orders, altered_orders(t), mapping, ["o_orderpriority"], None, "o_orderdate", bad
    )


ALIGNED = f"""WITH {TARGET},
 s AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
 g AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM target GROUP BY 1),
 bad AS (SELECT coalesce(s.d, g.d) AS d FROM s FULL JOIN g ON s.d = g.d WHERE s.n IS DISTINCT FROM g.n),
 x AS (SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM bad)),
 y AS (SELECT * FROM target WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM bad)),
 px AS (SELECT row_number() OVER (ORDER BY o_totalprice) AS k, o_totalprice AS v FROM x),
 py AS (SELECT row_number() OVER (ORDER BY o_totalprice) AS k, o_totalprice AS v FROM y),
 res AS (
   SELECT 'o_orderkey' AS column_name, (SELECT count(*) FROM (SELECT o_orderkey FROM x EXCEPT SELECT o_orderkey FROM y)) = 0 AS values_match
   UNION ALL SELECT 'o_custkey', (SELECT count(*) FROM (SELECT o_custkey, count(*) FROM x GROUP BY 1 EXCEPT SELECT o_custkey, count(*) FROM y GROUP BY 1)) = 0
   UNION ALL SELECT 'o_orderstatus', (SELECT count(*) FROM (SELECT o_orderstatus, count(*) FROM x GROUP BY 1 EXCEPT SELECT o_orderstatus, count(*) FROM y GROUP BY 1)) = 0
   UNION ALL SELECT 'o_totalprice', (SELECT count(*) FROM px FULL JOIN py USING (k)
     WHERE NOT coalesce(abs(px.v - py.v) <= greatest(1e-5 * greatest(abs(px.v), abs(py.v)), 1e-8), false)) = 0
   UNION ALL SELECT 'o_orderdate', true)
"""


@query("align_and_compare", f"{ALIGNED} SELECT column_name, values_match FROM res")
def align_and_compare(t: Tables):
    return _aligned(t).columns.select("column_name", "values_match")


@query(
    "alignment_summary",
    f"""{ALIGNED} SELECT count(*) AS common_columns, CAST(count_if(values_match) AS BIGINT) AS matching_columns,
        round(count_if(values_match) * 100.0 / count(*), 4) AS match_percentage FROM res""",
)
def alignment_summary(t: Tables):
    out = _aligned(t).summary
    return out.select("common_columns", "matching_columns", rnd("match_percentage", 4).alias("match_percentage"))


STATUS_SQL = f"""WITH {TARGET},
 k AS (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM target) AS b,
   (SELECT count(*) FROM orders s ANTI JOIN target t ON s.o_orderkey = t.o_orderkey) AS so,
   (SELECT count(*) FROM target t ANTI JOIN orders s ON s.o_orderkey = t.o_orderkey) AS tgo,
   (SELECT count(*) FROM orders s JOIN target t ON s.o_orderkey = t.o_orderkey) AS ck,
   (SELECT CAST(sum((s.o_orderstatus IS DISTINCT FROM t.o_orderstatus)::INT + (abs(s.o_totalprice - t.o_totalprice) > 1e-6)::INT
      + (s.o_orderpriority IS DISTINCT FROM t.o_orderpriority)::INT) AS BIGINT) FROM orders s JOIN target t ON s.o_orderkey = t.o_orderkey) AS dv)
"""


@query(
    "compare_tables",
    f"""{STATUS_SQL} SELECT 'orders' AS table_name, a AS source_count, b AS target_count, abs(a - b) AS count_difference,
        so AS source_only, tgo AS target_only, ck AS common_keys, round(ck / greatest(a, b), 6) AS match_rate,
        dv AS different_values, false AS schema_differs, 'RECORD_COUNT_MISMATCH' AS match_status FROM k""",
)
def compare_tables(t: Tables):
    out = compare.compare_tables(t.orders, altered_orders(t), "orders", ["o_orderkey"]).summary
    return out.withColumn("match_rate", rnd("match_rate")).drop("execution_time", "min_ks_p", "sampled_keys")


def _comparisons(t: Tables):
    """A match, a schema change, missing rows, changed values and a failing comparison."""
    g = altered_orders(t)
    both = g.join(t.orders.select("o_orderkey"), "o_orderkey", "left_semi")
    kept = t.orders.join(g.select("o_orderkey"), "o_orderkey", "left_semi")
    run = lambda a, b, name, keys=("o_orderkey",): (name, lambda: compare.compare_tables(a, b, name, list(keys)))
    return compare.compare_many(
        [
            run(t.customer, t.customer, "customer", ["c_custkey"]),
            run(t.orders, _target_table(t), "orders_schema"),
            run(t.orders, g, "orders_rows"),
            run(kept, both, "orders_values"),
            run(t.supplier, t.supplier, "supplier_bad_key", ["no_such_column"]),
        ],
        t.spark,
    )


@query(
    "match_status",
    """SELECT 'customer' AS table_name, 'MATCH' AS match_status, count(*) AS source_count FROM customer
       UNION ALL SELECT 'orders_schema', 'SCHEMA_MISMATCH', count(*) FROM orders
       UNION ALL SELECT 'orders_rows', 'RECORD_COUNT_MISMATCH', count(*) FROM orders
       UNION ALL SELECT 'orders_values', 'VALUE_DIFFERENCES', count(*) FROM orders WHERE o_totalprice >= 5000
       UNION ALL SELECT 'supplier_bad_key', 'ERROR', NULL""",
)
def match_status(t: Tables):
    status = F.regexp_replace("match_status", "(?s)^ERROR.*", "ERROR")
    return _comparisons(t).select("table_name", status.alias("match_status"), "source_count")


@query(
    "run_report",
    "SELECT 5 AS total_comparisons, 1 AS matches, 4 AS differences, 1 AS errors, max(o_orderkey) IS NOT NULL AS timed FROM orders",
)
def run_report(t: Tables):
    out = compare.run_report(_comparisons(t)).withColumn("timed", F.col("total_execution_time") > 0)
    counts = ("total_comparisons", "matches", "differences", "errors")
    return out.select(*[F.col(c).cast("int").alias(c) for c in counts], "timed")


@query(
    "run_report_statuses",
    """WITH a AS (SELECT o_custkey, count(*) AS n, count_if(o_orderstatus = 'F') AS f FROM orders GROUP BY 1)
       SELECT count(*) AS total_comparisons, CAST(count_if(n >= 5 AND f > 0) AS BIGINT) AS matches, CAST(count_if(n < 5 OR f = 0) AS BIGINT) AS differences,
         CAST(count_if(n < 5) AS BIGINT) AS errors, CAST(sum(n) AS DOUBLE) AS total_execution_time FROM a""",
)
def run_report_statuses(t: Tables):
    """Totals over one summary per customer, its status taken from the customer's orders."""
    a = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    status = F.when(F.col("n") < 5, "ERROR: too few").when(F.col("f") == 0, "VALUE_DIFFERENCES").otherwise("MATCH")
    return compare.run_report(a.select(status.alias("match_status"), F.col("n").cast("double").alias("execution_time")))


@query(
    "compare_tables_sampled",
    f"""WITH {TARGET} SELECT (SELECT count(*) FROM orders) AS source_count, (SELECT count(*) FROM target) AS target_count,
        (SELECT count(*) FROM (SELECT o_orderkey FROM orders UNION SELECT o_orderkey FROM target)) AS sampled_keys, 'RECORD_COUNT_MISMATCH' AS match_status""",
)
def compare_tables_sampled(t: Tables):
    """A sample larger than the tables: the keys taken are told, not the number asked for."""
    columns = ["o_orderkey", "o_orderstatus"]
    out = compare.compare_tables(t.orders.select(columns), altered_orders(t).select(columns), "orders", ["o_orderkey"], sample_size=10**9)
    return out.summary.select("source_count", "target_count", "sampled_keys", "match_status")


@query(
    "status_distribution",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS n, count_if(o_orderstatus = 'F') AS f, count_if(o_totalprice > 400000) AS big FROM orders GROUP BY 1)
       SELECT CASE WHEN n < 5 THEN 'SCHEMA_MISMATCH' WHEN f = 0 THEN 'RECORD_COUNT_MISMATCH' WHEN big > 3 THEN 'VALUE_DIFFERENCES'
         WHEN big / n < 0.05 THEN 'STATISTICAL_DIFFERENCES' ELSE 'MATCH' END AS match_status, count(*) AS n FROM a GROUP BY 1""",
)
def status_distribution(t: Tables):
    """Status of one comparison per customer, with findings taken from their orders."""
    a = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_totalprice") > 400000).alias("big"),
    )
    status = compare.match_status(
        F.col("n") < 5, F.when(F.col("f") == 0, 1).otherwise(0), F.greatest(F.col("big") - 3, F.lit(0)), F.col("big") / F.col("n")
    )
    return compare.status_distribution(a.select(status.alias("match_status")))


@query(
    "validate_frames",
    f"""WITH {TARGET}, j AS (SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, s.o_orderkey AS sk, t.o_orderkey AS tk,
          s.o_totalprice AS a3, t.o_totalprice AS b3, s.o_orderpriority AS a5, t.o_orderpriority AS b5 FROM orders s FULL JOIN target t ON s.o_orderkey = t.o_orderkey)
        SELECT o_orderkey, '(row)' AS column_name FROM j WHERE sk IS NULL OR tk IS NULL
        UNION ALL SELECT o_orderkey, 'o_totalprice' FROM j WHERE sk IS NOT NULL AND tk IS NOT NULL AND abs(a3 - b3) > 1e-6 + 1e-5 * abs(a3)
        UNION ALL SELECT o_orderkey, 'o_orderpriority' FROM j WHERE sk IS NOT NULL AND tk IS NOT NULL AND a5 IS DISTINCT FROM b5""",
)
def validate_frames(t: Tables):
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    _, cells = compare.validate_frames(t.orders.select(*cols), altered_orders(t).select(*cols), ["o_orderkey"], "orders")
    return cells.select("o_orderkey", "column_name")


@query(
    "validate_frames_verdict",
    f"""WITH {TARGET}, j AS (SELECT s.o_orderkey AS sk, t.o_orderkey AS tk, s.o_totalprice AS a3, t.o_totalprice AS b3, s.o_orderpriority AS a5,
          t.o_orderpriority AS b5 FROM orders s FULL JOIN target t ON s.o_orderkey = t.o_orderkey),
        n AS (SELECT sum(CASE WHEN sk IS NULL OR tk IS NULL THEN 1 ELSE (abs(a3 - b3) > 1e-6 + 1e-5 * abs(a3))::INT + (a5 IS DISTINCT FROM b5)::INT END)::BIGINT AS n FROM j)
        SELECT 'orders' AS test_name, true AS columns_match, n AS differences, n = 0 AS passed FROM n
        UNION ALL SELECT 'same', true, 0, true FROM n UNION ALL SELECT 'renamed', false, 0, false FROM n""",
)
def validate_frames_verdict(t: Tables):
    """The verdicts on an altered copy, an equal one, and one whose columns are in another order."""
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    a, b = t.orders.select(*cols), altered_orders(t).select(*cols)
    verdicts = [compare.validate_frames(a, x, ["o_orderkey"], name)[0] for name, x in (("orders", b), ("same", a), ("renamed", a.select(cols[::-1])))]
    return verdicts[0].unionByName(verdicts[1]).unionByName(verdicts[2])


def _numeric_cases(t: Tables):
    """Line totals computed two ways, one slightly off for discounted lines."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    off = F.when(F.col("l_discount") >= 0.08, 0.01).otherwise(0.0)
    return t.lineitem.select(F.col("l_returnflag").alias("test_name"), net.alias("expected"), (net + off).alias("actual"))


@query(
    "validate_numeric",
    """SELECT l_returnflag AS test_name, l_discount < 0.08 AS passed, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def validate_numeric(t: Tables):
    return compare.validate_numeric(_numeric_cases(t)).groupBy("test_name", "passed").agg(F.count(F.lit(1)).alias("n"))


@query(
    "validation_summary",
    """WITH r AS (SELECT strftime(l_shipdate, '%Y') || '-' || l_returnflag AS test_name, max(l_discount) < 0.1 AS ok FROM lineitem GROUP BY 1)
       SELECT count(*) AS total_tests, CAST(count_if(ok) AS BIGINT) AS passed, CAST(count_if(NOT ok) AS BIGINT) AS failed,
         round(count_if(ok) / count(*), 6) AS pass_rate FROM r""",
)
def validation_summary(t: Tables):
    return compare.validation_summary(_shipping_tests(t)).withColumn("pass_rate", rnd("pass_rate"))


def _shipping_tests(t: Tables):
    name = F.concat_ws("-", F.date_format("l_shipdate", "yyyy"), "l_returnflag")
    return t.lineitem.groupBy(name.alias("test_name")).agg((F.max("l_discount") < 0.1).alias("passed"))


@query(
    "failed_tests",
    """SELECT strftime(l_shipdate, '%Y') || '-' || l_returnflag AS test_name, false AS passed FROM lineitem
       GROUP BY 1 HAVING max(l_discount) >= 0.1""",
)
def failed_tests(t: Tables):
    return compare.failed_tests(_shipping_tests(t))


def _days_sql(name: str, left: str, right: str, column: str) -> str:
    """The listed days of ``column`` on which both tables hold different numbers of rows."""
    days = "(SELECT strftime({c}, '%Y-%m-%d') AS d, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1)"
    a, b = (days.format(c=column, t=t) for t in (left, right))
    return f"""{name} AS (SELECT string_agg(coalesce(a.d, b.d), '; ' ORDER BY coalesce(a.d, b.d)) AS days
      FROM {a} a FULL JOIN {b} b ON a.d = b.d WHERE a.n IS DISTINCT FROM b.n)"""


def _report_sql(source, target, status, a, b, date, days, width, types="", unique="", uncaptured="", shown=True) -> str:
    """One row of the report; counts and days are computed, what follows from the schemas is written out."""
    rows = f"'source(' || {a} || ') : target(' || {b} || ')'" if shown else "''"
    return f"""SELECT '' AS product, '{source}' AS source_table, '{target}' AS target_table, 'N' AS hydrated_only,
      '{source.split(".")[0]}' AS source_service, '{status}' AS status, {f"{a} <> {b}" if shown else "false"} AS row_unmatch, {rows} AS row_details,
      '{f"source({width}) : target({width})" if shown else ""}' AS col_details, {f"{days} IS NOT NULL" if days else "false"} AS time_unmatch,
      '{date} : {date}' AS time_variable, {f"coalesce({days}, '')" if days else "''"} AS time_details, {str(bool(types)).lower()} AS type_unmatch,
      '{types}' AS type_details, '{unique}' AS source_unique, '' AS target_unique, '{uncaptured}' AS uncaptured"""


_ORDERS, _ALTERED = "(SELECT count(*) FROM orders)", "(SELECT count(*) FROM target)"
_CUSTOMERS = "(SELECT count(*) FROM customer)"
ANALYSIS = f"WITH {TARGET}, {LINES}, {_days_sql('od', 'orders', 'target', 'o_orderdate')}, {_days_sql('ld', 'lineitem', 'lines', 'l_shipdate')} " + " UNION ALL ".join([
    _report_sql("svc.orders", "lake.orders", "Successful Data Access", _ORDERS, _ALTERED, "o_orderdate", "(SELECT days FROM od)", 6, "CLOB->string; NUMBER(19)->bigint"),
    _report_sql("found.orders", "lake.orders2", "Column Mapping Not Provided", _ORDERS, _ALTERED, "o_orderdate", "(SELECT days FROM od)", 6, unique="O_ORDERPRIORITY",
                uncaptured="O_CUSTKEY->o_custkey; O_ORDERDATE->o_orderdate; O_ORDERKEY->o_orderkey; O_ORDERSTATUS->o_orderstatus_cd; O_TOTALPRICE->o_totalprice"),
    _report_sql("svc.lineitem", "lake.lineitem", "Successful Data Access", "(SELECT count(*) FROM lineitem)", "(SELECT count(*) FROM lines)", "l_shipdate",
                "(SELECT days FROM ld)", 11, "CLOB->string; NUMBER(10)->int; NUMBER(19)->bigint"),
    _report_sql("svc.customer", "lake.customer", "Nonexisting Date Variable in Source", _CUSTOMERS, _CUSTOMERS, "since", "", 5, uncaptured="Column Mapping Not Provided"),
    _report_sql("svc.gone", "lake.gone", "Nonexisting Source Table", "0", "0", "d", "", 0, shown=False),
])


@query("run_analysis", ANALYSIS)
def run_analysis(t: Tables):
    return analysis.run_analysis(t.spark, table_pairs(t), add_cols=["etl_date"])


def table_pairs(t: Tables):
    pair = analysis.TablePair
    mapping = {c: c for c in t.orders.columns}
    return [
        pair("orders", t.orders, altered_orders(t), "svc.orders", "lake.orders", "o_orderdate", "o_orderdate", mapping),
        pair("orders2", t.orders, _target_table(t), "no_server_provided.orders", "lake.orders2", "o_orderdate", "o_orderdate", service="found"),
        pair("lineitem", t.lineitem, altered_lineitem(t), "svc.lineitem", "lake.lineitem", "l_shipdate", "l_shipdate", {c: c for c in t.lineitem.columns}),
        pair("customer", t.customer, t.customer, "svc.customer", "lake.customer", "since", "since", {}),
        pair("gone", None, t.supplier, "svc.gone", "lake.gone", "d", "d", {}),
    ]


@query("joined_list", "SELECT p_brand, string_agg(DISTINCT p_type, '; ' ORDER BY p_type) AS types FROM part GROUP BY 1")
def joined_list(t: Tables):
    return t.part.groupBy("p_brand").agg(text.joined_list(F.col("p_type")).alias("types"))


