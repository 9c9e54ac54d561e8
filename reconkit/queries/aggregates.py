"""Frequency, summary, test and regression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reconkit.operators import aggregates as A, hypothesis as H, regression as G
from reconkit.plans.compare import stat_differences as stat_diff
from reconkit.queries import LINES, Tables, altered_lineitem, query, rnd
from reconkit.sources.write import manifest_summary as summary_of


def _means_sql(columns, source="lineitem", by="", extra=""):
    keys = f"{by}, " if by else ""
    return " UNION ALL ".join(
        f"""SELECT {keys}'{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        min({c}) AS min, max({c}) AS max{extra.format(c=c)} FROM {source} {'GROUP BY ' + by if by else ''}"""
        for c in columns
    )


def _round(df, names, digits=4):
    return df.withColumns({c: rnd(c, digits) for c in names})


VARS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("proc_means", _means_sql(VARS, extra=", round(sum({c}), 2) AS sum, round(quantile_cont({c}, 0.5), 4) AS median"))
def proc_means(t: Tables):
    out = A.proc_means(t.lineitem, VARS, stats=["n", "mean", "std", "min", "max", "sum", "median", "mode"])
    return _round(_round(out, ["mean", "std", "median"]), ["sum"], 2)


@query("proc_means_by", _means_sql(VARS[:2], by="l_returnflag"))
def proc_means_by(t: Tables):
    return _round(A.proc_means(t.lineitem, VARS[:2], by=["l_returnflag"]), ["mean", "std"])


@query(
    "proc_means_class",
    """SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS l_quantity_mean, round(stddev_samp(l_quantity), 4) AS l_quantity_std,
       min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, count(l_quantity) AS l_quantity_count
       FROM lineitem GROUP BY ALL""",
)
def proc_means_class(t: Tables):
    out = A.proc_means_wide(t.lineitem, ["l_quantity"], ["l_returnflag", "l_linestatus"])
    return _round(out, ["l_quantity_mean", "l_quantity_std"])


@query(
    "proc_freq_oneway",
    f"""WITH {LINES} SELECT 'l_returnflag' AS variable, l_returnflag AS level, count(*) AS frequency,
        round(count(*) * 100.0 / (SELECT count(*) FROM lines), 2) AS percent FROM lines WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
        UNION ALL SELECT 'l_linestatus', l_linestatus, count(*), round(count(*) * 100.0 / (SELECT count(*) FROM lines), 2) FROM lines GROUP BY l_linestatus""",
)
def proc_freq_oneway(t: Tables):
    out = A.proc_freq_oneway(altered_lineitem(t), ["l_returnflag", "l_linestatus", "unknown"])
    return A.sorted_by_frequency(out)


@query(
    "proc_freq_total",
    f"""WITH {LINES}, k AS (SELECT * FROM lines WHERE l_returnflag IS NOT NULL)
        SELECT 'l_returnflag' AS variable, l_returnflag AS level, count(*) AS frequency, round(count(*) * 100.0 / (SELECT count(*) FROM k), 4) AS percent FROM k GROUP BY 2
        UNION ALL SELECT 'l_returnflag', 'Total', count(*), 100.0 FROM k
        UNION ALL SELECT 'l_linestatus', l_linestatus, count(*), round(count(*) * 100.0 / (SELECT count(*) FROM lines), 4) FROM lines GROUP BY 2
        UNION ALL SELECT 'l_linestatus', 'Total', count(*), 100.0 FROM lines""",
)
def proc_freq_total(t: Tables):
    return _round(A.proc_freq_total(altered_lineitem(t)), ["percent"])


def _cross_sql(table, row, col, levels, margin):
    cells = ", ".join(f"CAST(count_if({col} = '{v}') AS BIGINT) AS \"{v}\"" for v in levels)
    return f"""SELECT {row}, {cells}, count({col}) AS "{margin}" FROM {table} WHERE {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY {row}
        UNION ALL SELECT '{margin}', {cells}, count({col}) FROM {table} WHERE {row} IS NOT NULL AND {col} IS NOT NULL"""


STATUSES = ["F", "O", "P"]


@query("crosstab_margins", _cross_sql("orders", "o_orderpriority", "o_orderstatus", STATUSES, "All"))
def crosstab_margins(t: Tables):
    return A.crosstab_margins(t.orders, "o_orderpriority", "o_orderstatus", STATUSES)


@query("proc_freq_by", f"WITH {LINES} " + _cross_sql("lines", "l_linestatus", "l_returnflag", ["A", "N", "R"], "Total"))
def proc_freq_by(t: Tables):
    return A.proc_freq_by(altered_lineitem(t), "l_linestatus", "l_returnflag")


UNI = """, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3,
  round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurtosis, count(*) - count({c}) AS missing"""


@query("proc_univariate", _means_sql(VARS, extra=UNI))
def proc_univariate(t: Tables):
    out = A.proc_univariate(t.lineitem, VARS)
    return _round(out, ["mean", "std", "q1", "median", "q3", "skew", "kurtosis"])


@query("proc_univariate_by", _means_sql(["value"], "events", "event_type", UNI))
def proc_univariate_by(t: Tables):
    out = A.proc_univariate(t.events, ["value"], ["event_type"])
    return _round(out, ["mean", "std", "q1", "median", "q3", "skew", "kurtosis"])


@query(
    "histogram",
    """WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events),
       b AS (SELECT CAST(least(floor((value - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n FROM events, r WHERE value IS NOT NULL GROUP BY 1)
       SELECT CAST(g.i AS INTEGER) AS bin, round(lo + w * i, 6) AS lower, round(lo + w * (i + 1), 6) AS upper, coalesce(b.n, 0) AS n
       FROM range(30) g(i) CROSS JOIN r LEFT JOIN b ON b.bin = g.i""",
)
def histogram(t: Tables):
    return _round(A.histogram(t.events, "value"), ["lower", "upper"], 6)


@query(
    "group_by_having",
    """SELECT o_custkey, count(o_totalprice) AS o_totalprice_count, round(sum(o_totalprice), 2) AS o_totalprice_sum, max(o_orderdate) AS o_orderdate_max
       FROM orders GROUP BY 1 HAVING count(o_totalprice) > 10 AND max(o_totalprice) > 400000""",
)
def group_by_having(t: Tables):
    out = A.group_by_having(
        t.orders, ["o_custkey"], {"o_totalprice": ["count", "sum", "max"], "o_orderdate": "max"},
        "o_totalprice_count > 10 AND o_totalprice_max > 400000",
    )
    return _round(out.drop("o_totalprice_max"), ["o_totalprice_sum"], 2)


DESCRIBE = """, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
  round(quantile_cont({c}, 0.75), 4) AS p75, count(*) - count({c}) AS missing"""


@query("describe_stats", _means_sql(VARS, extra=DESCRIBE).replace(" AS n,", " AS count,"))
def describe_stats(t: Tables):
    return _round(A.describe_stats(t.lineitem, VARS), ["mean", "std", "p25", "p50", "p75"])


@query(
    "stat_differences",
    f"WITH {LINES} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, round(abs((SELECT avg({c}) FROM lines) - (SELECT avg({c}) FROM lineitem)), 6) AS mean_diff,
        round(abs((SELECT stddev_samp({c}) FROM lines) - (SELECT stddev_samp({c}) FROM lineitem)), 6) AS std_diff,
        round((SELECT quantile_cont({c}, 0.5) FROM lines), 4) AS target_p50"""
        for c in VARS
    ),
)
def stat_differences(t: Tables):
    out = stat_diff(t.lineitem.select(*VARS), altered_lineitem(t).select(*VARS))
    out = _round(_round(out, ["mean_diff", "std_diff"], 6), ["target_p50"])
    return out.select("variable", "mean_diff", "std_diff", "target_p50")


def _returned(t: Tables):
    return t.lineitem.filter("l_returnflag <> 'R'"), t.lineitem.filter("l_returnflag = 'R'")


RANKS = """WITH v AS (SELECT l_extendedprice AS x, CAST(count_if(l_returnflag <> 'R') AS DOUBLE) AS c1, CAST(count_if(l_returnflag = 'R') AS DOUBLE) AS c2
   FROM lineitem GROUP BY 1),
 c AS (SELECT *, sum(c1) OVER w AS k1, sum(c2) OVER w AS k2, sum(c1) OVER () AS n1, sum(c2) OVER () AS n2 FROM v WINDOW w AS (ORDER BY x))
"""


@query(
    "ks_two_sample",
    f"""{RANKS} SELECT 'l_extendedprice' AS variable, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2,
        round(max(abs(k1 / n1 - k2 / n2)), 9) AS ks_d,
        round((SELECT 2 * sum((CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * i * i * any_value(z) )) FROM range(1, 101) r(i)), 6) AS ks_p
        FROM (SELECT *, pow(max(abs(k1 / n1 - k2 / n2)) OVER (), 2) * n1 * n2 / (n1 + n2) AS z FROM c) c2""",
)
def ks_two_sample(t: Tables):
    out = H.distribution_tests(*_returned(t), ["l_extendedprice"])
    return out.select("variable", "n1", "n2", rnd("ks_d", 9).alias("ks_d"), rnd("ks_p").alias("ks_p"))


@query(
    "mann_whitney",
    f"""{RANKS} SELECT 'l_extendedprice' AS variable, sum(c1 * (k2 - c2 / 2)) AS u FROM c""",
)
def mann_whitney(t: Tables):
    return H.distribution_tests(*_returned(t), ["l_extendedprice"]).select("variable", "u")


@query(
    "mann_whitney_p",
    f"""{RANKS}, s AS (SELECT sum(c1 * (k2 - c2 / 2)) AS u, any_value(n1) AS n1, any_value(n2) AS n2, sum(pow(c1 + c2, 3) - (c1 + c2)) AS ties FROM c),
        z AS (SELECT n1, n2, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM s)
        SELECT 'l_extendedprice' AS variable, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2,
          -- twice the upper tail of the normal law by Simpson's rule up to 12
          round(least(1, 2 * (SELECT sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow(z.z + i * (12 - z.z) / 2000, 2) / 2))
            FROM range(2001) r(i)) * (12 - z.z) / 6000 / sqrt(2 * pi())), 6) AS mw_p FROM z""",
)
def mann_whitney_p(t: Tables):
    out = H.distribution_tests(*_returned(t), ["l_extendedprice"])
    return out.select("variable", "n1", "n2", rnd("mw_p").alias("mw_p"))


BALANCES = """balances AS (
  SELECT n_regionkey, c_nationkey, sum(c_acctbal) AS balance, CAST(count(*) AS DOUBLE) AS customers
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
f AS (SELECT * FROM balances WHERE n_regionkey = 0), s AS (SELECT * FROM balances WHERE n_regionkey <> 0)"""


def _balances(t: Tables):
    """Customers' balances per nation: those of one region against all others."""
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    per_nation = joined.groupBy("n_regionkey", "c_nationkey").agg(
        F.sum("c_acctbal").alias("balance"), F.count(F.lit(1)).cast("double").alias("customers")
    )
    return per_nation.filter("n_regionkey = 0"), per_nation.filter("n_regionkey <> 0")


def _ks_exact_sql(c: str) -> str:
    """Distance, then walks over the grid as lists: one step of the pooled order a row."""
    return f"""
    {c}_v AS (SELECT DISTINCT {c} AS v FROM balances),
    {c}_d AS (
      SELECT (SELECT count(*) FROM f) AS n1, (SELECT count(*) FROM s) AS n2,
        max(abs((SELECT count(*) FROM f WHERE {c} <= v) / (SELECT count(*) FROM f)
              - (SELECT count(*) FROM s WHERE {c} <= v) / (SELECT count(*) FROM s))) AS d
      FROM {c}_v),
    {c}_w(step, p, n1, n2, d) AS (
      SELECT 0, list_transform(range(n1 + 2), lambda i: CASE WHEN i = 1 THEN 1.0::DOUBLE ELSE 0 END), n1, n2, d FROM {c}_d
      UNION ALL
      SELECT step + 1, list_transform(range(n1 + 2), lambda i: CASE
          WHEN i = 0 OR abs((i - 1) * n2 - (step + 2 - i) * n1) >= round(d * n1 * n2) THEN 0
          ELSE (p[i] * (n1 - i + 2) + p[i + 1] * (n2 - step + i - 1)) / (n1 + n2 - step) END), n1, n2, d
      FROM {c}_w WHERE step < n1 + n2)"""


@query(
    "ks_exact",
    f"""WITH RECURSIVE {BALANCES}, {_ks_exact_sql("balance")}, {_ks_exact_sql("customers")}
    SELECT 'balance' AS variable, n1, n2, round(d, 9) AS ks_d, round(1 - p[n1 + 2], 9) AS ks_p FROM balance_w WHERE step = n1 + n2
    UNION ALL SELECT 'customers', n1, n2, round(d, 9), round(1 - p[n1 + 2], 9) FROM customers_w WHERE step = n1 + n2""",
)
def ks_exact(t: Tables):
    """Exact law for a region's five nations against all others."""
    out = H.distribution_tests(*_balances(t), ["balance", "customers"])
    return out.select("variable", "n1", "n2", rnd("ks_d", 9).alias("ks_d"), rnd("ks_p", 9).alias("ks_p"))


@query(
    "mann_whitney_exact",
    f"""WITH RECURSIVE {BALANCES},
    u AS (SELECT (SELECT count(*) FROM f) AS n1, (SELECT count(*) FROM s) AS n2,
            (SELECT sum(CASE WHEN f.balance > s.balance THEN 1 WHEN f.balance = s.balance THEN 0.5 ELSE 0 END) FROM f, s) AS u),
    sets(rank, chosen, total, n1, n) AS (
      SELECT 0, 0, 0, n1, n1 + n2 FROM u UNION ALL
      SELECT rank + 1, chosen + take, total + take * (rank + 1 - chosen - 1), n1, n
      FROM sets, (VALUES (0), (1)) t(take) WHERE rank < n AND chosen + take <= n1 AND chosen + take + n - rank - 1 >= n1),
    law AS (SELECT total AS u, count(*) AS n FROM sets WHERE rank = n AND chosen = n1 GROUP BY 1)
    SELECT 'balance' AS variable, n1, n2, CAST(u.u AS DOUBLE) AS u,
      round(least(1, 2 * (SELECT sum(n) FROM law WHERE law.u >= greatest(u.u, n1 * n2 - u.u)) / (SELECT sum(n) FROM law)), 9) AS mw_p FROM u""",
)
def mann_whitney_exact(t: Tables):
    """Exact law for a region's five nations against all others; balances have no ties."""
    out = H.distribution_tests(*_balances(t), ["balance"])
    return out.select("variable", "n1", "n2", "u", rnd("mw_p", 9).alias("mw_p"))


@query(
    "untestable_columns",
    """WITH c AS (SELECT count(c_acctbal) AS n FROM customer)
    SELECT 'balance' AS variable, n AS n1, 0::BIGINT AS n2, 'no values on the second side' AS note FROM c
    UNION ALL SELECT 'nothing', 0, 0, 'no values on either side' FROM c
    UNION ALL SELECT 'known', n, n, NULL FROM c""",
)
def untestable_columns(t: Tables):
    """A column that is empty on a side keeps its row."""
    a = t.customer.select(F.col("c_acctbal").alias("balance"), F.lit(None).cast("double").alias("nothing"), F.col("c_acctbal").alias("known"))
    b = a.withColumn("balance", F.lit(None).cast("double"))
    return H.distribution_tests(a, b, ["balance", "nothing", "known"]).select("variable", "n1", "n2", "note")


@query(
    "ttest_two_sample",
    """WITH g AS (SELECT l_linestatus AS k, count(l_quantity) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v FROM lineitem GROUP BY 1),
       a AS (SELECT * FROM g WHERE k = 'F'), b AS (SELECT * FROM g WHERE k = 'O')
       SELECT a.n AS n1, b.n AS n2, round(a.m, 6) AS mean1, round(b.m, 6) AS mean2, CAST(a.n + b.n - 2 AS DOUBLE) AS df,
         round((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)), 6) AS t FROM a, b""",
)
def ttest_two_sample(t: Tables):
    out = H.ttest_two_sample(t.lineitem, "l_quantity", "l_linestatus")
    return _round(out, ["mean1", "mean2", "t"], 6).select("n1", "n2", "mean1", "mean2", "df", "t")


PAIRS = """WITH p AS (SELECT l_orderkey, avg(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS f,
   avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS o FROM lineitem GROUP BY 1),
 d AS (SELECT f - o AS d FROM p WHERE f IS NOT NULL AND o IS NOT NULL)
"""


@query(
    "ttest_paired",
    f"{PAIRS} SELECT count(*) AS n1, CAST(count(*) - 1 AS DOUBLE) AS df, round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 6) AS t FROM d",
)
def ttest_paired(t: Tables):
    """Mean quantity of finished against open lines of the same order."""
    means = t.lineitem.groupBy("l_orderkey", "l_linestatus").agg(F.avg("l_quantity").alias("q"))
    out = H.ttest_paired(means, "q", "l_linestatus", ["l_orderkey"])
    return _round(out, ["t"], 6).select("n1", "df", "t")


@query(
    "ttest_one_sample",
    """SELECT count(c_acctbal) AS n1, round(avg(c_acctbal), 6) AS mean1, CAST(count(c_acctbal) - 1 AS DOUBLE) AS df,
       round(avg(c_acctbal) / (stddev_samp(c_acctbal) / sqrt(count(c_acctbal))), 6) AS t FROM customer""",
)
def ttest_one_sample(t: Tables):
    out = H.ttest_one_sample(t.customer, "c_acctbal")
    return _round(out, ["mean1", "t"], 6).select("n1", "mean1", "df", "t")


@query(
    "proc_reg",
    """WITH r AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
         regr_count(l_extendedprice, l_quantity) AS n, regr_sxx(l_extendedprice, l_quantity) AS sxx,
         regr_syy(l_extendedprice, l_quantity) AS syy, regr_avgx(l_extendedprice, l_quantity) AS mx FROM lineitem),
       s AS (SELECT *, (syy - b * b * sxx) / (n - 2) AS v FROM r)
       SELECT 'l_quantity' AS term, round(b, 4) AS estimate, round(sqrt(v / sxx), 4) AS std_error, round(b / sqrt(v / sxx), 4) AS t FROM s
       UNION ALL SELECT 'Intercept', round(a, 4), round(sqrt(v * (1.0 / n + mx * mx / sxx)), 4), round(a / sqrt(v * (1.0 / n + mx * mx / sxx)), 4) FROM s""",
)
def proc_reg(t: Tables):
    fit = G.proc_reg(t.lineitem, "l_extendedprice ~ l_quantity")
    return _round(fit.coefficients, ["estimate", "std_error", "t"]).select("term", "estimate", "std_error", "t")


@query(
    "proc_reg_fit",
    """WITH r AS (SELECT regr_r2(l_extendedprice, l_quantity) AS r2, regr_count(l_extendedprice, l_quantity) AS n,
         regr_syy(l_extendedprice, l_quantity) AS syy FROM lineitem),
       s AS (SELECT *, syy * (1 - r2) AS rss FROM r)
       SELECT n, round(1 - (1 - r2) * (n - 1) / (n - 2), 9) AS adj_r2, round(syy * r2 / (rss / (n - 2)), 4) AS f,
         round(n * (ln(2 * pi() * rss / n) + 1) + 4, 2) AS aic, round(n * (ln(2 * pi() * rss / n) + 1) + 2 * ln(n), 2) AS bic FROM s""",
)
def proc_reg_fit(t: Tables):
    fit = G.proc_reg(t.lineitem, "l_extendedprice ~ l_quantity").fit
    return fit.select("n", rnd("adj_r2", 9).alias("adj_r2"), rnd("f", 4).alias("f"), rnd("aic", 2).alias("aic"), rnd("bic", 2).alias("bic"))


@query(
    "proc_reg_residuals",
    """WITH r AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice - a - b * l_quantity), 2) AS residual_sum,
         round(sum(a + b * l_quantity) / 1000, 2) AS fitted_sum FROM lineitem, r GROUP BY 1""",
)
def proc_reg_residuals(t: Tables):
    rows = G.proc_reg(t.lineitem, "l_extendedprice ~ l_quantity").rows
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        rnd(F.sum("residual"), 2).alias("residual_sum"),
        rnd(F.sum("fitted") / 1000, 2).alias("fitted_sum"),
    )


def _quality(t: Tables):
    docs = t.documents.select("doc_id", (F.col("n_chars") / 1000).alias("kchars"), F.length("text").alias("length"))
    words = t.documents.select("doc_id", (F.size(F.split("text", " ")) / 1000).alias("kwords"))
    return t.labels.join(docs, "doc_id").join(words, "doc_id").select("doc_id", "quality", "kchars", "kwords")


@query(
    "proc_logistic_gradient",
    """SELECT unnest(['Intercept', 'kchars', 'kwords']) AS term, 0.0::DOUBLE AS slope FROM (SELECT count(*) AS n FROM labels) WHERE n > 0""",
)
def proc_logistic_gradient(t: Tables):
    """Slope of the penalised log likelihood at the fitted coefficients, per row: zero at the optimum."""
    fit = G.proc_logistic(_quality(t), "quality", ["kchars", "kwords"])
    gap = F.col("probability") - F.col("quality")
    slopes = fit.predictions.agg(
        F.count(F.lit(1)).alias("n"), F.sum(gap).alias("Intercept"), *[F.sum(gap * F.col(c)).alias(c) for c in ("kchars", "kwords")]
    ).unpivot(["n"], ["Intercept", "kchars", "kwords"], "term", "sum")
    penalty = F.when(F.col("term") == "Intercept", 0.0).otherwise(F.col("estimate"))
    slope = F.round(F.abs(F.col("sum") + penalty) / F.col("n"), 5)
    return slopes.join(fit.coefficients, "term").select("term", slope.alias("slope"))


QUALITY_ROWS = """SELECT quality::DOUBLE AS y, n_chars / 1000 AS x1, len(string_split(text, ' ')) / 1000 AS x2
  FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL AND n_chars IS NOT NULL AND text IS NOT NULL"""


def _newton_sql(rows: str, steps: int = 14) -> str:
    """Newton steps from zero with a unit penalty on the slopes: 3 x 3 systems by Cramer's rule."""
    det = lambda m: f"({m[0]} * ({m[4]} * {m[8]} - {m[5]} * {m[7]}) - {m[1]} * ({m[3]} * {m[8]} - {m[5]} * {m[6]}) + {m[2]} * ({m[3]} * {m[7]} - {m[4]} * {m[6]}))"
    gram = ["h00", "h01", "h02", "h01", "h11", "h12", "h02", "h12", "h22"]
    solved = []
    for i in range(3):
        part = list(gram)
        part[i], part[3 + i], part[6 + i] = "g0", "g1", "g2"
        solved.append(f"b{i} + {det(part)} / {det(gram)} AS b{i}")
    return f"""WITH RECURSIVE d AS ({rows}), fit(step, b0, b1, b2) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
      SELECT step + 1, {', '.join(solved)} FROM (
        SELECT step, b0, b1, b2, sum(y - p) AS g0, sum((y - p) * x1) - b1 AS g1, sum((y - p) * x2) - b2 AS g2,
          sum(w) AS h00, sum(w * x1) AS h01, sum(w * x2) AS h02, sum(w * x1 * x1) + 1 AS h11, sum(w * x1 * x2) AS h12, sum(w * x2 * x2) + 1 AS h22
        FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM fit, d WHERE step < {steps}))
        GROUP BY step, b0, b1, b2))
    SELECT unnest(['Intercept', 'kchars', 'kwords']) AS term, unnest([round(b0, 6), round(b1, 6), round(b2, 6)]) AS estimate FROM fit WHERE step = {steps}"""


@query("proc_logistic", _newton_sql(QUALITY_ROWS))
def proc_logistic(t: Tables):
    return _round(G.proc_logistic(_quality(t), "quality", ["kchars", "kwords"]).coefficients, ["estimate"], 6)


def _late(t: Tables):
    """Discounted lines as a score for being returned; prediction by threshold."""
    return t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("actual"),
        F.col("l_extendedprice").alias("score"),
        (F.col("l_extendedprice") > 60000).cast("int").alias("predicted"),
    )


LATE = """WITH s AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS actual, l_extendedprice AS score,
  CAST(l_extendedprice > 60000 AS INTEGER) AS predicted FROM lineitem)
"""


@query(
    "auc",
    f"""{LATE}, v AS (SELECT score, CAST(sum(actual) AS DOUBLE) AS p, CAST(sum(1 - actual) AS DOUBLE) AS q FROM s GROUP BY 1),
        c AS (SELECT p, q, sum(q) OVER (ORDER BY score) AS k FROM v)
        SELECT round(sum(p * (k - q / 2)) / (sum(p) * sum(q)), 9) AS auc FROM c""",
)
def auc(t: Tables):
    return H.auc(_late(t), "actual", "score").select(rnd("auc", 9).alias("auc"))


@query("confusion_matrix", f"{LATE} SELECT actual, predicted, count(*) AS n FROM s GROUP BY ALL")
def confusion_matrix(t: Tables):
    return H.confusion_matrix(_late(t), "actual", "predicted")


@query(
    "classification_report",
    f"""{LATE}, k AS (SELECT DISTINCT actual AS label FROM s),
        c AS (SELECT label, CAST(count_if(actual = label) AS BIGINT) AS support, count_if(predicted = label) AS chosen,
          count_if(actual = label AND predicted = label) AS hits FROM s, k GROUP BY 1),
        r AS (SELECT CAST(label AS VARCHAR) AS label, hits / chosen AS precision, hits / support AS recall, 2 * hits / (chosen + support) AS f1, support, hits FROM c)
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r
        UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM r
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
          round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r""",
)
def classification_report(t: Tables):
    return _round(H.classification_report(_late(t), "actual", "predicted"), ["precision", "recall", "f1"], 6)


@query(
    "first_per_group",
    """SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_totalprice > 100000) AS price
       FROM orders GROUP BY 1""",
)
def first_per_group(t: Tables):
    o = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"))
    return A.first_per_group(o, ["o_custkey"], "o_orderkey")


@query(
    "manifest_summary",
    """SELECT count(DISTINCT o_custkey) AS total_tables, count(*) AS total_rows,
       CAST(epoch(max(o_orderdate)) - epoch(min(o_orderdate)) AS DOUBLE) AS duration_seconds FROM orders""",
)
def manifest_summary(t: Tables):
    """A manifest with one entry per customer, timed by their orders."""
    entries = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderdate").cast("timestamp").alias("session_start"),
        F.max("o_orderdate").cast("timestamp").alias("session_end"),
    )
    return summary_of(entries)


@query(
    "monthly_summary",
    """SELECT strftime(o_orderdate, '%Y-%m-01') AS month, round(sum(o_totalprice), 2) AS total, count(o_totalprice) AS n,
       round(avg(o_totalprice), 4) AS average FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def monthly_summary(t: Tables):
    out = A.monthly_summary(t.orders, "o_orderdate", "o_totalprice", "1998-01-01")
    return _round(_round(out, ["total"], 2), ["average"])


@query(
    "totals_row",
    """WITH g AS (SELECT l_shipdate, l_returnflag, l_quantity FROM lineitem),
       a AS (SELECT l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity FROM g GROUP BY 1)
       SELECT * FROM a UNION ALL SELECT 'TOTAL', CAST(sum(n) AS BIGINT), sum(quantity) FROM a""",
)
def totals_row(t: Tables):
    table = t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )
    return A.totals_row(table, "flag")
