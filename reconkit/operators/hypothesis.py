"""Two-sample, paired and one-sample tests."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reconkit.functions import pvalues
from reconkit.operators.cumulative import cumulative
from reconkit.operators.quantiles import long_values
from reconkit.session import local_rows

RANK_STATS = "variable string, n1 bigint, n2 bigint, ks_d double, ks_p double, u double, mw_p double, note string"


def _sides(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, value, c1, c2): how often each value occurs on either side."""
    a = long_values(first, columns).withColumns({"c1": F.lit(1), "c2": F.lit(0)})
    b = long_values(second, columns).withColumns({"c1": F.lit(0), "c2": F.lit(1)})
    return a.unionByName(b).groupBy("variable", "value").agg(
        F.sum("c1").cast("bigint").alias("c1"), F.sum("c2").cast("bigint").alias("c2")
    )


def rank_statistics(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Kolmogorov-Smirnov distance and Mann-Whitney U per column, from one ranked table.

    U counts, for the first side, pairs won plus half the ties.  ``ties`` is the
    sum of t^3 - t over tied values.
    """
    ranked = cumulative(_sides(first, second, columns), "value", ["c1", "c2"], groups=["variable"])
    d = lambda c: F.col(c).cast("double")
    t = d("c1") + d("c2")
    share = lambda c: F.try_divide(d(f"before_{c}") + d(c), d(f"total_{c}"))
    gap = F.abs(share("c1") - share("c2"))  # null if a side has no value
    return ranked.groupBy("variable").agg(
        F.max("total_c1").alias("n1"),
        F.max("total_c2").alias("n2"),
        F.max(gap).alias("ks_d"),
        F.sum(d("c1") * (d("before_c2") + d("c2") / 2)).alias("u"),
        F.sum(t * t * t - t).alias("ties"),
    )


def _ks_p(n1: int, n2: int, d: float) -> float:
    if n1 * n2 <= pvalues.EXACT_KS_CELLS:
        return pvalues.ks_exact_sf(n1, n2, d)
    return pvalues.kolmogorov_sf(math.sqrt(n1 * n2 / (n1 + n2)) * d)


def _mw_p(n1: int, n2: int, u: float, ties: float) -> float:
    if not ties and min(n1, n2) <= pvalues.EXACT_MW_SIDE and n1 * n2 <= pvalues.EXACT_MW_CELLS:
        return pvalues.mw_exact_two_sided(n1, n2, u)
    n = n1 + n2
    spread = math.sqrt(max(0.0, n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))))
    if spread == 0:
        return 1.0
    return min(1.0, 2 * pvalues.normal_sf((max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / spread))


def distribution_tests(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """KS and Mann-Whitney, one row per column in the order given.

    Small sides get the exact laws (limits in ``pvalues``; Mann-Whitney without ties only),
    others the asymptotic ones.  A column without values on a side can't be tested: its row
    has the counts, no statistics, and says so in ``note``.  Only the finished statistics,
    one row per tested column, reach the driver.
    """
    found = {r.variable: r for r in rank_statistics(first, second, columns).collect()}
    rows = []
    for c in columns:
        r = found.get(c)
        n1, n2 = (r.n1, r.n2) if r else (0, 0)
        if n1 and n2:
            rows.append((c, n1, n2, r.ks_d, _ks_p(n1, n2, r.ks_d), r.u, _mw_p(n1, n2, r.u, r.ties), None))
        else:
            sides = "either side" if not (n1 or n2) else "the first side" if not n1 else "the second side"
            rows.append((c, n1, n2, None, None, None, None, f"no values on {sides}"))
    return local_rows(first.sparkSession, rows, RANK_STATS)


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve: U of positives against negatives; null with one class only."""
    pos = df.filter(F.col(label) == 1)
    neg = df.filter(F.col(label) == 0)
    s = rank_statistics(pos, neg, [score])
    return s.select(F.try_divide(F.col("u"), F.col("n1").cast("double") * F.col("n2")).alias("auc"))


TTEST = "test string, variable string, group1 string, group2 string, n1 bigint, n2 bigint, mean1 double, mean2 double, t double, df double, p double, significant boolean"


def _result(df: DataFrame, test, variable, groups, ns, means, t, dof, alpha) -> DataFrame:
    p = pvalues.t_two_sided(t, dof) if math.isfinite(t) else 0.0
    row = (test, variable, *groups, *ns, *means, float(t), float(dof), p, p < alpha)
    return local_rows(df.sparkSession, [row], TTEST)


def _ratio(diff: float, error: float) -> float:
    return diff / error if error else math.copysign(math.inf, diff) if diff else 0.0


def ttest_two_sample(df: DataFrame, variable: str, class_var: str, alpha: float = 0.05) -> DataFrame:
    """Pooled-variance t test between the two values of ``class_var``."""
    x = F.col(variable).cast("double")
    groups = (
        df.filter(F.col(class_var).isNotNull() & x.isNotNull())
        .groupBy(class_var)
        .agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.var_samp(x).alias("v"))
        .orderBy(class_var)
        .take(3)
    )
    if len(groups) != 2:
        raise ValueError(f"{class_var} must have exactly two values")
    a, b = groups
    dof = a.n + b.n - 2
    pooled = ((a.n - 1) * (a.v or 0.0) + (b.n - 1) * (b.v or 0.0)) / dof
    t = _ratio(a.m - b.m, math.sqrt(pooled * (1 / a.n + 1 / b.n)))
    names = (str(a[class_var]), str(b[class_var]))
    return _result(df, "two-sample", variable, names, (a.n, b.n), (a.m, b.m), t, dof, alpha)


def ttest_paired(df: DataFrame, variable: str, class_var: str, pair_key: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Paired t test; the two values of each pair share ``pair_key``."""
    levels = [r[0] for r in df.filter(F.col(class_var).isNotNull()).select(class_var).distinct().orderBy(class_var).take(3)]
    if len(levels) != 2:
        raise ValueError(f"{class_var} must have exactly two values")
    side = lambda i: F.max(F.when(F.col(class_var) == F.lit(levels[i]), F.col(variable).cast("double")))
    pairs = df.groupBy(*pair_key).agg(side(0).alias("a"), side(1).alias("b")).dropna(subset=["a", "b"])
    return paired_difference_test(pairs, "a", "b", variable, tuple(str(x) for x in levels), alpha)


def paired_difference_test(pairs: DataFrame, a: str, b: str, variable: str, names=("a", "b"), alpha: float = 0.05) -> DataFrame:
    diff = F.col(a).cast("double") - F.col(b).cast("double")
    s = pairs.agg(F.count(diff).alias("n"), F.avg(diff).alias("d"), F.stddev_samp(diff).alias("s"), F.avg(a).alias("ma"), F.avg(b).alias("mb")).first()
    if s.n < 2:
        raise ValueError("need at least two pairs")
    t = _ratio(s.d, s.s / math.sqrt(s.n))
    return _result(pairs, "paired", variable, names, (s.n, s.n), (s.ma, s.mb), t, s.n - 1, alpha)


def ttest_one_sample(df: DataFrame, variable: str, mean: float = 0.0, alpha: float = 0.05) -> DataFrame:
    """Mean against a constant, nulls dropped."""
    x = F.col(variable).cast("double")
    s = df.agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).first()
    if s.n < 2:
        raise ValueError("need at least two values")
    t = _ratio(s.m - mean, s.s / math.sqrt(s.n))
    return _result(df, "one-sample", variable, (variable, None), (s.n, None), (s.m, mean), t, s.n - 1, alpha)


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted rows."""
    cells = confusion_matrix(df, actual, predicted)  # classes squared
    one = lambda c: F.col(c).cast("string")
    per_class = (
        cells.select(
            F.explode(
                F.array(
                    F.struct(one(actual).alias("label"), F.col("n").alias("act"), F.lit(0).cast("bigint").alias("pre")),
                    F.struct(one(predicted).alias("label"), F.lit(0).cast("bigint").alias("act"), F.col("n").alias("pre")),
                )
            ).alias("s"),
            F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0).alias("hit"),
        )
        .groupBy("s.label")
        .agg(F.sum("s.act").alias("support"), F.sum("s.pre").alias("chosen"), (F.sum("hit") / 2).alias("hits"))
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    scored = per_class.select(
        "label",
        ratio(F.col("hits"), F.col("chosen")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("chosen") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )
    names = ("precision", "recall", "f1")
    accuracy = F.sum("hits") / F.sum("support")
    summary = [
        scored.agg(F.lit("accuracy").alias("label"), *[accuracy.alias(c) for c in names], F.sum("support").alias("support")),
        scored.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support")),
        scored.agg(
            F.lit("weighted avg").alias("label"),
            *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names],
            F.sum("support").alias("support"),
        ),
    ]
    out = scored.drop("hits")
    for row in summary:
        out = out.unionByName(row)
    return out
