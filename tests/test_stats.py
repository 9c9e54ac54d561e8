"""Tests, regressions and probabilities against direct computation."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from reconkit.functions import pvalues as P
from reconkit.operators import aggregates as A, hypothesis as H, regression as G


def test_probabilities():
    # Textbook table values.
    assert P.normal_sf(1.959963985) == pytest.approx(0.025, abs=1e-9)
    assert P.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert P.t_quantile(0.975, 10) == pytest.approx(2.228138852, abs=1e-7)
    assert P.f_sf(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-6)
    assert P.kolmogorov_sf(1.3580986) == pytest.approx(0.05, abs=1e-6)
    assert P.beta_cdf(0.5, 2, 2) == pytest.approx(0.5)
    assert (P.kolmogorov_sf(0.0), P.t_two_sided(0, 5)) == (1.0, pytest.approx(1.0))


def test_rank_tests_against_pairs(spark):
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 30, 150) / 3, rng.integers(5, 40, 90) / 3
    frame = lambda v: spark.createDataFrame(pd.DataFrame({"v": v}))
    r = H.distribution_tests(frame(x), frame(y), ["v"]).first()
    u = (x[:, None] > y).sum() + 0.5 * (x[:, None] == y).sum()
    grid = np.union1d(x, y)
    d = max(abs((x <= g).mean() - (y <= g).mean()) for g in grid)
    assert (r.n1, r.n2, r.u) == (150, 90, u) and r.ks_d == pytest.approx(d)
    ties = sum(c**3 - c for c in np.unique(np.r_[x, y], return_counts=True)[1])
    sd = math.sqrt(150 * 90 / 12 * (241 - ties / (240 * 239)))
    assert r.mw_p == pytest.approx(2 * P.normal_sf((max(u, 150 * 90 - u) - 150 * 45 - 0.5) / sd))
    same = H.distribution_tests(frame(x), frame(x), ["v"]).first()
    assert same.ks_d == 0 and same.ks_p == 1.0 and same.mw_p == 1.0


def _all_orders(n1, n2):
    """(KS distance, U) of every way to pick which of the pooled ranks are the first side's."""
    for first in itertools.combinations(range(n1 + n2), n1):
        mine, i, d = set(first), 0, 0.0
        for r in range(n1 + n2):
            i += r in mine
            d = max(d, abs(i / n1 - (r + 1 - i) / n2))
        yield d, sum(r - k for k, r in enumerate(first))


@pytest.mark.parametrize("n1, n2", [(1, 1), (1, 6), (6, 5), (3, 7), (4, 4), (8, 2)])
def test_exact_laws_by_enumeration(n1, n2):
    found = list(_all_orders(n1, n2))
    for d in {round(x, 12) for x, _ in found}:
        want = sum(x >= d - 1e-9 for x, _ in found) / len(found)
        assert P.ks_exact_sf(n1, n2, d) == pytest.approx(want, abs=1e-12)
    counts = P.rank_set_counts(min(n1, n2), max(n1, n2))
    assert counts == [sum(u == v for _, v in found) for u in range(n1 * n2 + 1)]
    for u in range(n1 * n2 + 1):
        want = min(1.0, 2 * sum(v >= max(u, n1 * n2 - u) for _, v in found) / len(found))
        assert P.mw_exact_two_sided(n1, n2, u) == pytest.approx(want, abs=1e-12)


def test_exact_laws_known_values():
    assert P.ks_exact_sf(6, 5, 0.5) == pytest.approx(0.357142857, abs=1e-9)
    assert P.mw_exact_two_sided(6, 5, 6) == pytest.approx(0.125541126, abs=1e-9)
    assert P.ks_exact_sf(50, 40, 1.0) == pytest.approx(2 / math.comb(90, 40), rel=1e-9)  # small ones stay accurate
    assert P.ks_exact_sf(5, 9, 0.0) == 1.0
    # close to the asymptotic law where sides are large
    assert P.ks_exact_sf(100, 100, 0.2) == pytest.approx(P.kolmogorov_sf(math.sqrt(50) * 0.2), abs=0.01)


def test_small_sides_and_untestable_columns(spark):
    schema = "v double, w double, only double, none double"
    a = spark.createDataFrame([(float(x), 1.0, 1.0, None) for x in (1, 2, 3, 4, 5, 11)], schema)
    b = spark.createDataFrame([(x, float(x > 7), None, None) for x in (3.5, 6.0, 7.0, 8.0, 9.0)], schema)
    got = H.distribution_tests(a, b, ["v", "w", "only", "none"]).collect()
    assert [r.variable for r in got] == ["v", "w", "only", "none"]
    v, w, only, none = got
    assert v.ks_p == pytest.approx(P.ks_exact_sf(6, 5, v.ks_d)) and v.mw_p == pytest.approx(P.mw_exact_two_sided(6, 5, v.u))
    assert w.mw_p == pytest.approx(H._mw_p(6, 5, w.u, 528)) and w.note is None  # tied values: asymptotic
    assert (only.n1, only.n2, only.ks_p, only.mw_p, only.note) == (6, 0, None, None, "no values on the second side")
    assert (none.n1, none.n2, none.u, none.note) == (0, 0, None, "no values on either side")


def test_t_tests(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(5, 2, 40), rng.normal(6, 2, 40)
    pdf = pd.DataFrame({"id": np.r_[range(40), range(40)], "g": ["a"] * 40 + ["b"] * 40, "v": np.r_[a, b]})
    df = spark.createDataFrame(pdf)
    two = H.ttest_two_sample(df, "v", "g").first()
    pooled = (a.var(ddof=1) + b.var(ddof=1)) / 2
    assert two.t == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled * 2 / 40)) and two.df == 78
    paired = H.ttest_paired(df, "v", "g", ["id"]).first()
    diff = a - b
    assert paired.t == pytest.approx(diff.mean() / (diff.std(ddof=1) / math.sqrt(40)))
    one = H.ttest_one_sample(df.filter("g = 'a'"), "v").first()
    assert one.t == pytest.approx(a.mean() / (a.std(ddof=1) / math.sqrt(40))) and one.significant
    with pytest.raises(ValueError):
        H.ttest_two_sample(df, "v", "id")


def test_regression_against_least_squares(spark):
    rng = np.random.default_rng(7)
    n = 200
    x1, x2, c = rng.normal(size=n), rng.normal(size=n), rng.choice(["u", "v", "w"], n)
    y = 3 + 2 * x1 - x2 + (c == "v") * 1.5 + rng.normal(size=n)
    fit = G.proc_reg(spark.createDataFrame(pd.DataFrame({"y": y, "x1": x1, "x2": x2, "c": c})), "y ~ x1 + x2 + c")
    design = np.c_[x1, x2, c == "v", c == "w", np.ones(n)].astype(float)
    beta, rss = np.linalg.lstsq(design, y, rcond=None)[:2]
    rows = {r.term: r for r in fit.coefficients.collect()}
    assert rows["x1"].estimate == pytest.approx(beta[0]) and rows["Intercept"].estimate == pytest.approx(beta[4])
    assert rows["c_v"].estimate == pytest.approx(beta[2])
    se = math.sqrt(rss[0] / (n - 5) * np.linalg.inv(design.T @ design)[0, 0])
    half = P.t_quantile(0.975, n - 5) * se
    assert rows["x1"].std_error == pytest.approx(se) and rows["x1"].ci_low == pytest.approx(beta[0] - half)
    f = fit.fit.first()
    llf = -n / 2 * (math.log(2 * math.pi * rss[0] / n) + 1)
    assert f.aic == pytest.approx(-2 * llf + 10) and f.bic == pytest.approx(-2 * llf + 5 * math.log(n))
    assert fit.rows.count() == n and {"fitted", "residual", "y"} <= set(fit.rows.columns)


def test_logistic_gradient_vanishes(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 2))
    y = (rng.random(300) < 1 / (1 + np.exp(-(0.5 + x @ [1.0, -2.0])))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y}))
    fit = G.proc_logistic(df, "y", ["a", "b"])
    w = {r.term: r.estimate for r in fit.coefficients.collect()}
    beta = np.array([w["a"], w["b"]])
    residual = 1 / (1 + np.exp(-(w["Intercept"] + x @ beta))) - y
    np.testing.assert_allclose(x.T @ residual + beta, 0, atol=1e-3)
    assert abs(residual.sum()) < 1e-3
    score = x @ beta
    pos, neg = score[y == 1], score[y == 0]
    assert fit.auc.first().auc == pytest.approx((pos[:, None] > neg).mean())
    report = {r.label: r for r in fit.report.collect()}
    assert report["accuracy"].recall == pytest.approx(((score + w["Intercept"] > 0) == y).mean())
    assert sum(r.n for r in fit.confusion.collect()) == 300


rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.floats(-1e6, 1e6)), min_size=2, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_frequency_and_mean_properties(spark, data):
    df = spark.createDataFrame(data, "g string, x double")
    freq = A.proc_freq_oneway(df, ["g"]).collect()
    present = [g for g, _ in data if g is not None]
    assert sum(r.frequency for r in freq) == len(present) and len(freq) == len(set(present))
    m = A.proc_means(df, ["x"]).first()
    assert m.min - 1e-6 <= m.mean <= m.max + 1e-6 and m.std >= 0 and m.n == len(data)


def test_univariate_adjustment_and_empty(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.5, 9.0, 4.0, 4.0]})
    u = A.proc_univariate(spark.createDataFrame(pdf)).first()
    assert u.skew == pytest.approx(pdf.x.skew()) and u.kurtosis == pytest.approx(pdf.x.kurt())
    nulls = spark.createDataFrame([(None,), (None,)], "x double")
    e = A.proc_univariate(nulls).first()
    assert (e.n, e.missing, e.median, e.skew) == (0, 2, None, None)
    assert A.proc_freq_total(spark.createDataFrame([], "s string")).count() == 0


def test_having_rejects_unknown_function(spark):
    with pytest.raises(ValueError):
        A.group_by_having(spark.range(3), ["id"], {"id": "mode"})


def test_margin_named_like_a_level_is_an_error(spark):
    from pyspark.errors import PySparkException

    df = spark.createDataFrame([("Total", "A"), ("x", "Total"), ("x", "A")], "g string, v string")
    with pytest.raises(PySparkException, match="named like the margin"):
        A.proc_freq_by(df, "g", "v").collect()
    rows = {r["g"]: r["All"] for r in A.crosstab_margins(df, "g", "v").collect()}
    assert rows == {"Total": 1, "x": 2, "All": 3}


def test_nan_is_missing_in_statistics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", 4.0)], "g string, x double")
    row = A.proc_means(df, ["x"], stats=("n", "mean", "max", "missing")).first()
    assert (row["n"], round(row["mean"], 6), row["max"], row["missing"]) == (3, round(8 / 3, 6), 4.0, 1)
    wide = {r["g"]: (r["x_median"], r["x_mean"]) for r in A.proc_means_wide(df, ["x"], ["g"], ("median", "mean")).collect()}
    assert wide == {"a": (2.0, 2.0), "b": (4.0, 4.0)}
    bins = A.histogram(df.union(spark.sql("SELECT 'c', double('infinity')")), "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [1, 0, 2]


def test_auc_with_one_class(spark):
    from reconkit.operators.hypothesis import auc

    assert auc(spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double"), "y", "s").first()["auc"] is None


def test_logistic_by_newton_steps(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 2)) * [1, 200]
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.4 + x @ [1.5, -0.01])))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "a": x[:, 0], "b": x[:, 1]})).repartition(3)
    fit = G.proc_logistic(df, "y", ["a", "b"], math.inf)
    beta, z = np.zeros(3), np.column_stack([np.ones(400), x])
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ beta))
        beta += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (y - p))
    got = {r.term: r.estimate for r in fit.coefficients.collect()}
    assert [got["Intercept"], got["a"], got["b"]] == pytest.approx(beta.tolist(), rel=1e-6) and fit.converged and fit.steps < 12
    strong = G.proc_logistic(df, "y", ["a", "b"], 1e-9).coefficients.collect()
    assert abs(strong[1].estimate) < 1e-6 and strong[0].estimate == pytest.approx(math.log(y.mean() / (1 - y.mean())), abs=0.05)


def test_logistic_of_separated_classes_and_odd_targets(spark):
    df = spark.createDataFrame([(0, -2.0), (0, -1.0), (1, 1.0), (1, 3.0), (None, 9.0), (1, None)], "y int, x double")
    assert not G.proc_logistic(df, "y", ["x"], math.inf).converged
    fit = G.proc_logistic(df, "y", ["x"])
    assert fit.converged and fit.auc.first().auc == 1.0 and fit.predictions.count() == 4
    with pytest.raises(ValueError, match="0 or 1"):
        G.proc_logistic(df.withColumn("y", df.y + 1), "y", ["x"])
    with pytest.raises(ValueError, match="no complete"):
        G.proc_logistic(df.filter("x is null"), "y", ["x"])
