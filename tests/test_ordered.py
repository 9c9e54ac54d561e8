"""Distributed order-dependent operators against pandas, hot groups included."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from reconkit.operators import ordering as O, windows as V
from reconkit.operators.cumulative import cumulative, with_position
from reconkit.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows in one group, one value very frequent, some nulls."""
    rng = np.random.default_rng(3)
    n = 3000
    g = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 300, n).astype(str))
    x = np.where(rng.random(n) < 0.3, 7.0, rng.normal(0, 50, n).round(1))
    x[rng.random(n) < 0.2] = np.nan
    t = np.where(rng.random(n) < 0.4, 5, rng.integers(0, 1000, n))
    return pd.DataFrame({"id": np.arange(n), "g": g, "t": t, "x": x})


@pytest.fixture(scope="module")
def frame(spark, skewed):
    df = spark.createDataFrame(skewed)
    return df.withColumn("x", F.when(~F.isnan("x"), F.col("x"))).repartition(4).cache()


def _by_id(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


def test_position_in_skewed_groups(frame, skewed):
    got = _by_id(with_position(frame, ["t", "id"], ["g"]))
    want = skewed.sort_values(["t", "id"]).groupby("g").cumcount().add(1).sort_index()
    assert (got.pos.values == want.values).all()


def test_rolling_crosses_chunks(frame, skewed):
    got = _by_id(V.rolling_mean(frame, "x", 3, ["t", "id"], ["g"]))
    ordered = skewed.sort_values(["t", "id"])
    want = ordered.groupby("g")["x"].transform(lambda s: s.rolling(3).mean()).sort_index()
    assert len(got) == len(skewed)
    np.testing.assert_allclose(got["rolling"].astype(float), want, rtol=1e-9, atol=1e-9)


def test_expanding_sum(frame, skewed):
    got = _by_id(V.expanding_sum(frame, "x", ["t", "id"]))
    want = skewed.sort_values(["t", "id"])["x"].fillna(0).cumsum().sort_index()
    seen = skewed.sort_values(["t", "id"])["x"].notna().cummax().sort_index()
    np.testing.assert_allclose(got["running"].astype(float)[seen], want[seen], atol=1e-6)


def test_interpolate(frame, skewed):
    got = _by_id(V.interpolate_linear(frame, "x", ["t", "id"], ["g"]))
    ordered = skewed.sort_values(["t", "id"])
    want = ordered.groupby("g")["x"].transform(lambda s: s.interpolate()).sort_index()
    np.testing.assert_allclose(got["filled"].astype(float), want, atol=1e-9)


def test_rank_factorize_qcut(frame, skewed):
    assert np.allclose(_by_id(V.rank_min(frame, "x"))["rank"].astype(float), skewed.x.rank(method="min"), equal_nan=True)
    assert (_by_id(V.factorize(frame, "g", "id")).code.values == pd.factorize(skewed.g)[0]).all()
    got = _by_id(V.qcut(frame, "t", ["a", "b"])).quantile_bin
    want = pd.cut(skewed.t, [skewed.t.min() - 1, skewed.t.median(), skewed.t.max()], labels=["a", "b"])
    assert (got.values == want.astype(str).values).all()


def test_quantiles_match_pandas(frame, skewed):
    got = exact_quantiles(frame, ["x", "t"], {"a": 0.1, "b": 0.5, "c": 0.99}, ["g"]).toPandas()
    want = skewed.groupby("g")["x"].quantile([0.1, 0.5, 0.99]).unstack()
    got = got[got.variable == "x"].set_index("g").sort_index()
    want = want.dropna()
    np.testing.assert_allclose(got[["a", "b", "c"]].loc[want.index], want, atol=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=60), st.sampled_from([2, 8]))
def test_cumulative_property(spark, rows, buckets):
    pdf = pd.DataFrame(rows, columns=["g", "v"]).groupby(["g", "v"]).size().rename("n").reset_index()
    got = cumulative(spark.createDataFrame(pdf), "v", ["n"], groups=["g"], buckets=buckets).toPandas()
    pdf["before_n"] = pdf.groupby("g")["n"].cumsum() - pdf["n"]
    pdf["total_n"] = pdf.groupby("g")["n"].transform("sum")
    merged = got.merge(pdf, on=["g", "v"], suffixes=("", "_want"))
    assert len(merged) == len(pdf)
    assert (merged.before_n == merged.before_n_want).all() and (merged.total_n == merged.total_n_want).all()


def test_first_rows_are_cut_before_the_shuffle(frame):
    plan = O.sort_nodupkey(frame, ["g"], ["t", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_first_n_above_the_group_limit(spark, frame, skewed):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = O.first_n_per_group(frame, ["g"], ["t", "id"], 20).count()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == skewed.groupby("g").size().clip(upper=20).sum()


def test_sort_puts_nulls_last_both_ways(frame):
    for up in (True, False):
        xs = [r.x for r in O.proc_sort(frame.select("x"), ["x"], up).collect()]
        known = [x for x in xs if x is not None]
        assert xs[: len(known)] == known == sorted(known, reverse=not up)


def test_sample_is_stable(frame):
    a, b = (O.sample_n(frame, 50, 9, ["id"]).select("id").collect() for _ in range(2))
    assert a == b and len(a) == 50


def test_large_samples_are_the_first_by_digest_and_not_held_in_a_task(spark):
    df = spark.range(30_000, numPartitions=4)
    by_digest = sorted(range(30_000), key=lambda i: hashlib.md5(f"{i}|9".encode()).hexdigest())
    got = O.sample_n(df, 20_000, 9, ["id"])
    assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in got.collect()) == sorted(by_digest[:20_000])
    assert O.sample_n(df, 10**9, 9, ["id"]).count() == 30_000


def test_ranks_of_large_integers_stay_apart(spark):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,), (5,)], "v bigint")
    assert sorted(r["rank"] for r in V.rank_min(df, "v").collect()) == [1, 2, 3]


def test_window_longer_than_a_chunk(spark):
    df = spark.range(40).selectExpr("id", "CAST(id AS double) AS x")
    got = {r["id"]: r["rolling"] for r in V.rolling_mean(df, "x", 12, ["id"]).collect()}
    assert got[10] is None and got[11] == 5.5 and got[39] == 33.5


def test_transpose_beyond_five_hundred_rows(spark):
    from reconkit.operators.reshape import transpose_full

    row = transpose_full(spark.range(700).selectExpr("concat('r', id) AS name", "id * 2 AS v"), "name").collect()
    assert len(row) == 1 and row[0]["key"] == "v" and row[0]["r699"] == 1398


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.floats(-5, 5) | st.none()), min_size=1, max_size=60), st.integers(1, 25), st.booleans())
def test_rolling_mean_across_many_limits(spark, rows, size, grouped):
    """Windows longer than a range take rows from several ranges before."""
    df = spark.createDataFrame([(i, g, x) for i, (g, x) in enumerate(rows)], "id long, g string, x double").repartition(3)
    got = {r["id"]: r["rolling"] for r in V.rolling_mean(df, "x", size, ["id"], ["g"] if grouped else []).collect()}
    assert len(got) == len(rows)
    seen = {}
    for i, (g, x) in enumerate(rows):
        own = seen.setdefault(g if grouped else 0, [])
        own.append(x)
        last = own[-size:]
        want = sum(last) / size if len(last) == size and None not in last else None
        assert (got[i] is None) == (want is None) and (want is None or abs(got[i] - want) < 1e-9)


def test_rows_move_once_after_they_are_stored(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).cast("double").alias("x"))
    whole = lambda d: d._jdf.queryExecution().executedPlan().toString()
    rolled = whole(V.rolling_mean(df, "x", 5, ["id"]))
    # one exchange of the rows, by the number of their range; the window above it needs none
    assert rolled.count("shufflepartitionidpassthrough") == 1 and rolled.count("_halo") and "_chunk" not in rolled
    above = rolled[: rolled.index("shufflepartitionidpassthrough")]
    assert "Window" in above and "hashpartitioning" not in above
    assert "row_number" not in whole(with_position(df, ["id"]))


def test_transpose_in_blocks(spark):
    """Thousands of rows become columns without a wide row anywhere; a block can be looked at as a table."""
    from reconkit.operators.reshape import block_table, transpose_blocks

    df = spark.range(2500).selectExpr("concat('r', lpad(id, 4, '0')) AS name", "id * 2 AS v", "if(id % 3 = 0, null, id) AS w").repartition(5)
    cells, labels = transpose_blocks(df, "name", 400)
    got = {(r["key"], r["block"]): r["values"] for r in cells.collect()}
    names = {r["block"]: r["labels"] for r in labels.collect()}
    assert set(got) == {(k, b) for k in "vw" for b in range(7)} and len(got["v", 6]) == 100
    assert [x for b in range(7) for x in got["v", b]] == list(range(0, 5000, 2))
    assert [x for b in range(7) for x in got["w", b]] == [None if i % 3 == 0 else i for i in range(2500)]
    assert [x for b in range(7) for x in names[b]] == [f"r{i:04}" for i in range(2500)]
    table = block_table(cells, labels, 1).filter("key = 'v'").collect()
    assert len(table) == 1 and table[0]["r0400"] == 800 and len(table[0]) == 401
    twice = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "z")], "i string, n int, s string")
    cells, labels = transpose_blocks(twice, "i", 10)
    assert block_table(cells, labels, 0).columns == ["key", "a", "a_2", "None"]
    assert {tuple(sorted(r["values"])) for r in cells.collect()} == {("1", "2", "3"), ("x", "y", "z")}
    assert transpose_blocks(twice.limit(0), "i")[0].count() == 0
