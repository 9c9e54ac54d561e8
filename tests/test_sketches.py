"""Profiles merged from sketches against profiles of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from reconkit.operators import profile as P, sketches as K


@pytest.fixture(scope="module")
def days(spark):
    rng = random.Random(3)
    rows = [
        (f"2024-01-{i % 30 + 1:02d}", rng.choice([None, float("nan"), rng.gauss(10, 5)]) if i % 30 else None, i % 17, rng.choice([None, "a", "bé" * (i % 9)]), i % 2 == 0, f"{2000 + i % 50}-02-03")
        for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "day string, x double, n int, s string, b boolean, d string")
    return df.withColumn("d", F.to_date("d")).repartition(4).cache()


def by_column(df):
    return {r["column_name"]: r.asDict() for r in df.collect()}


def test_thirty_days_equal_one_pass(days):
    daily = K.column_sketches(days, "day")
    assert daily.count() == 30 * 6
    merged = by_column(K.profile_from_sketches(K.merge_sketches(daily)))
    once = by_column(K.profile_from_sketches(K.merge_sketches(K.column_sketches(days))))
    exact = by_column(P.column_profile(days))
    assert list(merged) == days.columns == list(once)
    for c in days.columns:
        for f in ("data_type", "row_count", "null_count", "min_value", "max_value", "min_length", "max_length", "min_date", "max_date", "date_range_days"):
            assert merged[c][f] == once[c][f] == exact[c][f], (c, f)
        for f in ("mean_value", "std_value", "avg_length", "null_percentage"):
            want = exact[c][f]
            assert merged[c][f] == want or abs(merged[c][f] - want) < 1e-9 * max(1, abs(want)), (c, f)
        assert abs(merged[c]["unique_count"] - exact[c]["unique_count"]) <= 0.06 * exact[c]["unique_count"]


def test_quantiles_within_the_stated_rank_error(days):
    got = K.profile_from_sketches(K.merge_sketches(K.column_sketches(days, "day")), [0.01, 0.25, 0.9])
    values = sorted(r["x"] for r in days.select("x").collect() if r["x"] is not None and r["x"] == r["x"])
    row = got.filter("column_name = 'x'").first()
    for p in (0.01, 0.25, 0.9):
        at = sum(v <= row[f"q{p:g}"] for v in values) / len(values)
        assert abs(at - p) <= K.RANK_ERROR
    assert got.filter("column_name = 's'").first()["q0.9"] is None


def test_only_sketches_are_shuffled(days):
    plan = K.column_sketches(days, "day")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_period") == 1 and "partial_kll_sketch_agg_double" in plan


def test_no_rows_and_null_periods(spark, days):
    none = K.profile_from_sketches(K.merge_sketches(K.column_sketches(days.limit(0), "day")))
    assert none.count() == 0
    odd = K.column_sketches(days.withColumn("day", F.when(F.col("n") > 3, F.col("day"))), "day")
    assert odd.filter("period IS NULL").count() == 6
    assert K.profile_from_sketches(K.merge_sketches(odd)).first()["row_count"] == 6000
