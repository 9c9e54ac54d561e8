"""Keyed comparison edge cases, against a brute-force pairing."""

import itertools
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from reconkit.operators import records as R
from reconkit.plans import align, compare

SCHEMA = "k int, s string, x double, d decimal(10,2)"


def brute(a, b, tol=1e-6):
    """Differences per column over all pairs of equal keys; null equals null."""
    out = {"pairs": 0, "s": 0, "x": 0, "d": 0}
    for p, q in itertools.product(a, b):
        if p[0] != q[0]:
            continue
        out["pairs"] += 1
        out["s"] += p[1] != q[1]
        for name, i in (("x", 2), ("d", 3)):
            if p[i] is None or q[i] is None:
                out[name] += (p[i] is None) != (q[i] is None)
            else:
                out[name] += abs(p[i] - q[i]) > tol
    return out


def _check(spark, a, b, tol=1e-6):
    got = R.value_differences(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ["k"], tolerance=tol)
    want = brute(a, b, tol)
    rows = {r.column_name: (r.compared, r.different) for r in got.collect()}
    assert rows == {c: (want["pairs"], want[c]) for c in ("s", "x", "d")}


def test_unique_keys_with_nulls(spark):
    a = [(1, "a", 1.0, Decimal("1.10")), (2, None, None, None), (None, "n", 3.0, None), (4, "d", 4.0, Decimal("4.00"))]
    b = [(1, "a", 1.0, Decimal("1.10")), (2, None, 2.0, None), (None, "m", 3.0, Decimal("3.00")), (5, "e", 4.0, None)]
    _check(spark, a, b)


def test_tolerance_edge(spark):
    a = [(1, "a", 1.0, None), (2, "a", 1.0, None), (3, "a", 0.0, None)]
    b = [(1, "a", 1.5, None), (2, "a", 1.25, None), (3, "a", 0.5, None)]
    _check(spark, a, b, tol=0.5)
    _check(spark, a, b, tol=0.25)


@pytest.mark.parametrize("swept", [0, 15, R.SWEPT_ROWS])
def test_hot_duplicate_key(spark, monkeypatch, swept):
    """All keys ranked, the hot ones ranked and the rest swept, all swept."""
    monkeypatch.setattr(R, "SWEPT_ROWS", swept)
    rng = np.random.default_rng(5)
    keys = np.where(rng.random(400) < 0.35, 0, rng.integers(0, 60, 400))

    def side(seed):
        r = np.random.default_rng(seed)
        return [
            (int(k) if k != 59 else None, str(r.choice(["a", "b"])) if r.random() > 0.1 else None,
             float(r.integers(0, 8)) if r.random() > 0.1 else None, Decimal(int(r.integers(0, 3))))
            for k in keys
        ]

    _check(spark, side(1), side(2), tol=1.0)


@pytest.mark.parametrize("paired,swept", [(64, 10_000), (8, 10_000), (8, 15)])
def test_often_repeated_keys_are_joined_once(spark, monkeypatch, paired, swept):
    """Only keys with more rows than a join should pair are swept or ranked, one-sided and null keys included."""
    monkeypatch.setattr(R, "SLICES", 1)
    monkeypatch.setattr(R, "PAIRED_ROWS", paired)
    monkeypatch.setattr(R, "SWEPT_ROWS", swept)
    if paired == 64:
        monkeypatch.setattr(R, "_duplicate_differences", None)

    def side(seed, only):
        r = np.random.default_rng(seed)
        keys = [None if k == 9 else int(k) for k in r.integers(0, 40, 140)] + [only] * 30 + [7] * 10
        text = lambda i: None if i == 3 else "abc"[i]
        return [(k, text(r.integers(0, 4)), None if r.random() < 0.2 else float(r.integers(0, 3)), Decimal(int(r.integers(0, 3)))) for k in keys]

    _check(spark, side(1, 100), side(2, 200))


def test_sweep_counts_pairs_like_all_pairs():
    rng = np.random.default_rng(8)
    group = np.sort(rng.integers(0, 30, 500))
    source = rng.random(500) < 0.5
    values = rng.choice([0.0, 0.25, 0.5, 1.0, np.inf, -np.inf, 3.0], 500)
    pairs = [(i, j) for i in np.flatnonzero(source) for j in np.flatnonzero(~source) if group[i] == group[j]]
    close = sum(values[i] == values[j] or abs(values[i] - values[j]) <= 0.25 for i, j in pairs)
    assert R._close_pairs(group, source, values, 0.25) == close
    assert R._equal_pairs(group, source, [values]) == sum(values[i] == values[j] for i, j in pairs)
    assert R._equal_pairs(group, source, []) == len(pairs)
    none = np.zeros(0, int)
    assert R._equal_pairs(none, none.astype(bool), []) == R._close_pairs(none, none.astype(bool), none.astype(float), 1.0) == 0


def test_keys_that_cross_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        a = [(i % 9, "ab"[i % 2], float(i % 5), Decimal(i % 3)) for i in range(120)]
        b = [(i % 9, "ab"[i % 3 > 0], float(i % 4), None) for i in range(100)]
        _check(spark, a, b)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_match_summary_counts(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,), (None,), (None,)], "k int")
    s = R.match_summary(R.match_records(a, b, ["k"])).first()
    assert (s.source_only, s.target_only, s.common_keys, s.duplicate_keys) == (1, 1, 2, 2)
    assert s.match_rate == 0.5


def test_empty_sides(spark):
    a = spark.createDataFrame([], SCHEMA)
    s = R.match_summary(R.match_records(a, a, ["k"])).first()
    assert (s.common_keys, s.match_rate) == (0, 0.0)
    assert {r.different for r in R.value_differences(a, a, ["k"]).collect()} == {0}


def test_sample_is_limited_per_column(spark):
    a = spark.range(500).selectExpr("id AS k", "id AS v", "'x' AS w")
    b = spark.range(500).selectExpr("id AS k", "id + 1 AS v", "CASE WHEN id < 7 THEN 'y' ELSE 'x' END AS w")
    counts = {r.column_name: r["count"] for r in R.difference_sample(a, b, ["k"]).groupBy("column_name").count().collect()}
    assert counts == {"v": 100, "w": 7}


EMPLOYEES = "employee_id bigint, first_name string, salary double"


@pytest.fixture(scope="module")
def employees(spark):
    return spark.createDataFrame([(i, f"n{i}", 1000.0 * i) for i in range(1, 6)], EMPLOYEES)


@pytest.mark.parametrize(
    "change,status",
    [
        (lambda d: d, "MATCH"),
        (lambda d: d.toDF("EMPLOYEE_ID", "First_Name", "SALARY"), "MATCH"),
        (lambda d: d.withColumnRenamed("salary", "pay"), "SCHEMA_MISMATCH"),
        (lambda d: d.filter("employee_id < 5"), "RECORD_COUNT_MISMATCH"),
        (lambda d: d.selectExpr("employee_id", "first_name", "IF(employee_id = 5, 1.0D, salary) AS salary"), "VALUE_DIFFERENCES"),
        (lambda d: d.selectExpr("CAST(employee_id AS string) AS employee_id", "first_name", "salary"), "MATCH"),
    ],
)
def test_compare_status(spark, employees, change, status):
    out = compare.compare_tables(employees, change(employees), "employees", ["employee_id"])
    assert out.summary.first().match_status == status


def test_statistical_difference_without_keys(spark):
    rng = np.random.default_rng(1)
    frame = lambda m: spark.createDataFrame(pd.DataFrame({"value": rng.normal(m, 15, 400)}))
    assert compare.compare_tables(frame(100), frame(120), "v").summary.first().match_status == "STATISTICAL_DIFFERENCES"


def test_sample_size_limits_keys(spark, employees):
    out = compare.compare_tables(employees, employees, "employees", ["employee_id"], sample_size=2).summary.first()
    assert (out.common_keys, out.match_status, out.sampled_keys) == (2, "MATCH", 2)
    whole = compare.compare_tables(employees, employees, "employees", ["employee_id"], sample_size=10**6).summary.first()
    assert whole.sampled_keys == employees.select("employee_id").distinct().count()


def test_multiset_compare_pairs_by_rank(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 400, 1000) / 4
    y = x + np.where(rng.random(1000) < 0.02, 0.25, 0.0)
    a = spark.createDataFrame(pd.DataFrame({"x": x, "s": x.astype(str)}))
    b = spark.createDataFrame(pd.DataFrame({"x": y, "s": x.astype(str)}))
    got = {r.column_name: r for r in align.column_multiset_compare(a, b).collect()}
    p, q = np.sort(x), np.sort(y)
    far = np.abs(p - q) > np.maximum(1e-5 * np.maximum(abs(p), abs(q)), 1e-8)
    assert got["x"].unequal == len({(u, v) for u, v in zip(p[far], q[far])})
    assert got["s"].values_match and not got["x"].values_match


def test_multiset_compare_type_and_null(spark):
    a = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    b = spark.createDataFrame([(1, "a"), (2, "b")], "n bigint, s string")
    got = {r.column_name: r for r in align.column_multiset_compare(a, b).collect()}
    assert not got["n"].type_match and not got["n"].values_match and not got["s"].values_match


def test_validate_frames(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k int, x double")
    b = spark.createDataFrame([(1, 1.0 + 1e-7), (2, 2.1), (3, None)], "k int, x double")
    verdict, cells = compare.validate_frames(a, b, ["k"], "t")
    assert not verdict.first().passed and [r.k for r in cells.collect()] == [2]
    assert compare.validate_frames(a, a, ["k"], "t")[0].first().passed
    assert not compare.validate_frames(a, a.select("x", "k"), ["k"], "t")[0].first().passed


def test_validate_numeric_tolerances(spark):
    cases = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 1.5), ("c", 1.0, None)], "test_name string, expected double, actual double")
    got = {r.test_name: r.passed for r in compare.validate_numeric(cases, 0.5).collect()}
    assert got == {"a": True, "b": True, "c": False}
    s = compare.validation_summary(compare.validate_numeric(cases, 0.1)).first()
    assert (s.total_tests, s.passed, s.failed) == (3, 1, 2)
    assert {r.test_name for r in compare.failed_tests(compare.validate_numeric(cases, 0.1)).collect()} == {"b", "c"}


SPECIAL = [1.0, 1.0000001, float("nan"), float("inf"), float("-inf"), None, 2.0]


def _differ(a, b):
    missing = [x is None or x != x for x in (a, b)]
    if any(missing):
        return missing[0] != missing[1]
    return a != b and not abs(a - b) <= 1e-6


def test_special_values_alike_for_unique_and_repeated_keys(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in SPECIAL for b in SPECIAL)]
    s = spark.createDataFrame([(k, a) for k, a, _ in rows], "k bigint, v double")
    t = spark.createDataFrame([(k, b) for k, _, b in rows], "k bigint, v double")
    want = sum(_differ(a, b) for _, a, b in rows)
    assert R.value_differences(s, t, ["k"]).first().different == want
    one = lambda df: df.selectExpr("1 AS k", "v")
    pairs = sum(_differ(a, b) for _, a, _ in rows for _, _, b in rows)
    assert R.value_differences(one(s), one(t), ["k"]).first().different == pairs


def test_sample_is_empty_only_if_nothing_differs(spark):
    import random

    rng = random.Random(1)
    source = [(rng.randrange(30), rng.choice([1.0, 2.0, 2.0, None])) for _ in range(60)]
    target = [(rng.randrange(30), rng.choice([1.0, 2.0, 2.0, None])) for _ in range(60)]
    s, t = (spark.createDataFrame(x, "k bigint, v double") for x in (source, target))
    found = {r.k for r in R.difference_rows(s, t, ["k"]).collect()}
    assert found == {k for k, a in source for j, b in target if j == k and _differ(a, b)}


def test_maps_and_decimals(spark):
    s = spark.sql("SELECT 1 AS k, map('a', 1, 'b', 2) AS m, CAST(1.00 AS decimal(10,2)) AS d")
    t = spark.sql("SELECT 1 AS k, map('b', 2, 'a', 1) AS m, CAST(1.0000001 AS decimal(10,7)) AS d")
    assert {r.column_name: r.different for r in R.value_differences(s, t, ["k"]).collect()} == {"m": 0, "d": 0}
    assert R.difference_rows(s, t, ["k"]).count() == 0


def test_empty_and_null_sides_are_compared(spark):
    a = spark.range(5).selectExpr("id AS k", "CAST(id AS double) AS v", "CAST(NULL AS double) AS w")
    out = compare.compare_tables(a, a.filter("k < 0"), "t", ["k"]).summary.first()
    assert out.match_status == "RECORD_COUNT_MISMATCH" and out.source_only == 5
    assert compare.compare_tables(a, a, "t", ["k"]).summary.first().match_status == "MATCH"
    part = compare.compare_tables(a, a, "t", ["k"], sample_size=2).summary.first()
    assert (part.sampled_keys, part.source_count, part.common_keys) == (2, 5, 2)


def test_nan_against_a_number_is_no_match(spark):
    from reconkit.plans.align import column_multiset_compare

    a = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k bigint, v double")
    b = spark.createDataFrame([(1, 5.0), (2, 1.0)], "k bigint, v double")
    matches = {r.column_name: r.values_match for r in column_multiset_compare(a, b).collect()}
    assert matches == {"k": True, "v": False}
    assert compare.validate_frames(a, b, ["k"], "x")[0].first().passed is False
    assert compare.validate_frames(a, a, ["k"], "x")[0].first().passed is True


def test_comparisons_run_at_once_and_keep_their_order(spark):
    import threading

    both = threading.Barrier(2)

    def run(name, status):
        both.wait(60)  # breaks unless the other comparison runs meanwhile
        if status == "ERROR":
            raise ValueError("no such table")
        return compare.Comparison(compare._summary_row(spark, {"table_name": name, "match_status": status}, 0.0), None, None)

    out = compare.compare_many([(n, lambda n=n, s=s: run(n, s)) for n, s in (("d", "MATCH"), ("b", "ERROR"))], spark).collect()
    assert [(r.table_name, r.match_status) for r in out] == [("d", "MATCH"), ("b", "ERROR: ValueError: no such table")]
