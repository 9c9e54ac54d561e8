"""Digest trees and stored versions."""

import math
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reconkit.operators import digests as G, records as R
from reconkit.plans import align, versions as V

SCHEMA = "k long, part string, x double, s string, d date, m map<string,int>"


def rows(n, seed=1, hot=0.0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = 7 if rng.random() < hot else i
        out.append((k, rng.choice("abc") + str(i), rng.choice([None, math.nan, rng.random(), -0.0]), rng.choice([None, "", "é" * 3, str(i)]), None, {"a": i}))
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_digests_ignore_order_and_add_up(spark):
    data = rows(500)
    sums = []
    for parts, order in ((1, 1), (5, -1)):
        df = frame(spark, data[::order], parts)
        bounds = G.boundaries(frame(spark, data), "k", 64)
        nodes = G.leaf_digests(G.with_leaf(df, ["k", "part"], bounds, 64), ["k", "part"])
        sums.append((as_rows(nodes), as_rows(G.parents(G.parents(nodes)))))
        assert nodes.agg(F.sum("rows")).first()[0] == 500
    assert sums[0] == sums[1]
    assert len(sums[0][1]) == 1 and G.levels(64) == 2 and G.levels(4096) == 3


def test_digest_sees_every_change(spark):
    base = (1, "a", 0.5, "s", None, {"a": 1})
    found = set()
    variants = [
        base, (2, *base[1:]), (1, "b", *base[2:]), (1, "a", None, *base[3:]), (1, "a", 0.5000001, *base[3:]), (1, "a", 0.5, None, None, {"a": 1}),
        (1, "a", 0.5, "", None, {"a": 1}), (1, "a", 0.5, "s", None, {"a": 2}), (1, "a", 0.5, "s", None, None), (1, None, 0.5, "s", None, {"a": 1}),
    ]
    for v in variants:
        r = G.leaf_digests(frame(spark, [v], 1).withColumn("_leaf", F.lit(0)), ["k"]).first()
        found.add(tuple(r[d] for d in G.LANES))
    assert len(found) == len(variants)
    # missing in another way is the same
    same = [G.leaf_digests(frame(spark, [(1, "a", x, "s", None, {})], 1).withColumn("_leaf", F.lit(0)), ["k"]).first() for x in (None, math.nan)]
    assert same[0] == same[1]


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_ranges_are_even_even_with_a_hot_key(spark, hot):
    df = frame(spark, rows(3000, hot=hot))
    leafed = G.with_leaf(df, ["k", "part"], G.boundaries(df, "k", 16), 16)
    sizes = [r["count"] for r in leafed.groupBy("_leaf").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 3000 / 16 * 2.5
    # equal keys are never parted
    assert leafed.groupBy("k", "part").agg(F.countDistinct("_leaf").alias("n")).filter("n > 1").isEmpty()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 300), max_size=60), st.integers(1, 9))
def test_intervals_cover_all_ranges(nodes, most):
    runs = V.intervals(list(nodes), most)
    assert len(runs) <= most
    assert nodes <= {x for a, b in runs for x in range(a, b + 1)}
    if most >= len(nodes):
        assert nodes == {x for a, b in runs for x in range(a, b + 1)}


def versions(spark, tmp_path, a, b, keys, leaves=16, page_rows=50):
    source = V.write_version(a, str(tmp_path / "a"), keys, leaves, page_rows=page_rows)
    return source, V.write_version(b, str(tmp_path / "b"), keys, like=source, page_rows=page_rows)


@pytest.mark.parametrize("keys, hot", [(["k"], 0.3), (["part", "k"], 0.0)])
def test_equal_to_the_full_comparison(spark, tmp_path, keys, hot):
    data = rows(800, hot=hot)
    other = [(k, p, (x or 0.0) + 1.0 if i % 100 == 3 else x, s, d, m) for i, (k, p, x, s, d, m) in enumerate(data) if i % 150 != 7]
    other += [(None, "n", 1.0, "n", None, None), (9999, "zz", 1.0, None, None, {})]
    a, b = frame(spark, data), frame(spark, other)
    source, target = versions(spark, tmp_path, a, b, keys)
    assert as_rows(V.value_differences_by_digest(spark, source, target)) == as_rows(R.value_differences(a, b, keys))
    assert as_rows(V.difference_rows_by_digest(spark, source, target)) == as_rows(R.difference_rows(a, b, keys))
    unmatched = R.match_records(a, b, keys).filter("s_rows <> t_rows")
    assert as_rows(V.unmatched_records_by_digest(spark, source, target)) == as_rows(unmatched)


def test_equal_versions_and_empty_ones(spark, tmp_path):
    a = frame(spark, rows(200))
    source, target = versions(spark, tmp_path, a, frame(spark, rows(200)[::-1], 7), ["k"])
    assert V.changed_ranges(spark, source, target).isEmpty()
    got = V.value_differences_by_digest(spark, source, target).collect()
    assert {(r["compared"], r["different"]) for r in got} == {(200, 0)}
    columns = V.column_compare_by_digest(spark, source, target)
    assert as_rows(columns.drop("unequal")) == as_rows(align.column_multiset_compare(a, a).drop("unequal"))
    none = V.write_version(a.limit(0), str(tmp_path / "c"), ["k"], like=source)
    assert {r["different"] for r in V.value_differences_by_digest(spark, source, none).collect()} == {0}
    assert V.unmatched_records_by_digest(spark, source, none).count() == 200


def test_few_rows_are_read_again(spark, tmp_path):
    """One range in a hundred differs: at most one row in twenty is read by the comparison."""
    n, leaves = 25_600, 256
    a = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 1.5).alias("x"), F.lit("t").alias("s"))
    b = a.withColumn("x", F.when(F.col("k").isin(3000, 12_000, 20_001), F.lit(0.0)).otherwise(F.col("x")))
    source, target = versions(spark, tmp_path, a, b, ["k"], leaves)
    changed = [r["node"] for r in V.changed_ranges(spark, source, target).collect()]
    assert 1 <= len(changed) <= 6
    again = V.rows_in(spark, source, V.intervals(changed))
    again.collect()
    read = [int(m.value()) for m in _scan_metrics(again)]
    assert sum(read) <= n * 0.05
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "_leaf" in plan
    assert {(r["column_name"], r["compared"], r["different"]) for r in V.value_differences_by_digest(spark, source, target).collect()} == {("x", n, 3), ("s", n, 0)}


def _scan_metrics(df):
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        if p.nodeName().startswith("Scan parquet"):
            found.append(p.metrics().apply("numOutputRows"))
        if hasattr(p, "children"):
            kids = p.children()
            for i in range(kids.size()):
                walk(kids.apply(i))

    walk(plan.executedPlan() if plan.nodeName().startswith("Adaptive") else plan)
    return found


def test_versions_must_share_ranges(spark, tmp_path):
    a = V.write_version(frame(spark, rows(50)), str(tmp_path / "a"), ["k"], 16)
    b = V.write_version(frame(spark, rows(50, seed=2)), str(tmp_path / "b"), ["k"], 32)
    with pytest.raises(ValueError, match="like"):
        V.changed_ranges(spark, a, b)
    with pytest.raises(ValueError, match="keys"):
        V.write_version(frame(spark, rows(5)), str(tmp_path / "c"), ["part"], like=a)
    with pytest.raises(ValueError, match="power of two"):
        V.write_version(frame(spark, rows(5)), str(tmp_path / "d"), ["k"], 10)


def test_column_digests_sum_longs(spark):
    df = frame(spark, [(1, "a", 1.0, "s", None, {})], 1).withColumn("_leaf", F.lit(0))
    assert "decimal" not in G.column_digests(df)._jdf.queryExecution().optimizedPlan().toString()
