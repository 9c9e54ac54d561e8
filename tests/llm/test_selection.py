"""Importance resampling and hard negatives against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reconkit.llm import hard_negatives, importance, queries


def runs(text, longest):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def bucket(run, buckets):
    return zlib.crc32(run.encode()) % buckets


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aBé1 .\n\x00{", max_size=30), min_size=1, max_size=5), st.integers(1, 3))
def test_buckets_of_runs(texts, longest):
    found, cuts, words = importance.Hasher(longest, 97)(pa.array(texts))
    for i, text in enumerate(texts):
        own, features = runs(text, longest)
        assert words[i] == len(own)
        assert Counter(found[cuts[i] : cuts[i + 1]].tolist()) == Counter(bucket(r, 97) for r in features)


def plain_scores(rows, target, longest, buckets, seed):
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            counts.update(bucket(r, buckets) for r in runs(x, longest)[1])
    top, below = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * top / ((s[b] + 1) * below))) for b in range(buckets)]
    out = []
    for i, x in rows:
        words, features = runs(x, longest)
        weight = sum(gain[bucket(r, buckets)] for r in features)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    return out


@pytest.mark.parametrize("percent, longest, least", [(10, 1, 20), (35, 2, 1), (100, 1, 0), (0, 1, 0)])
def test_resample(spark, awkward, rows_of, words, percent, longest, least):
    rng = random.Random(7)
    target = [" ".join(rng.choices(words[:50], k=40)) for _ in range(5)] + [None, ""]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    found = importance.resample(awkward, items, percent, longest, 500, 3, least).collect()
    want = plain_scores(rows_of(awkward), target, longest, 500, 3)
    assert Counter(tuple(r)[:5] for r in found) == Counter(want)
    pool = sorted((-s, i is None, i or 0) for i, n, _, _, s in want if n >= least)
    chosen = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in chosen] == list(range(1, percent * len(pool) // 100 + 1))
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in chosen] == pool[: len(chosen)]


def test_cutoff_inside_ties(spark, tmp_path):
    """A third of the rows share a score, and of these a third the id."""
    rng = random.Random(1)
    rows = [(rng.choice([5, 5, rng.randint(-(10**12), 10**12)]), rng.choice([7, None, rng.randint(-9, 10**15)])) for _ in range(400)]
    data = [(i, d, s) for i, (s, d) in enumerate(rows)]
    table = spark.createDataFrame(data, "row long, doc_id long, score long").repartition(4)
    table.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    ordered = sorted(data, key=lambda r: (-r[2], importance.LAST_ID if r[1] is None else r[1], r[0]))
    for wanted in (0, 133, 400):
        got = importance.ranks(importance.drawn(table, wanted), 5)
        assert [r["row"] for r in got.orderBy("rank").collect()] == [r[0] for r in ordered[:wanted]]
        assert got.select("rank").distinct().count() == wanted


def test_resample_of_nothing(spark, awkward, nothing):
    items = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(nothing, items).count() == 0
    found = importance.resample(awkward, items).collect()
    assert sum(r["rank"] is not None for r in found) == sum(r["n_words"] >= 20 for r in found) // 10 > 0


def test_importance_query(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, folder, "documents").collect()]
    target = [r["text"] for r in queries.table(spark, folder, "benchmark").collect()]
    want = plain_scores(docs, target, 1, 10_000, 2024)
    pool = sorted((-s, i) for i, n, _, _, s in want if n >= 20)
    rank = {i: n for n, (_, i) in enumerate(pool[: len(pool) // 10], 1)}
    got = queries.QUERIES["op12_importance"](spark, folder)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert {tuple(r) for r in got.collect()} == {(i, f, w, s, rank.get(i)) for i, _, f, w, s in want}


def plain_negatives(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """All scores with Python's whole numbers."""
    own = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [max(-(2**63), min(2**63 - 1, math.floor(scale * x))) if abs(scale * x) < 1e300 else int(math.copysign(2**63, x)) - (x > 0) for x in v]
        own[i] = min(own.get(i, (label, whole)), (label, whole))
    out = set()
    for a, (label, v) in own.items():
        if not is_anchor(a):
            continue
        score = {i: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w)))) for i, (_, w) in own.items() if i != a and len(w) == len(v)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if own[i][0] == label][:positives]:
            fit = [i for i in order if own[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]][:negatives]
            out |= {(a, p, n, i, score[p], score[i]) for n, i in enumerate(fit, 1)}
    return out


def vectors(seed, n, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    rows = []
    for i in range(n):
        c = rng.integers(6)
        v = (centres[c] + rng.normal(size=size) * 0.3) * rng.choice([0.1, 1, 1, 1, 3])
        rows.append((i, v.tolist(), int(c if rng.random() < 0.7 else rng.integers(6))))
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int, v int, size int, class string, cell int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c", 4) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block, anchors", [(16_384, 16_384), (40, 9), (7, 200)])
def test_hard_negatives(spark, block, anchors):
    rows = vectors(3, 700)
    rows += [(1000 + i, rows[i % 20][1], rows[i % 20][2] ^ (i % 2)) for i in range(200)]  # equal vectors: ties
    found = hard_negatives.mine(table(spark, rows), F.col("id") % 11 == 0, F.col("label"), block=block, anchor_block=anchors)
    want = plain_negatives(rows, lambda i: i % 11 == 0)
    assert len(want) > 300
    assert {tuple(r) for r in found.collect()} == want


def test_hard_negatives_of_awkward_rows(spark):
    rows = vectors(4, 60, 3)
    rows += [
        (None, [1.0, 2.0, 3.0], 1), (100, None, 1), (101, [1.0, 2.0, 3.0], None), (102, [1.0, None, 3.0], 1), (103, [1.0, math.nan, 3.0], 1),
        (104, [1.0, math.inf, 3.0], 1), (105, [], 1), (110, [], 1), (106, [0.0, 0.0, 0.0], 1), (107, [1e9, -1e9, 1e9], 2), (108, [1e9, -1e9, 0.9e9], 3),
        (109, [1e9, -1e9, 0.7e9], 2), (120, [1e30, 0.0, 0.0], 1), (111, [1.0, 2.0], 1), (112, [1.0, 2.1], 1), (113, [0.8, 1.7], 2), (0, [5.0, 5.0, 5.0], 0), (3, [9.0, 9.0, 9.0], 9),
    ]
    found = hard_negatives.mine(table(spark, rows), F.lit(True), F.col("label"))
    got, want = {tuple(r) for r in found.collect()}, plain_negatives(rows, lambda i: True)
    assert got == want
    assert any(a == 111 for a, *_ in got) and any(a == 107 for a, *_ in got)
    assert hard_negatives.mine(table(spark, []), F.lit(True), F.col("label")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.floats(0.05, 1.0))
def test_candidates_hold_all_that_score_enough(seed, share):
    rng = np.random.default_rng(seed)
    v = np.floor(256 * rng.normal(size=(300, 8)) * rng.uniform(0.9, 1, size=(300, 1))).astype(np.int64)
    block = hard_negatives.Block(np.arange(300), np.zeros(300, np.int64), v)
    q = v[0].astype(float)
    exact = v @ v[0]
    least = share * exact.max()
    found = block.candidates(q, least)
    want = np.flatnonzero(exact >= least)
    assert found is None or set(want) <= set(found.tolist())


def test_ranges_cut_where_vectors_differ():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    centres *= 4 / np.linalg.norm(centres, axis=1)[:, None]
    v = np.floor(256 * (np.repeat(centres, 50, axis=0) + 0.05 * rng.normal(size=(2000, 16)))).astype(np.int64)
    block = hard_negatives.Block(np.arange(2000), np.zeros(2000, np.int64), v)
    q = v[0].astype(float)
    found = block.candidates(q, 0.95 * float(q @ q))
    assert found is not None and len(found) < 200


def test_hard_negatives_query(spark, folder):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in queries.table(spark, folder, "embeddings").collect()]
    rows = [(i, v, (x + 1) % 10 if i % 7 == 0 else x) for i, v, x in rows]
    got = queries.QUERIES["op13_hard_negatives"](spark, folder)
    assert got.dtypes == [(c, "int" if c == "rank" else "bigint") for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    assert {tuple(r) for r in got.collect()} == plain_negatives(rows, lambda i: i % 50 == 0)
