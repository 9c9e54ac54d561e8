"""Copies in batches: what readers see after failures, repeats and resumed runs."""

import pytest
from pyspark.sql import functions as F

from reconkit.sources import batches as B


def rows(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").alias("Key"), (F.col("id") % 3).alias("p"))


def test_nothing_is_seen_before_the_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    staged = B.stage_batch(rows(spark, 10), path, "b1", ["p"])
    assert B.read_committed(spark, path).isEmpty() and B.committed_batches(spark, path).isEmpty()
    assert [(r["batch_id"], r["files"] > 0) for r in B.uncommitted(spark, path).collect()] == [("b1", True)]
    B.commit_batch(spark, staged)
    assert B.read_committed(spark, path).count() == 10
    assert B.uncommitted(spark, path).isEmpty()


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    B.write_batch(rows(spark, 10), path, "b1")
    B.write_batch(rows(spark, 5, 100), path, "b2")
    B.write_batch(rows(spark, 7), path, "b1")
    got = B.read_committed(spark, path)
    assert sorted((r["batch_id"], r["key"]) for r in got.collect()) == [*(("b1", i) for i in range(7)), *(("b2", i) for i in range(100, 105))]
    assert B.read_committed(spark, path, ["b2"]).count() == 5
    assert B.all_commits(spark, path).count() == 3 and {r["row_count"] for r in B.committed_batches(spark, path).collect()} == {7, 5}
    assert B.uncommitted(spark, path).count() == 1
    with pytest.raises(ValueError, match="not committed"):
        B.read_committed(spark, path, ["b3"])


def test_a_job_that_dies_between_stage_and_commit(spark, tmp_path, monkeypatch):
    path, ids = str(tmp_path / "t"), ["d1", "d2", "d3"]
    of = lambda b: rows(spark, 4, ids.index(b) * 10)
    whole = B.commit_batch

    def dies(session, staged):
        if staged["batch_id"] == "d2":
            raise RuntimeError("killed")
        whole(session, staged)

    monkeypatch.setattr(B, "commit_batch", dies)
    with pytest.raises(RuntimeError):
        B.copy_batches(spark, path, ids, of)
    assert {r["batch_id"] for r in B.read_committed(spark, path).select("batch_id").collect()} == {"d1"}
    monkeypatch.setattr(B, "commit_batch", whole)
    assert B.copy_batches(spark, path, ids, of) == ["d2", "d3"]
    assert B.copy_batches(spark, path, ids, of) == []
    assert sorted(r["key"] for r in B.read_committed(spark, path).collect()) == [0, 1, 2, 3, 10, 11, 12, 13, 20, 21, 22, 23]
    assert B.copy_batches(spark, path, ["d1"], of, redo=True) == ["d1"] and B.read_committed(spark, path).count() == 12


def test_batches_of_other_columns_and_empty_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    B.write_batch(rows(spark, 3), path, "a", ["p"])
    B.write_batch(rows(spark, 2).withColumn("extra", F.lit("e")), path, "b", ["p"])
    B.write_batch(rows(spark, 0), path, "c", ["p"])
    got = B.read_committed(spark, path)
    assert sorted((r["batch_id"], r["key"], r["extra"]) for r in got.collect()) == [("a", 0, None), ("a", 1, None), ("a", 2, None), ("b", 0, "e"), ("b", 1, "e")]
    with pytest.raises(ValueError, match="batch id"):
        B.write_batch(rows(spark, 1), path, "../x")


def test_batch_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    for b in ("01", "02"):
        B.write_batch(rows(spark, 3), path, b)
    one = B.read_committed(spark, path).filter("batch_id = '02'")
    assert "PartitionFilters: [isnotnull(batch_id" in one._jdf.queryExecution().executedPlan().toString()
    assert {r["batch_id"] for r in one.collect()} == {"02"}
