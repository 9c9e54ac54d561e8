"""Writing, manifests, cutoffs and database read options."""

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from reconkit import session
from reconkit.plans.migrate import TableJob, run_migration
from reconkit.sources import scan, write


def test_modes_and_file_size(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id AS `Row ID`", "id % 2 AS Part").coalesce(1)
    write.write_partitioned_parquet(df, path, ["part"], max_rows=100)
    assert write.size_estimate(spark, path).first().files == 10
    assert set(spark.read.parquet(path).columns) == {"row_id", "part"}
    write.write_partitioned_parquet(df.filter("Part = 1").limit(5), path, ["part"], "overwrite_partitions")
    assert spark.read.parquet(path).groupBy("part").count().orderBy("part").collect() == [(0, 500), (1, 5)]
    write.write_partitioned_parquet(df.limit(3), path, ["part"], "append")
    assert spark.read.parquet(path).count() == 508
    with pytest.raises(ValueError):
        write.write_partitioned_parquet(df, path, mode="merge")


def test_cutoff_keeps_its_own_second(spark, tmp_path):
    at = datetime(2024, 1, 1, 12, 0, 0, 123456)
    df = write.stamp_lineage(spark.range(3), at).unionByName(write.stamp_lineage(spark.range(2), datetime(2024, 1, 1, 12, 0, 0, 123457)))
    assert scan.cutoff_filter(df, at).count() == 3 and scan.cutoff_filter(df, None).count() == 5


def test_cutoff_reaches_the_scan(spark, tmp_path):
    path = write.write_partitioned_parquet(write.stamp_lineage(spark.range(5), datetime(2024, 1, 1)), str(tmp_path / "c"))
    plan = scan.scan_parquet_cutoff(spark, path, datetime(2024, 6, 1)).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(_upload_timestamp" in plan


def test_migration_manifest(spark, tmp_path):
    good = spark.createDataFrame([("1", "2024-02-03"), ("x", None)], "A string, D string")
    jobs = [
        TableJob("good", good, {"A": "NUMBER(5)", "D": "DATE"}, {"A": "a_id", "D": "day"}),
        TableJob("plain", spark.range(4).toDF("n"), {}, {}),
        TableJob("bad", spark.range(2).select(F.raise_error(F.lit("boom")).alias("z")), {}, {}),
    ]
    manifest = str(tmp_path / "manifest")
    failed = run_migration(spark, jobs, str(tmp_path / "lake"), manifest)
    assert [f[0] for f in failed] == ["bad"]
    m = write.read_manifest(spark, manifest)
    assert {r.table_name: r.row_count for r in m.collect()} == {"good": 2, "plain": 4}
    cutoff = write.manifest_cutoff(m, "plain")
    assert scan.scan_parquet_cutoff(spark, str(tmp_path / "lake" / "plain"), cutoff).count() == 4
    back = spark.read.parquet(str(tmp_path / "lake" / "good")).filter("a_id = 1").first()
    assert (back.year, back.month, back.day.day) == (2024, 2, 3)
    s = write.manifest_summary(m).first()
    assert (s.total_tables, s.total_rows) == (2, 6) and s.duration_seconds > 0
    assert write.manifest_cutoff(m.filter("false")) is None


def test_config_files(spark, tmp_path):
    mapping = tmp_path / "map.json"
    mapping.write_text(json.dumps({"m1": {"source2target": {"A": "a", "B": "b"}}, "m2": {"source2target": {}}}, indent=1))
    assert {tuple(r) for r in scan.read_column_mapping(spark, str(mapping)).collect()} == {("m1", "A", "a"), ("m1", "B", "b")}
    dates = tmp_path / "dates.csv"
    dates.write_text("tbl, mismatched date\na, 2024-01-01; 2024-01-02\nb,\n")
    rows = scan.read_mismatch_csv(spark, str(dates)).collect()
    assert [r.tbl for r in rows] == ["a", "b"] and rows[0].mismatched_date == "2024-01-01; 2024-01-02"


def test_jdbc_options():
    plain = scan.jdbc_options("jdbc:x", "SELECT 1")
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    ranged = scan.jdbc_options("jdbc:x", "SELECT * FROM t", "id", (1, 99), 8)
    assert ranged["dbtable"] == "(SELECT * FROM t) t" and "query" not in ranged
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["numPartitions"]) == ("id", "1", "8")


def test_day_predicates():
    got = scan.day_predicates("d", date(2024, 2, 28), date(2024, 3, 1))
    assert len(got) == 3 and got[1] == "d >= DATE '2024-02-29' AND d < DATE '2024-03-01'"


def test_extract_by_day_drops_undated(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 23)), (2, datetime(2024, 1, 2)), (3, None)], "k int, d timestamp_ntz")
    assert [r.k for r in scan.extract_by_day(df, "d", end=date(2024, 1, 1)).collect()] == [1]
    assert scan.extract_by_day(df, "d").count() == 2


def test_scratch_uses_the_configured_folder(spark):
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a.startswith(spark.conf.get("spark.checkpoint.dir")) and a != b
    assert session.checkpointed(spark.range(3)).count() == 3


def test_manifest_time_zone(spark, tmp_path):
    at = datetime(2024, 1, 1, 5, 0, 0, 7, tzinfo=timezone.utc)
    write.write_manifest(spark, [("t", "p", 1, 0.5, at, "2024-01-01", at, at)], str(tmp_path / "m"))
    got = write.read_manifest(spark, str(tmp_path / "m")).select(F.unix_micros("upload_timestamp")).first()[0]
    assert got == int(at.timestamp()) * 1_000_000 + 7


def test_copies_lose_no_digits(spark, tmp_path):
    from reconkit.operators.records import value_differences
    from reconkit.plans.migrate import TableJob, migrate_table

    df = spark.range(50).selectExpr("id AS k", "1000.01 + id / 7.0 AS price", "CAST(id AS double) AS whole")
    path = migrate_table(TableJob("t", df, {}, {}), str(tmp_path), datetime(2024, 1, 1))
    back = spark.read.parquet(path)
    assert {r.column_name: r.different for r in value_differences(df, back, ["k"], ["price", "whole"]).collect()} == {"price": 0, "whole": 0}
    assert dict(back.dtypes)["whole"] == "float"
    more = spark.range(50, 60).selectExpr("id AS k", "2.5 AS price", "CAST(id AS double) AS whole")
    migrate_table(TableJob("t", more, {}, {}), str(tmp_path), datetime(2024, 1, 2), mode="append")
    again = spark.read.parquet(path)
    assert again.count() == 60 and again.dtypes == back.dtypes and again.agg({"price": "min"}).first()[0] == 2.5


def test_facts_from_footers(spark, tmp_path):
    path, before = str(tmp_path / "t"), spark.conf.get("spark.sql.sources.useV1SourceList")
    df = spark.range(1000).selectExpr("id", "DATE'2024-01-01' + CAST(id AS INT) AS d", "CAST(id AS STRING) AS s", "if(id < 3, null, id / 2) AS x")
    df.repartition(4).write.parquet(path)
    facts = scan.file_facts(spark, path, ["id", "d", "x"])
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id)" in plan and spark.conf.get("spark.sql.sources.useV1SourceList") == before
    row = facts.first()
    assert (row.nrow, row.min_id, row.max_id, row.min_d, row.max_x) == (1000, 0, 999, date(2024, 1, 1), 499.5)
    texts = scan.file_facts(spark, path, ["s"])  # no pushed extremes for texts: read, and right
    assert tuple(texts.first()) == (1000, "0", "999")
    df.limit(0).write.parquet(str(tmp_path / "none"))
    assert tuple(scan.file_facts(spark, str(tmp_path / "none"), ["id"]).first()) == (0, None, None)
