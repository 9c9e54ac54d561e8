"""Mismatch matrix cells and list handling."""

import pytest

from reconkit.operators import temporal as D

COUNTS = "tbl string, side string, date string, n string"


@pytest.fixture(scope="module")
def counts(spark):
    rows = [
        ("a", "source", "2025-02-02", "14"), ("a", "target", "2025-02-02", "32"), ("a", "source", "2025/04/04", "30"),
        ("a", "target", "2025-04-04", "50"), ("a", "source", "2025-04-01", "9"), ("a", "target", "2025-04-01", "9"),
        ("b", "source", "2025-02-02", "5"), ("dash-é", "source", "2100-12-31", "1000000001"),
        ("dash-é", "target", "2100-12-31", "1000000000"), ("c", "source", "1900-01-01", "10"), ("c", "target", "2025-02-02", "0"),
    ]
    return spark.createDataFrame(rows, COUNTS)


def test_matrix_cells(spark, counts):
    tables = spark.createDataFrame(
        [("a", " 2025-02-02;2025-04-04 ; ;2025-04-01"), ("b", "2025-02-02"), ("absent", "2025-02-30; not a date"),
         ("dash-é", "2100-12-31"), ("blank", None), ("c", "1900-01-01; 2000-02-29")], "tbl string, mismatched_date string")
    out = D.mismatch_matrix(tables, counts)
    assert out.columns == ["tbl", "1900-01-01", "2000-02-29", "2025-02-02", "2025-04-01", "2025-04-04", "2100-12-31"]
    got = {r.tbl: r.asDict() for r in out.collect()}
    assert len(got) == 6
    assert got["a"]["2025-02-02"] == "Yes (14 : 32)" and got["a"]["2025-04-04"] == "Yes (30 : 50)"
    assert got["a"]["2025-04-01"] == "No" and set(got["b"].values()) == {"b", "No"}
    assert got["dash-é"]["2100-12-31"] == "Yes (1000000001 : 1000000000)"
    assert got["c"]["1900-01-01"] == "Yes (10 : 0)" and set(got["absent"].values()) == {"absent", "No"}


def test_year_of_twenty_tables(spark):
    tables = spark.range(20).selectExpr(
        "concat('t', id) AS tbl",
        "array_join(transform(sequence(0, 7), i -> CAST(date_add(DATE'2024-01-01', CAST(i * 17 + id AS INT)) AS string)), '; ') AS mismatched_date")
    counts = spark.range(20 * 365 * 2).selectExpr(
        "concat('t', id % 20) AS tbl", "IF(id % 40 < 20, 'source', 'target') AS side",
        "CAST(date_add(DATE'2024-01-01', CAST(id DIV 40 AS INT)) AS string) AS date", "IF(id % 40 < 20, 5, 5 + id % 3) AS n")
    out = D.mismatch_matrix(tables, counts).collect()
    cells = [c for r in out for c in r[1:]]
    assert len(out) == 20 and set(cells) <= {"No", "Yes (5 : 6)", "Yes (5 : 7)"} and len(set(cells)) == 3


def test_temporal_summary(spark):
    a = spark.createDataFrame([("2024-01-02", 5), ("2024-01-01", 3), (None, 2)], "date string, n_rows bigint")
    b = spark.createDataFrame([("2024-01-02", 5), ("2023-12-31", 3), (None, 2)], "date string, n_rows bigint")
    s = D.temporal_summary(D.temporal_differences(a, b)).first()
    assert (s.n_dates, s.mismatched_date) == (2, "2023-12-31; 2024-01-01")
