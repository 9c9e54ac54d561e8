"""Named datasets, data-step verbs and scalar formats."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reconkit.functions import bins, dates, formats, missing, text
from reconkit.operators import joins as J, reshape as X, shaping as sh
from reconkit.operators.sets import Datasets, union_all, union_distinct


@pytest.fixture(scope="module")
def data(spark):
    d = Datasets(spark)
    d.add("emp", spark.createDataFrame(
        [(1, "IT", 75000, 28), (2, "IT", 82000, 35), (3, "HR", 55000, 29), (4, "HR", 61000, 44), (5, "IT", 70000, 51), (6, "Ops", 48000, 33)],
        "id int, department string, salary int, age int"))
    d.add("dept", spark.createDataFrame([("IT", 1), ("HR", 2), ("Ops", 3), ("Legal", 4)], "department string, budget int"))
    return d


@pytest.mark.parametrize("where,n", [("salary > 60000", 4), ("department = 'IT'", 3), ("age < 30", 2), ("salary >= 70000", 3), ("department == 'IT' AND age > 30", 2)])
def test_where_counts(data, where, n):
    assert data.select("emp", where=where).count() == n


def test_select_errors_and_limits(data):
    assert data.select("emp", ["id"], limit=0).count() == 6
    assert data.select("emp", ["id", "salary"], order_by="salary DESC", limit=2).collect()[0].id == 2
    assert data.select("emp", limit=0).count() == 6
    for bad in (lambda: data.select("none"), lambda: data.select("emp", ["nope"]), lambda: data.select("emp", where="no_col > 1"),
                lambda: data.select("emp", order_by="nope DESC"), lambda: union_all([])):
        with pytest.raises(ValueError):
            bad()


def test_joins_and_unions(data):
    emp, dept = data.get("emp"), data.get("dept")
    counts = {how: J.sql_join(emp, dept, how, on="department").count() for how in ("inner", "left", "right", "outer")}
    assert counts == {"inner": 6, "left": 6, "right": 7, "outer": 7}
    with pytest.raises(ValueError):
        J.sql_join(emp, dept)
    part = emp.filter("id <= 2").withColumn("age", F.col("age") + 1)
    assert (union_distinct([emp, emp.limit(6), part]).count(), union_all([emp, emp]).count()) == (8, 12)


def test_catalog(data, spark):
    data.create_table("rich", "SELECT * FROM emp WHERE salary > 60000")
    assert "rich" in data.names() and data.get("rich").count() == 4
    assert data.drop("rich")
    with pytest.warns(UserWarning):
        assert not data.drop("rich")


def test_data_step_keeps_rows_and_order_of_steps(data):
    out = sh.select_keep_drop(data.get("emp"), keep=["id", "twice", "x"], drop=["age"], compute={"half": "salary / 2", "twice": "half * 4"})
    assert out.columns == ["id", "twice"] and out.count() == 6


def test_null_keys_match(spark):
    a, b = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int"), spark.createDataFrame([(None, 3), (4, 4)], "k int, y int")
    assert J.merge(a, b, ["k"]).collect()[0][:] == (None, 1, 3)
    assert {r._merge for r in J.outer_with_provenance(a, b, ["k"]).collect()} == {"both", "left_only", "right_only"}


def test_transpose(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), ("b", "y", 5.0)], "k string, i string, v double")
    wide = {r.k: (r.Px, r.Py) for r in X.transpose_wide(df, ["k"], "i", "v", prefix="P").collect()}
    assert wide == {"a": (2.0, 0.0), "b": (0.0, 5.0)}
    assert X.transpose_long(df, ["k"]).columns == ["k", "_NAME_", "_VALUE_"]


def _one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_formats(spark):
    none = F.lit(None).cast("double")
    d = F.lit(dt.date(2024, 1, 15))
    got = _one(
        spark, formats.format_numeric(F.lit(1234.567), 2), formats.format_numeric(F.lit(-7.9)), formats.format_numeric(none, 2),
        formats.format_numeric(F.lit(float("nan"))), formats.format_char(F.lit("abcdef"), 4), formats.format_char(F.lit("ab"), 4),
        formats.format_date(d), formats.informat_numeric(F.lit("$1,234.50")), formats.informat_numeric(F.lit(" . ")),
        formats.informat_numeric(F.lit("")), formats.informat_numeric(F.lit("x1")), formats.informat_char(F.lit("  abc"), 2),
        dates.date_text(formats.informat_date(F.lit("15JAN2024"))), formats.informat_date(F.lit("30FEB2024")),
    )
    assert got == ("1234.57", "-7", ".", ".", "abcd", "ab  ", "15JAN2024", 1234.5, None, None, None, "ab", "2024-01-15", None)


def test_dates(spark):
    ts = F.lit("2024-03-15 14:30:00").cast("timestamp_ntz")
    got = _one(
        spark, dates.days_since_epoch(F.lit(dt.date(1960, 1, 2))), dates.seconds_since_epoch(F.lit("1960-01-01 00:01:00").cast("timestamp_ntz")),
        dates.time_from_seconds(F.lit(-1)), dates.date_text(dates.date_from_days(F.lit(-1))), dates.iso_text(ts),
        F.date_format(dates.in_zone(ts, "America/New_York"), "HH:mm"), dates.is_weekend(F.lit(dt.date(2024, 3, 16))),
        dates.is_valid_date(F.lit(2023), F.lit(2), F.lit(29)), dates.is_valid_date(F.lit(2024), F.lit(2), F.lit(29)),
        dates.is_valid_time(F.lit(25), F.lit(0), F.lit(0)), dates.is_valid_zone(F.lit("+12:00")), dates.is_valid_zone(F.lit("Europe/Paris")),
        dates.is_valid_zone(F.lit("Not a zone")), dates.whole_days_between(ts, ts + F.expr("INTERVAL 47 HOUR")),
    )
    assert got == (1, 60.0, "23:59:59", "1959-12-31", "2024-03-15T14:30:00Z", "10:30", True, False, True, False, True, True, False, 1)


def test_missing_and_lists(spark):
    nan = F.lit(float("nan"))
    got = _one(
        spark, missing.coalesce_text(F.lit(""), F.lit(None).cast("string"), F.lit("z")), missing.coalesce_numeric(nan, F.lit(2.0)),
        text.remove_from_list(F.lit("a; temp; b"), ["temp"]), text.split_trim_list(F.lit(None).cast("string")),
        text.identifier_table(F.lit("svc.schema.t")), text.identifier_table(F.lit("t")), text.is_prefix_either(F.lit("id"), F.lit("customer_id")),
    )
    assert got == ("z", 2.0, "a; b", [], "schema.t", None, False)
    df = missing.nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert df.filter("x IS NULL").count() == 1


def test_array_bounds(spark):
    group = bins.ColumnArray(["a", "b"])
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert df.select(group.get(2)).first()[0] == 2
    with pytest.raises(IndexError):
        group.set(df, 3, F.lit(1))
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        df.select(group.get(3)).collect()


def test_zones(spark):
    zones = {"+18:00": True, "+18:59": False, "-03:30": True, "+25:00": False, "Mars/Phobos": False, "Europe/Paris": True, "UTC": True}
    rows = spark.createDataFrame([(z,) for z in zones], "z string").select("z", dates.is_valid_zone(F.col("z")).alias("ok")).collect()
    assert {r["z"]: r["ok"] for r in rows} == zones
