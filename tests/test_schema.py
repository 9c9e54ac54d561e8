"""Type rules, name matching, schema merge, status and the analysis report."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reconkit.functions.types import cast_by_source_type, type_compatible
from reconkit.operators import matching as M, schema as S
from reconkit.plans import analysis

RULES = [
    ("NUMBER", "double", True), ("NUMBER", "bigint", False), ("NUMBER(10,2)", "decimal(38,2)", True),
    ("NUMBER(10,2)", "decimal(38,3)", False), ("NUMBER(10)", "bigint", False), ("VARCHAR2(50)", "varchar(50)", True),
    ("VARCHAR2(50)", "varchar(60)", False), ("CHAR(1)", "VARCHAR(10)", True), ("CHAR(10)", "VARCHAR(10)", False),
    ("CHAR(10)", "varchar(10)", False), ("CHAR(10)", "char(10)", True), ("DATE", "date", True), ("DATE", "timestamp", True),
    ("DATE", "timestamp(3)", True), ("DATE", "varchar(8)", False), ("TIMESTAMP(6)", "timestamp", True),
    ("TIMESTAMP(6)", "date", False), ("CLOB", "string", False), ("BLOB", "binary", False),
]


def test_type_rules(spark):
    df = spark.createDataFrame(RULES, "s string, t string, want boolean")
    bad = df.withColumn("got", type_compatible(F.col("s"), F.col("t"))).filter("got <> want OR got IS NULL").collect()
    assert bad == []


def test_cast_by_source_type(spark):
    df = spark.createDataFrame([("1", "2.5", "2024-02-29", "true"), ("x", "y", "2023-02-29", "z")], "a string, b string, d string, f string")
    out = cast_by_source_type(df, {"a": "NUMBER(5)", "b": "NUMBER(5,2)", "d": "DATE", "f": "BOOLEAN", "zz": "CLOB"}).collect()
    assert (out[0].a, out[0].b, out[0].d.day, out[0].f) == (1, 2.5, 29, True)
    assert tuple(out[1]) == (None, None, None, None)


def _greedy(a, b):
    """The same choice written as a plain loop."""
    out = {x: x for x in a if x in b}
    used = set(out.values())
    for x in a:
        free = [y for y in b if y not in used and (x.startswith(y) or y.startswith(x))]
        if x not in out and free:
            out[x] = free[0]
            used.add(free[0])
    return out


def test_greedy_match_against_loop(spark):
    rnd = random.Random(4)
    rows_a, rows_b, want = [], [], {}
    for t in range(12):
        names = lambda: list(dict.fromkeys("".join(rnd.choice("ab_") for _ in range(rnd.randint(1, 5))) for _ in range(12)))
        a, b = names(), names()
        rows_a += [(f"t{t}", i, x) for i, x in enumerate(a)]
        rows_b += [(f"t{t}", i, x) for i, x in enumerate(b)]
        want |= {(f"t{t}", x): y for x, y in _greedy(a, b).items()}
    schema = "tbl string, position int, column_name string"
    got = M.greedy_column_match(spark.createDataFrame(rows_a, schema), spark.createDataFrame(rows_b, schema), ["tbl"])
    assert {(r.tbl, r.source_name): r.target_name for r in got.collect()} == want


def test_prefix_join_is_not_a_nested_loop(spark):
    a = spark.createDataFrame([("id",), ("cust",), ("customer_id",)], "a string")
    b = spark.createDataFrame([("customer",), ("id_no",), ("zip",)], "b string")
    joined = M.prefix_match_join(a, b, "a", "b")
    assert {tuple(r) for r in joined.collect()} == {("id", "id_no"), ("cust", "customer"), ("customer_id", "customer")}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_list_difference_drop_patterns(spark):
    a = spark.createDataFrame([("temp_x",), ("audit_y",), ("name",), ("zip",), ("my_temp_",)], "a string")
    b = spark.createDataFrame([("na",)], "b string")
    got = lambda **kw: {r.a for r in M.list_difference(a, b, "a", "b", **kw).collect()}
    assert got(drop=["temp_.*", "audit_.*"]) == {"zip", "my_temp_"}
    assert got(mode="exact") == {"temp_x", "audit_y", "name", "zip", "my_temp_"}
    with pytest.raises(ValueError):
        got(mode="suffix")


SOURCE = "tbl string, position int, column_name string, data_type string, target_name string"
TARGET = "tbl string, position int, column_name string, data_type string"


def test_schema_merge_summary(spark):
    source = spark.createDataFrame(
        [("t", 1, "ID", "NUMBER(10,0)", "id"), ("t", 2, "CUST_NAME", "VARCHAR2(50)", "cust_name"),
         ("t", 3, "AMT$", "NUMBER", None), ("t", 4, "CREATED", "DATE", None), ("u", 1, "A", "DATE", "a")], SOURCE)
    target = spark.createDataFrame(
        [("t", 1, "id", "decimal(10,0)"), ("t", 2, "cust_name", "varchar(40)"), ("t", 3, "created_date", "date"),
         ("t", 4, "extra", "int"), ("u", 1, "a", "timestamp")], TARGET)
    s = {r.tbl: r for r in S.schema_summary(S.schema_merge(source, target)).collect()}
    assert s["t"].source_unique == "AMT$" and s["t"].target_unique == "extra"
    assert s["t"].type_mismatch == "VARCHAR2(50)->varchar(40)" and s["t"].uncaptured == "CREATED->created_date"
    assert (s["u"].source_unique, s["u"].target_unique, s["u"].type_mismatch) == ("", "", "")


def test_thousand_columns(spark):
    source = spark.createDataFrame([("t", i, f"COL_{i}X", "NUMBER", f"col_{i}x") for i in range(1000)], SOURCE)
    target = spark.createDataFrame([("t", i, f"col_{i}x", "double") for i in range(1000)], TARGET)
    assert S.schema_merge(source, target).filter("side = 'both' AND type_match").count() == 1000


@pytest.mark.parametrize(
    "facts,status",
    [
        ((True, True, True, 3, True, True, 3), "success"), ((False, True, False, 0, False, False, 0), "no_source"),
        ((True, False, False, 3, True, True, 3), "no_mapping"), ((True, True, False, 3, False, False, 0), "no_source_date"),
        ((True, True, True, 0, True, True, 3), "empty_source"), ((True, True, True, 3, False, False, 0), "no_target"),
        ((True, True, True, 3, True, False, 3), "no_target_date"), ((False, True, True, 0, True, True, 0), "empty_target"),
    ],
)
def test_pull_status(spark, facts, status):
    got = spark.range(1).select(S.pull_status(*[F.lit(f) for f in facts]).alias("s")).first().s
    assert got == S.STATUS[status]


def test_run_analysis(spark):
    day = lambda n: F.expr(f"TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(CAST(id % {n} AS INT))")
    a = spark.range(100).select("id", day(10).alias("d"))
    b = spark.range(90).select("id", day(10).alias("d"), F.lit(1).alias("etl"))
    shifted = spark.range(100).select("id", day(5).alias("d"))
    pair = analysis.TablePair
    same = {"id": "id", "d": "d"}
    pairs = [
        pair("rows", a, b, "svc.rows", "l.rows", "d", "d", same), pair("dates", a, shifted, "svc.dates", "l.dates", "d", "d", same),
        pair("bare", a, a, "no_server_provided.bare", "l.bare", "d", "d", service="found"), pair("gone", None, b, "svc.gone", "l.gone", "d", "d", {}),
        pair("nodate", a, a, "svc.nodate", "l.nodate", "d", "when", same), pair("rows", a, a, "svc.rows", "l.rows", "d", "d", same),
    ]
    report = analysis.run_analysis(spark, pairs, add_cols=["etl"]).collect()
    got = {r.target_table.split(".")[1]: r for r in report}
    assert len(report) == 5 and len(report[0]) == 17
    assert got["rows"].row_details == "source(100) : target(90)" and got["rows"].target_unique == ""
    assert got["rows"].time_unmatch and len(got["rows"].time_details.split("; ")) == 10
    assert got["dates"].time_unmatch and not got["dates"].row_unmatch
    assert got["bare"].status == S.NO_MAPPING and got["bare"].source_service == "found"
    assert got["gone"].status == S.STATUS["no_source"] and got["gone"].row_details == ""
    assert got["nodate"].status == S.STATUS["no_target_date"] and got["nodate"].col_details == ""
    only = {r.target_table: r.time_unmatch for r in analysis.run_analysis(spark, pairs, "mismatch").collect()}
    assert only["l.rows"] and not only["l.dates"]


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.text("ab", max_size=7) | st.none()), max_size=40),
    st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.text("ab", max_size=7) | st.none()), max_size=40),
    st.integers(1, 9),
)
def test_prefix_sweep_over_many_ranges(spark, left, right, parts):
    a = spark.createDataFrame(left, "g int, a string")
    b = spark.createDataFrame(right, "g int, b string")
    got = [tuple(r) for r in M.prefix_match_join(a, b, "a", "b", ["g"], parts=parts).collect()]
    want = {(g, x, y) for g, x in left for h, y in right if g is not None and g == h and x and y and (x.startswith(y) or y.startswith(x))}
    assert len(got) == len(set(got)) and set(got) == want


def test_prefix_sweep_of_nested_and_long_texts(spark):
    """Every text starts with all shorter ones, across many range limits; none is written out prefix by prefix."""
    texts = [("é" * n,) for n in range(1, 60)] + [("b" * 200_000,), ("b" * 199_999 + "c",), ("b" * 100_000,)]
    a, b = spark.createDataFrame(texts, "a string"), spark.createDataFrame(texts, "b string")
    got = M.prefix_match_join(a, b, "a", "b", parts=12).select(F.length("a"), F.length("b")).collect()
    want = [(i, j) for i in range(1, 60) for j in range(1, 60)] + [(200_000, 200_000)] * 2 + [(100_000, 100_000)]
    want += [(200_000, 100_000)] * 2 + [(100_000, 200_000)] * 2
    assert sorted(tuple(r) for r in got) == sorted(want)
    joined = M.short_prefix_join(a.filter("length(a) < 60"), b.filter("length(b) < 60"), "a", "b")
    assert joined.count() == 59 * 59
