"""Full comparison of two tables, validation and run reports."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reconkit.operators.aggregates import describe_stats
from reconkit.operators.hypothesis import distribution_tests
from reconkit.operators.ordering import sample_n
from reconkit.operators.records import (
    TOLERANCE,
    apart,
    both_sides,
    difference_sample,
    is_fractional,
    match_and_differences,
    match_records,
    match_summary,
)
from reconkit.operators.schema import dtype_diff, schema_as_table, schema_diff
from reconkit.operators.shaping import normalize_columns, numeric_columns
from reconkit.session import checkpointed, local_rows

# Significance level and validation tolerances.
ALPHA = 0.05
AT_ONCE = 4  # comparisons
VALIDATION_ATOL, VALIDATION_RTOL = 1e-6, 1e-5
SUMMARY = (
    "table_name string, source_count bigint, target_count bigint, count_difference bigint, "
    "source_only bigint, target_only bigint, common_keys bigint, match_rate double, sampled_keys bigint, "
    "different_values bigint, min_ks_p double, schema_differs boolean, match_status string, "
    "execution_time double"
)


def match_status(
    schema_differs: Column, one_sided: Column, different_values: Column, min_ks_p: Column
) -> Column:
    """Most serious finding first."""
    return (
        F.when(schema_differs, "SCHEMA_MISMATCH")
        .when(one_sided > 0, "RECORD_COUNT_MISMATCH")
        .when(different_values > 0, "VALUE_DIFFERENCES")
        .when(min_ks_p < ALPHA, "STATISTICAL_DIFFERENCES")
        .otherwise("MATCH")
    )


def stat_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Absolute mean and deviation differences of common numeric columns."""
    common = [c for c in numeric_columns(source) if c in numeric_columns(target)]
    a, b = describe_stats(source, common), describe_stats(target, common)
    a = a.select("variable", *[F.col(c).alias(f"source_{c}") for c in a.columns[1:]])
    b = b.select("variable", *[F.col(c).alias(f"target_{c}") for c in b.columns[1:]])
    return a.join(b, "variable").withColumns(
        {
            "mean_diff": F.abs(F.col("target_mean") - F.col("source_mean")),
            "std_diff": F.abs(F.col("target_std") - F.col("source_std")),
        }
    )


@dataclass
class Comparison:
    summary: DataFrame  # one row
    schema: DataFrame
    types: DataFrame
    statistics: DataFrame | None = None
    tests: DataFrame | None = None
    values: DataFrame | None = None
    sample: DataFrame | None = None


def _summary_row(spark: SparkSession, values: dict, started: float) -> DataFrame:
    fields = [f.split(" ")[0] for f in SUMMARY.split(", ")]
    values = {**values, "execution_time": time.time() - started}
    return local_rows(spark, [tuple(values.get(f) for f in fields)], SUMMARY)


def _sampled(source: DataFrame, target: DataFrame, keys: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Both tables cut to the same n keys, in seeded hash order."""
    every = checkpointed(source.select(*keys).union(target.select(*keys)).distinct())
    chosen = sample_n(every, n, 0, keys).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = lambda df: reduce(lambda a, b: a & b, [df[k].eqNullSafe(chosen[f"_k_{k}"]) for k in keys])
    return source.join(chosen, on(source), "left_semi"), target.join(chosen, on(target), "left_semi")


def compare_tables(
    source: DataFrame,
    target: DataFrame,
    table_name: str,
    key_columns: Sequence[str] | None = None,
    compare_columns: Sequence[str] | None = None,
    sample_size: int | None = None,
) -> Comparison:
    """Schema, types, statistics, distribution tests, records and values of two tables.

    Without a common column only the schema is compared.  ``sample_size`` limits
    the comparison to that many keys; ``sampled_keys`` is then set, and the row counts
    stay those of the whole tables.
    """
    started = time.time()
    spark = source.sparkSession
    source, target = normalize_columns(source), normalize_columns(target)
    keys = [k.lower() for k in key_columns or []]
    schema_a, schema_b = schema_as_table(source, table_name), schema_as_table(target, table_name)
    out = Comparison(None, schema_diff(schema_a, schema_b), dtype_diff(schema_a, schema_b))
    schema_differs = set(source.columns) != set(target.columns)
    common = [c for c in source.columns if c in target.columns]
    facts = {"table_name": table_name, "schema_differs": schema_differs}

    sampled = bool(keys and sample_size)
    if sampled or not keys:
        facts |= {"source_count": source.count(), "target_count": target.count()}
    if sampled:
        source, target = _sampled(source, target, keys, sample_size)
    columns = [c.lower() for c in compare_columns or [] if c.lower() in common]
    columns = columns or [c for c in common if c not in keys]
    if keys:
        if columns:
            # one grouping by key serves the counts and the values
            counts, out.values = match_and_differences(source, target, keys, columns)
        else:
            counts = match_summary(match_records(source, target, keys)).first()
        facts |= {k: counts[k] for k in ("source_only", "target_only", "common_keys", "match_rate")}
        if sampled:
            facts["sampled_keys"] = sum(counts[k] for k in ("source_only", "target_only", "common_keys"))
        else:
            facts |= {"source_count": counts["source_rows"], "target_count": counts["target_rows"]}
    facts["count_difference"] = abs(facts["source_count"] - facts["target_count"])

    if common:
        numbers = [c for c in numeric_columns(source) if c in numeric_columns(target) and c not in keys]
        if numbers:
            out.statistics = stat_differences(source.select(*numbers), target.select(*numbers))
            out.tests = distribution_tests(source, target, numbers)
            tests = out.tests.agg(F.min("ks_p")).first()
            facts["min_ks_p"] = tests[0]
        if out.values is not None:
            out.sample = difference_sample(source, target, keys, columns)
            facts["different_values"] = out.values.agg(F.sum("different")).first()[0]

    summary = _summary_row(spark, facts, started)
    one_sided = F.coalesce(F.col("source_only") + F.col("target_only"), F.lit(0))
    status = match_status(F.col("schema_differs"), one_sided, F.col("different_values"), F.col("min_ks_p"))
    out.summary = summary.withColumn("match_status", status)
    return out


def compare_many(pairs: Sequence[tuple[str, Callable[[], Comparison]]], spark: SparkSession, at_once: int = AT_ONCE) -> DataFrame:
    """Summaries of several comparisons in the order given; a failing one becomes an ERROR row.

    A comparison is a chain of jobs, some with fewer tasks than there are cores, so
    ``at_once`` of them share the cluster; their execution times overlap.
    """

    def summary(name: str, run: Callable[[], Comparison]) -> DataFrame:
        started = time.time()
        try:
            return run().summary
        except Exception as e:  # noqa: BLE001 - the report must show every failure
            return _summary_row(spark, {"table_name": name, "match_status": f"ERROR: {type(e).__name__}: {e}"}, started)

    with ThreadPoolExecutor(at_once) as pool:
        rows = [pool.submit(inheritable_thread_target(spark)(summary), name, run) for name, run in pairs]
        return reduce(DataFrame.unionByName, [r.result() for r in rows])


def run_report(summaries: DataFrame) -> DataFrame:
    """Totals over comparison summaries."""
    status = F.col("match_status")
    return summaries.agg(
        F.count(F.lit(1)).alias("total_comparisons"),
        F.count_if(status == "MATCH").alias("matches"),
        F.count_if(status != "MATCH").alias("differences"),
        F.count_if(F.contains(status, F.lit("ERROR"))).alias("errors"),
        F.sum("execution_time").alias("total_execution_time"),
    )


def status_distribution(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy("match_status").agg(F.count(F.lit(1)).alias("n"))


def validate_frames(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], test_name: str,
    atol: float = VALIDATION_ATOL, rtol: float = VALIDATION_RTOL,
) -> tuple[DataFrame, DataFrame]:
    """(verdict, cells): shape, column order, then values by key.

    ``cells`` lists differing values as (keys..., column_name, expected, actual);
    a key missing on a side, or repeated there, differs as a whole.
    """
    spark = expected.sparkSession
    same_columns = expected.columns == actual.columns
    columns = [c for c in expected.columns if c in actual.columns and c not in keys]
    rows = both_sides(expected, actual, [*keys, *columns])
    e, a = F.col("_s") > 0, F.col("_t") > 0
    per_key = rows.groupBy(*keys).agg(
        F.sum("_s").alias("e_rows"),
        F.sum("_t").alias("a_rows"),
        *[F.max(F.when(e, F.col(c))).alias(f"e_{c}") for c in columns],
        *[F.max(F.when(a, F.col(c))).alias(f"a_{c}") for c in columns],
    )
    kinds = {f.name: is_fractional(f.dataType) for f in rows.schema}

    def bad(c):
        x, y = F.col(f"e_{c}"), F.col(f"a_{c}")
        if not kinds[c]:
            return ~x.eqNullSafe(y)
        x, y = x.cast("double"), y.cast("double")
        return apart(x, y, F.lit(atol) + F.lit(rtol) * F.abs(x))

    cell = lambda name, x, y, flag: F.struct(
        F.lit(name).alias("column_name"), x.cast("string").alias("expected"), y.cast("string").alias("actual"), flag.alias("_bad")
    )
    paired = (F.col("e_rows") == 1) & (F.col("a_rows") == 1)
    cells = [cell("(row)", F.col("e_rows"), F.col("a_rows"), ~paired)]
    cells += [cell(c, F.col(f"e_{c}"), F.col(f"a_{c}"), paired & bad(c)) for c in columns]
    found = per_key.select(*keys, F.inline(F.array(*cells))).filter("_bad").drop("_bad")
    verdict = found.agg(F.count(F.lit(1)).alias("differences")).select(
        F.lit(test_name).alias("test_name"),
        F.lit(same_columns).alias("columns_match"),
        "differences",
        (F.lit(same_columns) & (F.col("differences") == 0)).alias("passed"),
    )
    return verdict, found


def validate_numeric(cases: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Add ``passed`` and ``difference`` to (test_name, expected, actual) rows."""
    gap = F.abs(F.col("expected") - F.col("actual"))
    return cases.withColumns({"difference": gap, "passed": F.coalesce(gap <= tolerance, F.lit(False))})


def failed_tests(results: DataFrame) -> DataFrame:
    """The failed tests, one row each."""
    return results.filter(~F.col("passed"))


def validation_summary(results: DataFrame) -> DataFrame:
    """Numbers of tests; ``failed_tests`` lists the failed ones."""
    total, passed = F.count(F.lit(1)), F.count_if("passed")
    return results.agg(
        total.alias("total_tests"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.coalesce(F.try_divide(passed * 1.0, total), F.lit(0.0)).cast("double").alias("pass_rate"),
    )
