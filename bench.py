"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reconkit import queries as registry  # noqa: E402
from reconkit.session import local_session  # noqa: E402

HEADLINE = [
    "match_summary", "match_rate", "value_differences", "value_differences_duplicate_keys", "difference_sample",
    "compare_tables", "proc_freq_oneway", "crosstab_margins", "mismatch_matrix", "temporal_differences",
    "schema_merge", "metadata_diff", "run_analysis", "column_profile", "profile_compare", "proc_means",
    "proc_univariate", "ks_two_sample", "mann_whitney", "column_multiset_compare", "sort_nodupkey",
    "rolling_mean", "expanding_sum", "interpolate_linear", "rank_min", "proc_reg", "transpose_wide",
    "write_partitioned_parquet",
]


def shapes(spark) -> dict:
    """Shapes with published bounds: a year of 20 tables, 1000 x 1000 columns, 50 table pairs."""
    from reconkit.operators import schema, temporal
    from reconkit.plans.analysis import TablePair, run_analysis

    tables = spark.range(20).selectExpr(
        "concat('t', id) AS tbl",
        "array_join(transform(sequence(0, 7), i -> CAST(date_add(DATE'2024-01-01', CAST(i * 17 + id AS INT)) AS string)), '; ') AS mismatched_date",
    )
    counts = spark.range(20 * 365 * 2).selectExpr(
        "concat('t', id % 20) AS tbl", "IF(id % 40 < 20, 'source', 'target') AS side",
        "CAST(date_add(DATE'2024-01-01', CAST(id DIV 40 AS INT)) AS string) AS date", "IF(id % 40 < 20, 5, 5 + id % 3) AS n",
    )
    left = spark.range(1000).selectExpr("'t' AS tbl", "CAST(id AS INT) AS position", "concat('COL_', id, 'X') AS column_name", "'NUMBER' AS data_type", "concat('col_', id, 'x') AS target_name")
    right = spark.range(1000).selectExpr("'t' AS tbl", "CAST(id AS INT) AS position", "concat('col_', id, 'x') AS column_name", "'double' AS data_type")
    rows = lambda n: spark.range(n).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 60 AS INT)) AS d")
    names = {"id": "id", "d": "d"}
    pairs = [TablePair(f"t{i}", rows(1000 + i), rows(1000), f"s.t{i}", f"l.t{i}", "d", "d", names) for i in range(50)]
    runs = {
        "matrix_20x365": lambda: temporal.mismatch_matrix(tables, counts),
        "merge_1000x1000": lambda: schema.schema_merge(left, right),
        "analysis_50": lambda: run_analysis(spark, pairs),
    }
    out = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm-up
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    bounds = {} if sys.argv[1:] else shapes(spark)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "shapes": bounds,
    }))


if __name__ == "__main__":
    main()
