"""Copies in batches that can be repeated and resumed: stage first, commit last.

A batch is written to a folder of its own attempt; one row in ``commits`` then makes it
visible.  Readers take, for each batch id, the attempt that was committed last, so a job that
dies leaves nothing to be seen, a repeated batch replaces itself, and no file is ever
moved or rewritten.  Spark's own output commit makes the commit row appear at once.

    table/data/batch_id=<batch>/attempt=<name>/...     rows, partitioned as asked for
    table/commits/...                                  one JSON row a commit
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from reconkit.session import local_rows
from reconkit.sources.write import MANIFEST_TIME, sanitize_columns, size_estimate, write_partitioned_parquet

COMMIT = (
    "batch_id string, attempt string, row_count bigint, size_mb double, schema_json string, "
    "started timestamp, committed timestamp"
)


def _folder(path: str, batch_id: str, attempt: str) -> str:
    return os.path.join(path, "data", f"batch_id={batch_id}", f"attempt={attempt}")


def stage_batch(df: DataFrame, path: str, batch_id: str, partition_by: Sequence[str] = (), **options) -> dict:
    """Write one attempt of a batch; nobody sees it before ``commit_batch``."""
    if not re.fullmatch(r"[0-9A-Za-z][0-9A-Za-z._-]*", batch_id):
        raise ValueError(f"batch id {batch_id!r} may hold letters, digits, '.', '_' and '-' only")
    staged = {"path": path, "batch_id": batch_id, "attempt": uuid.uuid4().hex, "started": datetime.now(timezone.utc)}
    staged["schema"] = sanitize_columns(df).schema
    write_partitioned_parquet(df, _folder(path, batch_id, staged["attempt"]), partition_by, **options)
    return staged


def commit_batch(spark: SparkSession, staged: dict) -> None:
    """Make a staged attempt the one that readers see; counts come from the files."""
    folder = _folder(staged["path"], staged["batch_id"], staged["attempt"])
    written = spark.read.schema(staged["schema"]).parquet(folder)  # a batch may be empty
    size = size_estimate(spark, folder).first()["size_mb"]
    row = (
        staged["batch_id"], staged["attempt"], written.count(), size, written.schema.json(),
        staged["started"], datetime.now(timezone.utc),
    )
    commits = local_rows(spark, [row], COMMIT).coalesce(1)
    commits.write.mode("append").option("timestampFormat", MANIFEST_TIME).json(os.path.join(staged["path"], "commits"))


def write_batch(df: DataFrame, path: str, batch_id: str, partition_by: Sequence[str] = (), **options) -> None:
    commit_batch(df.sparkSession, stage_batch(df, path, batch_id, partition_by, **options))


def all_commits(spark: SparkSession, path: str) -> DataFrame:
    """Every commit ever made; no rows if there is none."""
    try:
        return spark.read.schema(COMMIT).option("timestampFormat", MANIFEST_TIME).json(os.path.join(path, "commits"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """The attempt in force for each batch id: the last commit, ties to the larger attempt name."""
    last = F.max_by(F.struct("*"), F.struct("committed", "attempt"))
    return all_commits(spark, path).groupBy("batch_id").agg(last.alias("c")).select("c.*")


def read_committed(spark: SparkSession, path: str, batches: Iterable[str] | None = None) -> DataFrame:
    """Rows of the committed batches (or of those named), with their ``batch_id``.

    Batches may differ in columns: missing ones are null.  The list of batches, one row a
    batch, is read on the driver as any list of files is.
    """
    wanted = None if batches is None else set(batches)
    rows = [r for r in committed_batches(spark, path).orderBy("batch_id").collect() if wanted is None or r["batch_id"] in wanted]
    if wanted is not None and wanted - {r["batch_id"] for r in rows}:
        raise ValueError(f"not committed: {sorted(wanted - {r['batch_id'] for r in rows})}")
    if not rows:
        return spark.createDataFrame([], "batch_id string")
    groups: dict[str, list[str]] = {}
    for r in rows:
        groups.setdefault(r["schema_json"], []).append(_folder(path, r["batch_id"], r["attempt"]))
    out = None
    for schema, folders in groups.items():
        # one read for all batches of one schema; the folder names tell the batch, so filters on it prune
        fields = StructType([*StructType.fromJson(json.loads(schema)).fields, *StructType.fromDDL("batch_id string, attempt string").fields])
        one = spark.read.schema(fields).option("basePath", os.path.join(path, "data")).parquet(*folders).drop("attempt")
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def uncommitted(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, attempt, files, size_mb`` of attempts that no reader uses: failed or replaced ones."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    found = files.load(os.path.join(path, "data")).select(
        F.regexp_extract("path", r"/batch_id=([^/]+)/", 1).alias("batch_id"), F.regexp_extract("path", r"/attempt=([^/]+)/", 1).alias("attempt"), "length"
    )
    sizes = found.groupBy("batch_id", "attempt").agg(F.count(F.lit(1)).alias("files"), (F.sum("length") / (1024.0 * 1024.0)).alias("size_mb"))
    return sizes.join(committed_batches(spark, path), ["batch_id", "attempt"], "left_anti")


def copy_batches(
    spark: SparkSession, path: str, batches: Sequence[str], rows_of: Callable[[str], DataFrame], partition_by: Sequence[str] = (), redo: bool = False, **options
) -> list[str]:
    """Copy each batch that is not committed yet (all with ``redo``); returns those copied now.

    Run again after a failure, it goes on where it stopped.
    """
    done = set() if redo else {r["batch_id"] for r in committed_batches(spark, path).select("batch_id").collect()}
    left = [b for b in batches if b not in done]
    for b in left:
        write_batch(rows_of(b), path, b, partition_by, **options)
    return left
