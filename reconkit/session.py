"""Session helpers: shared scratch space, reliable checkpoints, sizing."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_session(cores: str = "8", name: str = "reconkit", **config: str) -> SparkSession:
    """A session for tests and the local bench; clusters bring their own.

    Stored copies go to a folder of its own below the system's temporary one, unless
    ``spark.checkpoint.dir`` is given, and are removed with the tables that need them.
    """
    if "spark.checkpoint.dir" not in config:
        config["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="reconkit-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.executorEnv.PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in config.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        # one process: its own temporary folder is shared by all tasks
        root = tempfile.mkdtemp(prefix="reconkit-")
        spark.sparkContext.setCheckpointDir(root)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    return os.path.join(_shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise on shared storage, so the rows survive lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_shared_root(spark))
    return df.checkpoint(eager=True)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table of driver values; its size is known, so joins with it broadcast."""
    types = StructType.fromDDL(schema)
    arrow = to_arrow_schema(types)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=types)


def parallelism(spark: SparkSession, limit: int) -> int:
    """Number of range buckets for order-dependent work, from the shuffle setting."""
    return max(2, min(int(spark.conf.get("spark.sql.shuffle.partitions")), limit))
