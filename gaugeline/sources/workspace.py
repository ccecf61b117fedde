"""Where intermediate tables go, and what may be broadcast."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 20_000


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (a test) gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="gaugeline-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    context.setCheckpointDir(root)
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, purpose: str, paths: list[str] | None = None) -> DataFrame:
    """Write a stage to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read rather than a recompute,
    and later column-pruned readers touch only what they need.  The path is added to ``paths``,
    for ``release_tables``.
    """
    path = new_path(df.sparkSession, purpose)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_tables(spark: SparkSession, paths: list[str]) -> None:
    """Empty the folders of staged tables that nothing reads any more.

    Overwriting works on every store that Spark can write; a folder with an empty file is left.
    """
    for path in paths:
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that the table has at most ``max_rows`` rows.

    A larger table comes back as it is; Spark then shuffles the join and AQE splits skewed keys.
    """
    counted = df.limit(max_rows + 1).count()
    return F.broadcast(df) if counted <= max_rows else df


def pin_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """As ``broadcast_if_small``, but computes a small aggregate once and keeps its rows."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables and files below a plan (the plan's own estimate multiplies at joins)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Spread a small scan over all cores before Python-heavy work.

    Compares the bytes to scan with what gives one full input split per core.  Anything
    larger already has enough splits and is returned unchanged.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split_bytes = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(cores) if scanned_bytes(df) < split_bytes * cores else df
