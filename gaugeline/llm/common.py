"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.sources.workspace import broadcast_if_small, stage_table

Query = Callable[[SparkSession, str], DataFrame]
#: A row's place within its task, below the task's number, in Spark's increasing ids.
PLACE_BITS = 33
#: What the contracts call white space; everything else is part of a word.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """Adds every row's place from 0 in the global order.

    Rows are range-partitioned and sorted by task, and the staged table holds each row's task and
    place in it; only the number of rows per task (as many numbers as tasks) reaches the driver.
    No window runs over a whole group.  Rows equal in every order column get places in any order.
    """
    spark = df.sparkSession
    placed = (
        df.repartitionByRange(partitions_of(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    held = stage_table(placed, "ranked")
    task = F.shiftright("_place", PLACE_BITS)
    counts = sorted((r["task"], r["rows"]) for r in held.groupBy(task.alias("task")).agg(F.count("*").alias("rows")).collect())
    before, offsets = 0, []
    for number, rows in counts:
        offsets.append((number, before))
        before += rows
    starts = spark.createDataFrame(offsets, "_task long, _before long")
    return (
        held.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .withColumn(rank, F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
        .drop("_task", "_place", "_before")
    )


def rank_within(df: DataFrame, group: str, order: list[Column], rank: str = "rank") -> DataFrame:
    """As ``ranked``, but places count from 0 within each group; groups must be few."""
    placed = ranked(df, [F.col(group), *order], "_global")
    first = placed.groupBy(group).agg(F.min("_global").alias("_first"))
    return placed.join(broadcast_if_small(first), group).withColumn(rank, F.col("_global") - F.col("_first")).drop("_global", "_first")
