"""Timed scaling workloads: fixed data over more partitions, and data growing with partitions."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from gaugeline.operators.reports import scaling_costs
from gaugeline.operators.split import fraction_sample, repartition_group_count, replicate_rows
from gaugeline.operators.stages import materialized
from gaugeline.sources.reports import conform

STRONG_PARTITIONS = (2, 4, 8, 16)
WEAK_STEPS = ((1, 2), (2, 4), (3, 8))
WEAK_BASE_ROWS = 250_000


def _timed(df: DataFrame, partitions: int) -> float:
    started = time.perf_counter()
    repartition_group_count(df, partitions).collect()
    return round(time.perf_counter() - started, 4)


def strong_scaling(df: DataFrame, executors: int = 1) -> DataFrame:
    rows = df.count()
    timings = [("strong_scaling", p, rows, _timed(df, p)) for p in STRONG_PARTITIONS]
    ddl = "experiment STRING, partitions INT, rows BIGINT, duration_seconds DOUBLE"
    return scaling_costs(df.sparkSession.createDataFrame(timings, ddl), executors)


def weak_scaling(df: DataFrame, key: str, executors: int = 1) -> DataFrame:
    timings = []
    with materialized(fraction_sample(df, key, WEAK_BASE_ROWS)) as base:
        rows = base.count()
        for copies, partitions in WEAK_STEPS:
            seconds = _timed(replicate_rows(base, copies), partitions)
            timings.append(("weak_scaling", partitions, copies, rows * copies, seconds))
    ddl = "experiment STRING, partitions INT, multiplier INT, rows BIGINT, duration_seconds DOUBLE"
    return scaling_costs(df.sparkSession.createDataFrame(timings, ddl), executors)


def cost_performance(strong: DataFrame, weak: DataFrame) -> DataFrame:
    return conform(strong, "cost_performance").unionByName(conform(weak, "cost_performance"))
