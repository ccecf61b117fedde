"""Time and report arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_COST_USD = 8.0
EXECUTOR_HOUR_USD = 0.25


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970, for zoned and zone-free timestamps alike."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("SECOND", origin, F.col(column))
    return F.unix_seconds(F.col(column).cast("timestamp"))


def throughput(rows: Column, seconds: Column) -> Column:
    return F.round(rows / F.greatest(seconds, F.lit(1e-6)), 2)


def executor_cost(
    seconds: Column, executors: int = 1, usd_per_hour: float = EXECUTOR_HOUR_USD
) -> Column:
    return F.round(seconds / 3600.0 * executors * usd_per_hour, 6)


def alert_count(population: Column, rate: Column) -> Column:
    """Half-even rounding, as a count of alerts; a missing rate counts as none."""
    return F.bround(population * F.coalesce(rate, F.lit(0.0)), 0).cast("bigint")


def review_profit(alerts: Column, cost_per_alert: float = REVIEW_COST_USD) -> Column:
    return F.round(alerts * F.lit(-cost_per_alert), 2)
