"""Report tables and the aggregate queries dashboards put on them."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import numeric
from gaugeline.operators.anomaly import anomaly_flag
from gaugeline.sources.workspace import pin_if_small, spread_if_narrow, stage_table

# Texts of the business tables, and the rate from which staffing is advised.
STAFFING_RATE = 0.05
MORE_STAFF = "Increase alert review staffing"
SAME_CADENCE = "Maintain current monitoring cadence"
CALIBRATE = "Review sensors with high variability for drift and calibration"
ASSUMPTION = "Each anomaly alert review costs $8.00"


# -- distributions ------------------------------------------------------------------------------


def class_distribution(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("class").agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), "class")
    )


def split_summary(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("split", "class").agg(F.count(F.lit(1)).alias("row_count")).orderBy("split", "class")
    )


def mode_risk_distribution(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(
            F.col("operating_mode").alias("app_family"), F.col("mode_risk").alias("family_risk"), "class"
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "app_family", "class")
    )


# -- sensor variability -------------------------------------------------------------------------


def sensor_stddev(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, std)``: sample deviations from one aggregate; 0 where undefined."""
    wide = df.agg(
        *[F.coalesce(F.stddev_samp(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in features]
    )
    return wide.unpivot([], list(features), "feature", "std")


def high_variability_count(deviations: DataFrame) -> DataFrame:
    """How many features deviate more than the median feature does (one row per feature here)."""
    spread = deviations.agg(F.collect_list("std").alias("_all"), F.percentile("std", 0.5).alias("_median"))
    above = F.filter("_all", lambda s: s > F.col("_median"))
    return spread.select(F.size(above).cast("bigint").alias("high_variability_sensors"))


# -- business tables ----------------------------------------------------------------------------


def mean_test_rate(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("split") == "test").agg(F.avg("anomaly_rate").alias("mean_test_rate"))


def business_insights(summary: DataFrame, deviations: DataFrame) -> DataFrame:
    rate = F.col("mean_test_rate")
    advice = F.when(rate >= STAFFING_RATE, MORE_STAFF).otherwise(SAME_CADENCE)
    anomaly = mean_test_rate(summary).select(
        F.lit("estimated_anomaly_rate").alias("insight"),
        F.round(rate, 6).alias("value"),
        advice.alias("recommendation"),
    )
    variability = high_variability_count(deviations).select(
        F.lit("high_variability_sensor_count").alias("insight"),
        F.col("high_variability_sensors").cast("double").alias("value"),
        F.lit(CALIBRATE).alias("recommendation"),
    )
    return anomaly.unionByName(variability)


def business_alignment(summary: DataFrame) -> DataFrame:
    """Alert review cost per algorithm on the test split; ``rows`` is the split's population."""
    alerts = numeric.alert_count(F.col("rows"), F.col("anomaly_rate"))
    return summary.filter(F.col("split") == "test").select(
        "algorithm",
        "split",
        *[F.lit(None).cast("bigint").alias(c) for c in ("tp", "fp", "fn")],
        numeric.review_profit(alerts).alias("expected_profit_usd"),
        F.lit(ASSUMPTION).alias("assumption"),
    )


def scaling_costs(
    timings: DataFrame, executors: int = 1, usd_per_hour: float = numeric.EXECUTOR_HOUR_USD
) -> DataFrame:
    """Adds throughput and cost to ``(…, rows, duration_seconds)``."""
    seconds = F.col("duration_seconds")
    return timings.withColumns(
        {
            "throughput_rows_per_sec": numeric.throughput(F.col("rows"), seconds),
            "estimated_cost_usd": numeric.executor_cost(seconds, executors, usd_per_hour),
        }
    )


# -- dashboard queries --------------------------------------------------------------------------


def measure_by(df: DataFrame, dimensions: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Aggregated measures by one or two dimensions."""
    return df.groupBy(*dimensions).agg(*[m.alias(name) for name, m in measures.items()])


def kpi_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Totals without a dimension; a column of nulls stays null."""
    return df.agg(*[F.sum(c).alias(c) for c in columns])


def filtered_measure(
    df: DataFrame, condition: Column, dimensions: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    return measure_by(df.filter(condition), dimensions, measures)


def metric_selector(
    df: DataFrame, choice: str, dimension: str = "algorithm",
    metrics: Sequence[str] = ("anomaly_rate", "score_p95", "score_p99"),
) -> DataFrame:
    """The mean of the chosen metric by a dimension."""
    if choice not in metrics:
        raise ValueError(f"{choice!r} is none of {', '.join(metrics)}")
    return (
        df.unpivot([dimension], list(metrics), "metric", "value")
        .filter(F.col("metric") == choice)
        .groupBy(dimension, "metric")
        .agg(F.avg("value").alias("value"))
    )


def sorted_measure(df: DataFrame, dimension: str, measure: str) -> DataFrame:
    return (
        df.groupBy(dimension).agg(F.sum(measure).alias(measure)).orderBy(F.desc(measure), dimension)
    )


def top_n(df: DataFrame, dimension: str, measure: str, n: int = 10) -> DataFrame:
    """The n members with the highest sum, showing their mean."""
    return (
        df.groupBy(dimension)
        .agg(F.sum(measure).alias("total"), F.avg(measure).alias("average"))
        .orderBy(F.desc("total"), dimension)
        .limit(n)
    )


def fixed_lod(df: DataFrame, dimension: str, aggregate: Column, output: str) -> DataFrame:
    """Attaches an aggregate over one dimension to every row.

    Aggregated map-side and joined back, so rows of a dominant member stay where they are
    (a window over the dimension would gather them in one task).
    """
    fixed = pin_if_small(df.groupBy(dimension).agg(aggregate.alias(output)))
    same = F.col("l." + dimension).eqNullSafe(F.col("r." + dimension))
    return df.alias("l").join(fixed.alias("r"), same, "left").select("l.*", f"r.{output}")


def score_histogram(
    scored: DataFrame, algorithms: Sequence[str], bins: int = 20, score: str = "anomaly_score"
) -> DataFrame:
    """Rows per algorithm and fixed-width bin between the lowest and highest score.

    The algorithms share the scores, so rows are counted once and the few bins repeated.
    """
    edges = scored.agg(F.min(score).alias("low"), F.max(score).alias("high")).first()
    if edges["low"] is None:
        low, width = 0.0, 1.0
    else:
        low, width = edges["low"], (edges["high"] - edges["low"]) / bins or 1.0
    number = F.least(F.floor((F.col(score) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        scored.filter(F.col(score).isNotNull())
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("algorithm", F.explode(F.array(*[F.lit(a) for a in algorithms])))
        .withColumn("bin_start", F.round(F.lit(low) + F.col("bin") * F.lit(width), 6))
    )


def score_trend(
    scored: DataFrame,
    thresholds: dict[str, float],
    unit: str = "month",
    timestamp: str = "timestamp",
    score: str = "anomaly_score",
) -> DataFrame:
    """Mean score and flagged rows per algorithm and period.

    One aggregate per period with a flag sum per operating point; only its result is unfolded.
    """
    cuts = list(thresholds.items())
    periods = scored.groupBy(F.date_trunc(unit, timestamp).alias("_start")).agg(
        F.round(F.avg(score), 6).alias("mean_score"),
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(anomaly_flag(score, cut)).alias(f"_n{i}") for i, (_, cut) in enumerate(cuts)],
    )
    flagged = [F.struct(F.lit(a).alias("algorithm"), F.col(f"_n{i}").alias("flagged")) for i, (a, _) in enumerate(cuts)]
    return periods.select(
        F.date_format("_start", "yyyy-MM-dd HH:mm:ss").alias("period"), "mean_score", "row_count", F.inline(F.array(*flagged))
    )


# -- histogram and trend in one pass ------------------------------------------------------------

#: Bins a task holds of a period before it doubles their width.
BINS_HELD = 4_096
#: Bits of a bin's number at most, so that doubles hold it.
BIN_BITS = 50


def width_level(low: float, high: float, bins: int) -> int:
    """The least power of two by which [low, high] falls into about ``bins`` bins."""
    span, largest = high - low, max(abs(low), abs(high))
    finest = math.frexp(largest)[1] - BIN_BITS if largest else -BIN_BITS
    return max(finest, math.ceil(math.log2(span / bins))) if span > 0 else finest


class PeriodBins:
    """Rows, sums and bins of one period; bins are [n, n + 1) times 2 ** level, so two of them make one of the next level."""

    def __init__(self) -> None:
        self.rows = self.present = 0
        self.total, self.low, self.high, self.level = 0.0, math.inf, -math.inf, -1100
        self.bins: dict[int, int] = {}

    def add(self, rows: int, values: np.ndarray) -> None:
        self.rows += rows
        if not len(values):
            return
        self.present += len(values)
        self.total += float(values.sum())
        self.low, self.high = min(self.low, float(values.min())), max(self.high, float(values.max()))
        level = max(self.level, width_level(self.low, self.high, BINS_HELD))
        if level > self.level:
            held, self.bins = self.bins, {}
            for n, count in held.items():
                wider = n >> (level - self.level)
                self.bins[wider] = self.bins.get(wider, 0) + count
            self.level = level
        for n, count in zip(*np.unique(np.floor(np.ldexp(values, -level)).astype(np.int64), return_counts=True), strict=True):
            self.bins[int(n)] = self.bins.get(int(n), 0) + int(count)


def _period_rows(points: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, tuple[PeriodBins, np.ndarray]] = {}
        for batch in batches:
            coded = batch.column("period").dictionary_encode(null_encoding="encode")
            names, number = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            scores = batch.column("score")
            valid = scores.is_valid().to_numpy(zero_copy_only=False)
            values = scores.fill_null(0.0).to_numpy(zero_copy_only=False)
            for i, name in enumerate(names):
                own = number == i
                mine = values[own & valid]
                bins, flagged = held.setdefault(name, (PeriodBins(), np.zeros(len(points), np.int64)))
                bins.add(int(own.sum()), mine[np.isfinite(mine)])
                flagged += [int(((mine >= cut) | np.isnan(mine)).sum()) for cut in points]  # NaN is the largest
        for name, (p, flagged) in held.items():
            rows = [{"period": name, "n": p.rows, "present": p.present, "total": p.total, "low": p.low, "high": p.high, "level": p.level, "flagged": flagged.tolist()}]
            rows += [{"period": name, "level": p.level, "bin": b, "n": n} for b, n in p.bins.items()]
            yield pa.RecordBatch.from_pylist(rows, schema=_PERIOD_SCHEMA)

    return run


_PERIOD_SCHEMA = pa.schema(
    [("period", pa.string()), ("level", pa.int32()), ("bin", pa.int64()), ("n", pa.int64()), ("present", pa.int64()), ("total", pa.float64())]
    + [("low", pa.float64()), ("high", pa.float64()), ("flagged", pa.list_(pa.int64()))]
)
_PERIOD_DDL = "period string, level int, bin long, n long, present long, total double, low double, high double, flagged array<bigint>"


def score_reports(
    scored: DataFrame,
    thresholds: dict[str, float],
    bins: int = 20,
    unit: str = "month",
    timestamp: str = "timestamp",
    score: str = "anomaly_score",
) -> tuple[DataFrame, DataFrame]:
    """A histogram per period and the trend, both from one scan that knows nothing of the scores before.

    Every task starts with narrow bins and doubles their width whenever a score lies further out, so its
    memory is fixed; bins of any two tasks nest, and in the end all are widened to the power of two that
    cuts the whole range into about ``bins`` bins.  Counts are exact.  The histogram is ``(period, bin,
    bin_start, row_count)`` over finite scores, the trend as of ``score_trend``.
    """
    period = F.date_format(F.date_trunc(unit, timestamp), "yyyy-MM-dd HH:mm:ss")
    slim = scored.select(period.alias("period"), F.col(score).cast("double").alias("score"))
    partial = stage_table(spread_if_narrow(slim).mapInArrow(_period_rows(list(thresholds.values())), _PERIOD_DDL), "period-bins")
    whole = partial.agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("level").alias("level")).first()
    some = whole["low"] is not None and whole["low"] <= whole["high"]
    level = max(whole["level"], width_level(whole["low"], whole["high"], bins)) if some else 0
    counted = (
        partial.filter(F.col("bin").isNotNull())
        .withColumn("bin", F.expr(f"shiftright(bin, {level} - level)"))
        .groupBy("period", "bin")
        .agg(F.sum("n").alias("row_count"))
    )
    histogram = counted.withColumn("bin_start", F.col("bin") * F.lit(math.ldexp(1.0, level)))
    sums = partial.filter(F.col("bin").isNull()).groupBy("period").agg(
        F.round(F.try_divide(F.sum("total"), F.sum("present")), 6).alias("mean_score"),
        F.sum("n").alias("row_count"),
        *[F.sum(F.col("flagged")[i]).alias(f"_n{i}") for i in range(len(thresholds))],
    )
    points = [F.struct(F.lit(a).alias("algorithm"), F.col(f"_n{i}").alias("flagged")) for i, a in enumerate(thresholds)]
    return histogram.select("period", "bin", "bin_start", "row_count"), sums.select("period", "mean_score", "row_count", F.inline(F.array(*points)))
