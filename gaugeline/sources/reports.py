"""Report tables: fixed schemas, CSV and JSON sinks, typed scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeline.sources.telemetry import path_exists

# Columns of each report table.
REPORT_DDL = {
    "etl_stage_timings": "stage STRING, duration_seconds DOUBLE, rows BIGINT",
    "data_quality_report": "metric STRING, value BIGINT",
    "pipeline_lineage": "stage STRING, status STRING, input_rows BIGINT, output_rows BIGINT, notes STRING",
    "class_distribution": "class STRING, row_count BIGINT",
    "split_summary": "split STRING, class STRING, row_count BIGINT",
    "model_metrics": (
        "anomaly_rate DOUBLE, score_mean DOUBLE, score_std DOUBLE, score_p95 DOUBLE, score_p99 DOUBLE, "
        "accuracy DOUBLE, f1 DOUBLE, weightedPrecision DOUBLE, weightedRecall DOUBLE, auc DOUBLE, "
        "algorithm STRING, engine STRING, split STRING, runtime_seconds DOUBLE, anomaly_threshold DOUBLE"
    ),
    "cv_results": (
        "algorithm STRING, params STRING, cv_metric_auc DOUBLE, selection_metric STRING, selection_value DOUBLE"
    ),
    "feature_importance": "algorithm STRING, feature STRING, importance DOUBLE",
    "anomaly_scores": (
        "algorithm STRING, split STRING, anomaly_flag INT, anomaly_score DOUBLE, timestamp TIMESTAMP, class STRING"
    ),
    "family_risk_distribution": "app_family STRING, family_risk STRING, class STRING, row_count BIGINT",
    "business_insights": "insight STRING, value DOUBLE, recommendation STRING",
    "business_metric_alignment": (
        "algorithm STRING, split STRING, tp BIGINT, fp BIGINT, fn BIGINT, "
        "expected_profit_usd DOUBLE, assumption STRING"
    ),
    "bootstrap_confidence_intervals": (
        "algorithm STRING, split STRING, metric STRING, ci_lower_95 DOUBLE, ci_upper_95 DOUBLE, "
        "bootstrap_iterations BIGINT, sample_rows BIGINT"
    ),
    "scalability_strong": (
        "experiment STRING, partitions INT, rows BIGINT, duration_seconds DOUBLE, throughput_rows_per_sec DOUBLE"
    ),
    "scalability_weak": (
        "experiment STRING, partitions INT, multiplier INT, rows BIGINT, duration_seconds DOUBLE, "
        "throughput_rows_per_sec DOUBLE"
    ),
    "cost_performance": "experiment STRING, partitions INT, duration_seconds DOUBLE, estimated_cost_usd DOUBLE",
}

# Reports that hold one row per input row and must never be squeezed into one file.
ROW_LEVEL_REPORTS = frozenset({"anomaly_scores"})


def conform(df: DataFrame, report: str) -> DataFrame:
    """Select and cast to the report's declared columns."""
    schema = StructType.fromDDL(REPORT_DDL[report])
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_report(df: DataFrame, folder: str, report: str) -> str:
    """CSV with header; one file for an aggregated report, many for a row-level one."""
    path = f"{folder.rstrip('/')}/{report}"
    out = df if report in ROW_LEVEL_REPORTS else df.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


# -- scored rows --------------------------------------------------------------------------------

FLAG_PREFIX = "flag_"


def write_scores(scored: DataFrame, thresholds: dict[str, float], folder: str, score: str = "anomaly_score") -> str:
    """The scored-row export: every row once, with a flag for each operating point, partitioned by split."""
    path = f"{folder.rstrip('/')}/anomaly_scores"
    declared = StructType.fromDDL(REPORT_DDL["anomaly_scores"])
    kept = [
        (F.col(f.name) if f.name in scored.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in declared
        if f.name in ("timestamp", "class")
    ]
    flags = [(F.col(score) >= F.lit(cut)).cast("int").alias(f"{FLAG_PREFIX}{name}") for name, cut in thresholds.items()]
    rows = scored.select("split", F.col(score).cast("double").alias("anomaly_score"), *flags, *kept)
    rows.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The export as the report table: a row per operating point, unfolded while reading."""
    held = spark.read.parquet(f"{folder.rstrip('/')}/anomaly_scores")
    flags = [c for c in held.columns if c.startswith(FLAG_PREFIX)]
    points = F.array(*[F.struct(F.lit(c.removeprefix(FLAG_PREFIX)).alias("algorithm"), F.col(c).alias("anomaly_flag")) for c in flags])
    return conform(held.select("*", F.inline(points)), "anomaly_scores")


def read_report(spark: SparkSession, folder: str, report: str, ddl: str | None = None) -> DataFrame:
    """Typed scan of a report; malformed text fails the read instead of turning into nulls.

    The scored-row export of a full run is a Parquet table and is unfolded.
    """
    if report in ROW_LEVEL_REPORTS and path_exists(spark, f"{folder.rstrip('/')}/{report}/split=*"):
        return read_scores(spark, folder)
    return (
        spark.read.schema(ddl or REPORT_DDL[report])
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(f"{folder.rstrip('/')}/{report}")
    )


def write_stage_metrics(stage_metrics: DataFrame, path: str, extra: dict[str, str] | None = None) -> None:
    """One JSON object ``{"stage_metrics": [...], "extra": {...}}``; one row per stage, so it is small."""
    pairs = [F.lit(x) for item in (extra or {}).items() for x in item]
    nested = stage_metrics.agg(
        F.sort_array(F.collect_list(F.struct(*stage_metrics.columns))).alias("stage_metrics")
    ).withColumn("extra", F.create_map(*pairs) if pairs else F.expr("map()").cast("map<string,string>"))
    nested.coalesce(1).write.mode("overwrite").json(path)


def read_stage_metrics(spark: SparkSession, path: str) -> DataFrame:
    stages = "array<struct<stage: string, duration_seconds: double, rows: bigint>>"
    return (
        spark.read.schema(f"stage_metrics {stages}, extra map<string, string>")
        .json(path)
        .select(F.inline("stage_metrics"))
    )
