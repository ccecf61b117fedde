"""The whole job: raw telemetry in, curated Parquet, models and report tables out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from time import perf_counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import labels
from gaugeline.operators import anomaly, evaluate, features, quality, reports, split, supervised
from gaugeline.operators.enrich import enrich
from gaugeline.operators.schema import ingest, sanitize_columns, timestamp_failures
from gaugeline.operators.selection import join_groups
from gaugeline.operators.stages import StageLog
from gaugeline.plans import scaling
from gaugeline.sources.reports import conform, write_report, write_scores, write_stage_metrics
from gaugeline.sources.telemetry import Quarantined, write_curated
from gaugeline.sources.workspace import release_tables, stage_table

KEY = "row_key"
STAGE_NOTES = {
    "ingestion_validation": "names, time, label and features found; copies and nulls counted",
    "basic_etl": "distinct rows, label trimmed and lower-cased",
    "broadcast_etl": "operating mode and its risk joined",
    "feature_engineering": "risk scores added to the features",
    "data_split": "60/20/20 by time, else within labels",
    "train_unsupervised": "forest of the train split, scores of all rows",
}


def with_row_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Content hash of the row: unique once duplicates are gone."""
    return df.withColumn(KEY, F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


def intervals_table(scored: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Bootstrap intervals per algorithm and split, drawn once for all operating points."""
    metrics = {a: anomaly.anomaly_flag("anomaly_score", t) for a, t in thresholds.items()}
    drawn = evaluate.bootstrap_intervals(
        scored, metrics | {"score_mean": F.col("anomaly_score")}, ("split",), KEY
    )
    algorithms = F.array(*[F.lit(a) for a in thresholds])
    rates = drawn.filter(F.col("metric").isin(*thresholds)).withColumns(
        {"algorithm": F.col("metric"), "metric": F.lit("anomaly_rate")}
    )
    means = drawn.filter(F.col("metric") == "score_mean").withColumn("algorithm", F.explode(algorithms))
    return rates.unionByName(means)


def metrics_table(scored: DataFrame, thresholds: dict[str, float], labelled: bool) -> DataFrame:
    """Score summary per algorithm and split, with the label metrics where there are labels."""
    table = anomaly.operating_point_summary(scored, thresholds)
    truth = ("accuracy", "f1", "weightedPrecision", "weightedRecall", "auc")
    if not labelled:
        return table.withColumns({c: F.lit(None).cast("double") for c in truth})
    judged = scored.select(KEY, "split", "anomaly_score", labels.is_positive("class").alias("_label"))
    topk = evaluate.topk_confusion(judged, KEY, "_label", ("split",)).drop("tp", "fp", "fn")
    auc = evaluate.roc_auc(judged, "_label", ("split",)).withColumn("auc", F.round("auc", 6))
    return join_groups(join_groups(table, topk, ["split"]), auc, ["split"])


def run_reports(raw: DataFrame | Quarantined, out_dir: str, measure_scaling: bool = False) -> dict[str, str]:
    """Runs every stage and writes every report; returns the path of each report.

    Every stage is held in the shared folder, so a lost executor never costs more than a re-read and
    its times and rows are those of its own work.  Each stage's rows hold all columns of the stages
    before it, whose tables are released once the split is done.  A quarantined scan also has its bad
    lines counted in the quality report and written to ``quarantine``.
    """
    bad = raw if isinstance(raw, Quarantined) else None
    raw = bad.rows if bad else raw
    spark = raw.sparkSession
    log = StageLog()
    written: dict[str, str] = {}
    staged: list[str] = []

    def report(name: str, frame: DataFrame) -> None:
        written[name] = write_report(conform(frame, name), out_dir, name)

    def stage(name: str, build: Callable[[], DataFrame], before: str | None, **how) -> DataFrame:
        return log.run(name, build, log.rows_of(before) if before else None, STAGE_NOTES[name], paths=staged, **how)

    try:
        ingested = ingest(raw)
        groups = stage(
            "ingestion_validation",
            lambda: with_row_key(quality.collapse_copies(ingested.frame), ingested.frame.columns),
            None,
            count=lambda frame: frame.agg(F.sum(quality.COPIES)).first()[0] or 0,
        )
        checked = quality.quality_of_groups(groups, ingested.features, ingested.has_label)
        checked = checked.union(timestamp_failures(sanitize_columns(raw)))
        if bad:
            checked = checked.union(bad.report())
            bad.bad_lines.write.mode("overwrite").parquet(f"{out_dir}/quarantine")
        report("data_quality_report", checked)
        clean = stage(
            "basic_etl",
            lambda: groups.drop(quality.COPIES).withColumn("class", labels.clean_label("class")),
            "ingestion_validation",
        )
        enriched = stage("broadcast_etl", lambda: enrich(clean), "basic_etl")
        curated = [c for c in enriched.columns if c != KEY]
        featured, columns = features.with_risk_scores(enriched, ingested.features)
        held = stage("feature_engineering", lambda: featured, "broadcast_etl")
        parts = stage("data_split", lambda: split.split_rows(held, KEY), "feature_engineering")
        release_tables(spark, [staged.pop(0) for _ in range(4)])

        labelled = quality.has_ground_truth(parts)

        started = perf_counter()
        forest = anomaly.fit_isolation_forest(parts.filter("split = 'train'"), columns, KEY)
        fit_seconds = round(perf_counter() - started, 4)
        scored = stage("train_unsupervised", lambda: forest.score(parts), "data_split")
        thresholds = anomaly.operating_points(scored.filter("split = 'train'"))
        replace(forest, cuts=thresholds).save(spark, f"{out_dir}/models/isolation_forest")
        summary = metrics_table(scored, thresholds, labelled)
        summary = stage_table(summary.coalesce(1), "summary", staged)
        engine = summary.withColumns(
            {
                "engine": F.lit("spark_isolation_forest"),
                "runtime_seconds": F.lit(fit_seconds),
            }
        )
        if labelled:
            judged = supervised.supervised_baselines(
                parts.filter("split = 'train'"), columns, KEY, f"{out_dir}/models"
            )
            engine = engine.unionByName(judged, allowMissingColumns=True)
        report("model_metrics", engine)
        report("cv_results", anomaly.model_selection(summary, thresholds))
        report(
            "feature_importance",
            evaluate.feature_influence(scored.filter("split = 'validation'"), columns, list(thresholds)),
        )
        written["anomaly_scores"] = write_scores(scored, thresholds, out_dir)
        report("bootstrap_confidence_intervals", intervals_table(scored, thresholds))
        report("class_distribution", reports.class_distribution(parts))
        report("split_summary", reports.split_summary(parts))
        report("family_risk_distribution", reports.mode_risk_distribution(parts))
        deviations = reports.sensor_stddev(parts, ingested.features)
        report("business_insights", reports.business_insights(summary, deviations))
        report("business_metric_alignment", reports.business_alignment(summary))
        if measure_scaling:
            strong, weak = scaling.strong_scaling(parts.select(KEY, *curated)), scaling.weak_scaling(parts.drop("split"), KEY)
            report("scalability_strong", strong)
            report("scalability_weak", weak)
            report("cost_performance", scaling.cost_performance(strong, weak))
        report("etl_stage_timings", log.stage_metrics(spark))
        write_stage_metrics(
            log.stage_metrics(spark), f"{out_dir}/spark_job_metrics",
            {"selected_stage": "all", "run_scalability": str(measure_scaling).lower()},
        )
        write_curated(parts.select(*curated), f"{out_dir}/curated_parquet")
    except Exception as error:
        if not any(status == "failed" for _, status, *_ in log.lineage):
            log.fail("run", error)
        raise
    finally:
        report("pipeline_lineage", log.lineage_table(spark))
        release_tables(spark, staged)
    return written
