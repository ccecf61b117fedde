"""Times the headline stages and queries; prints one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

Every entry is run twice and the faster run counts, so class loading is left out.

The stages are timed a second time on as many rows as the published baseline has, made of shifted
copies of ``lineitem`` (entries ``<stage>_1517k``), with the weak scaling points.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gaugeline.operators import anomaly, features, quality, split  # noqa: E402
from gaugeline.operators.enrich import enrich  # noqa: E402
from gaugeline.operators.schema import ingest  # noqa: E402
from gaugeline.plans import scaling, telemetry as view  # noqa: E402
from gaugeline.plans.registry import QUERIES  # noqa: E402
from gaugeline.sources.telemetry import scan_csv  # noqa: E402
from gaugeline.sources.workspace import new_path, spread_if_narrow  # noqa: E402

REPEATS = 2
# Fixed value: rows of the published baseline.
BASELINE_ROWS = 1_516_948
HEADLINE_QUERIES = (
    "family_risk_distribution",
    "dq_report",
    "quantiles_exact",
    "score_summary",
    "topk_confusion",
    "roc_auc",
    "feature_influence",
    "bootstrap_ci",
    "stratified_split",
    "report_score_trend",
)


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def stages(spark: SparkSession, folder: str) -> dict:
    """The stages of the full run, each over the whole table from its own input file."""
    sensors = view.telemetry(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    csv = new_path(spark, "bench-csv")
    sensors.drop(view.KEY).write.option("header", True).csv(csv)
    schema = sensors.drop(view.KEY).schema
    rows = view.labelled(spark, folder)
    featured, columns = view.featured(spark, folder)
    parts = split.temporal_split(featured)

    def ingestion() -> None:
        found = ingest(scan_csv(spark, csv, schema))
        quality.quality_report(found.frame, found.features, found.has_label).collect()

    def unsupervised() -> None:
        train = parts.filter(F.col("split") == "train")
        forest = anomaly.fit_isolation_forest(train, columns, view.KEY)
        run_all(forest.score(parts).select("split", "anomaly_score"))

    # The scaling workload runs on rows held in memory, after their first use filled the cache.
    held = spread_if_narrow(enrich(rows).select("class")).persist(StorageLevel.MEMORY_AND_DISK)
    held.count()

    def scaling(partitions: int):
        return lambda: split.repartition_group_count(held, partitions).collect()

    return {
        "ingestion_validation": ingestion,
        "basic_etl": lambda: run_all(quality.clean_rows(rows)),
        "broadcast_etl": lambda: run_all(enrich(rows)),
        "feature_engineering": lambda: run_all(features.assemble(featured, columns)),
        "data_split": lambda: split.split_rows(featured, view.KEY).groupBy("split").count().collect(),
        "train_unsupervised": unsupervised,
        **{f"strong_scaling_{n}": scaling(n) for n in (2, 4, 8, 16)},
    }


def baseline_sized(spark: SparkSession, folder: str, rows: int) -> str:
    """A folder whose ``lineitem`` has as many rows as the baseline: copies with order keys of their own."""
    source, path = view.lineitem(spark, folder), new_path(spark, "bench-rows")
    parts = [source.withColumn("l_orderkey", F.col("l_orderkey") + F.lit(i * 10**9)) for i in range(-(-BASELINE_ROWS // rows))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    whole.limit(BASELINE_ROWS).write.parquet(f"{path}/lineitem.parquet")
    return path


def weak_scaling(spark: SparkSession, folder: str) -> dict:
    """The weak scaling points: rows and partitions grow together."""
    base = split.fraction_sample(view.labelled(spark, folder).select(view.KEY, "class"), view.KEY, scaling.WEAK_BASE_ROWS)
    held = base.persist(StorageLevel.MEMORY_AND_DISK)
    held.count()

    def point(copies: int, partitions: int):
        return lambda: split.repartition_group_count(split.replicate_rows(held, copies), partitions).collect()

    return {f"weak_scaling_{partitions}": point(copies, partitions) for copies, partitions in scaling.WEAK_STEPS}


def timed(action) -> float:
    best = float("inf")
    for _ in range(REPEATS):
        started = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - started)
    return round(best, 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gaugeline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gaugeline-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = view.lineitem(spark, folder).count()
    seconds = {name: timed(action) for name, action in stages(spark, folder).items()}
    for name in HEADLINE_QUERIES:
        seconds[name] = timed(lambda query=QUERIES[name]: run_all(query(spark, folder)))
    large = baseline_sized(spark, folder, rows)
    at_size = {f"{name}_1517k": timed(action) for name, action in (stages(spark, large) | weak_scaling(spark, large)).items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds | at_size,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "rows": rows,
                "rows_1517k": BASELINE_ROWS,
                "rows_per_second": {name: round(rows / s) for name, s in seconds.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
