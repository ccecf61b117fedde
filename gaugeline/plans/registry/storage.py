"""Scan and sink round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators import quality, reports, stages, supervised
from gaugeline.operators.anomaly import anomaly_flag
from gaugeline.operators.enrich import enrich
from gaugeline.plans.registry.base import over, query
from gaugeline.plans.registry.statistics import staged_scores, thresholds_of
from gaugeline.plans.telemetry import KEY, SENSORS, labelled, telemetry
from gaugeline.sources import reports as sinks
from gaugeline.sources import telemetry as scans
from gaugeline.sources.workspace import new_path

_SLIM = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("tp2", T.DoubleType()),
        T.StructField("h1", T.DoubleType()),
        T.StructField("comp", T.IntegerType()),
        T.StructField("label", T.StringType()),
    ]
)


@query(
    "scan_csv_roundtrip",
    over(
        "telemetry",
        """SELECT label, count(*) AS row_count, sum(tp2) AS total, count(h1) AS present, sum(comp)::BIGINT AS running,
                  strftime(max("timestamp"), '%Y-%m-%d') AS last_day FROM telemetry GROUP BY label""",
    ),
)
def scan_csv_roundtrip(spark, sf):
    path = new_path(spark, "csv")
    telemetry(spark, sf).select(*_SLIM.names).write.option("header", True).csv(path)
    return (
        scans.scan_csv(spark, path, _SLIM)
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("tp2").alias("total"),
            F.count("h1").alias("present"),
            F.sum("comp").alias("running"),
            F.date_format(F.max("timestamp"), "yyyy-MM-dd").alias("last_day"),
        )
    )


@query(
    "scan_glob",
    over("telemetry", "SELECT comp, lps, count(*) AS row_count, sum(tp2) AS total FROM telemetry GROUP BY ALL"),
)
def scan_glob(spark, sf):
    folder = new_path(spark, "raw")
    slim = telemetry(spark, sf).select("tp2", "comp", "lps")
    slim.repartition(3).write.option("header", True).csv(folder)
    read = scans.scan_source(
        spark, f"{folder}/missing.csv", folder, slim.schema, pattern="part-*.csv"
    )
    return read.groupBy("comp", "lps").agg(F.count(F.lit(1)).alias("row_count"), F.sum("tp2").alias("total"))


@query(
    "parquet_partition_roundtrip",
    over(
        "enriched",
        """SELECT operating_mode, count(*) AS row_count, sum(tp2) AS total FROM enriched
           WHERE class = 'malware' GROUP BY operating_mode""",
    ),
)
def parquet_partition_roundtrip(spark, sf):
    path = new_path(spark, "curated")
    scans.write_curated(enrich(labelled(spark, sf)), path)
    return (
        spark.read.parquet(path)
        .filter(F.col("class") == "malware")
        .groupBy("operating_mode")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("tp2").alias("total"))
    )


@query(
    "scan_quarantine",
    """SELECT CASE l_linenumber WHEN 5 THEN 'other type' WHEN 6 THEN 'too few fields' ELSE 'read' END AS kind,
              count(*) AS row_count, sum(CASE WHEN l_linenumber NOT IN (5, 6) THEN l_quantity END) AS total
       FROM lineitem GROUP BY kind""",
)
def scan_quarantine(spark, sf):
    """Lines with a text for a number, and lines that end early, kept apart from those that were read."""
    folder = new_path(spark, "raw")
    slim = _SLIM.names[1:]
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.when(F.col("l_linenumber") == 5, F.lit("soon")).otherwise(F.col("l_quantity").cast("string")).alias("tp2"),
        F.col("l_discount").cast("string").alias("h1"),
        F.lit("1").alias("comp"),
        F.col("l_returnflag").alias("label"),
        F.col("l_linenumber").alias("kind"),
    )
    short = F.concat_ws(",", "tp2", "h1")
    line = F.when(F.col("kind") == 6, short).otherwise(F.concat_ws(",", *slim))
    # Another separator, so that the lines are written as they are.
    rows.select(line.alias(",".join(slim))).write.option("header", True).option("sep", "\x01").csv(folder)
    found = scans.scan_quarantined(spark, None, folder, T.StructType(_SLIM.fields[1:]), pattern="part-*.csv")
    read = found.rows.agg(F.lit("read").alias("kind"), F.count(F.lit(1)).alias("row_count"), F.sum("tp2").alias("total"))
    kind = F.when(F.col("fields") == len(slim), "other type").otherwise("too few fields")
    bad = found.bad_lines.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("row_count"))
    return read.unionByName(bad, allowMissingColumns=True)


@query(
    "curated_class_update",
    over(
        "enriched",
        """SELECT class, count(*) AS row_count, sum(tp2) AS total FROM enriched
           WHERE class <> 'malware' OR tp2 > 25 GROUP BY class""",
    ),
)
def curated_class_update(spark, sf):
    """One class of the curated table written anew; the others stay."""
    path = new_path(spark, "curated")
    rows = enrich(labelled(spark, sf))
    scans.write_curated(rows, path)
    scans.update_curated(rows.filter("class = 'malware' AND tp2 > 25"), path)
    return spark.read.parquet(path).groupBy("class").agg(F.count(F.lit(1)).alias("row_count"), F.sum("tp2").alias("total"))


@query(
    "scored_export",
    over(
        "flagged",
        """SELECT algorithm, split, class, count(*) AS row_count, sum(anomaly_flag)::BIGINT AS flagged,
                  round(max(anomaly_score), 9) AS highest, strftime(max("timestamp"), '%Y-%m-%d') AS last_day
           FROM flagged GROUP BY ALL""",
    ),
)
def scored_export(spark, sf):
    """Scored rows written once with a flag per operating point, unfolded while reading."""
    folder = new_path(spark, "reports")
    scored = staged_scores(spark, sf, "timestamp", "class")
    sinks.write_scores(scored, thresholds_of(scored), folder)
    return (
        sinks.read_report(spark, folder, "anomaly_scores")
        .groupBy("algorithm", "split", "class")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("anomaly_flag").alias("flagged"),
            F.round(F.max("anomaly_score"), 9).alias("highest"),
            F.date_format(F.max("timestamp"), "yyyy-MM-dd").alias("last_day"),
        )
    )


@query(
    "report_csv_roundtrip",
    over(
        "enriched",
        """SELECT operating_mode AS app_family, mode_risk AS family_risk, class, count(*) AS row_count
           FROM enriched GROUP BY ALL""",
    ),
)
def report_csv_roundtrip(spark, sf):
    folder, name = new_path(spark, "reports"), "family_risk_distribution"
    table = reports.mode_risk_distribution(enrich(labelled(spark, sf)))
    sinks.write_report(sinks.conform(table, name), folder, name)
    return sinks.read_report(spark, folder, name)


@query(
    "scan_report_typed",
    over(
        "labelled",
        """SELECT algorithm, class, count(*) AS row_count, sum(CASE WHEN tp3 >= 60000.0 THEN 1 ELSE 0 END)::BIGINT AS flagged,
                  max(tp3) AS highest
           FROM labelled CROSS JOIN (SELECT 'price' AS algorithm) GROUP BY ALL""",
    ),
)
def scan_report_typed(spark, sf):
    folder, name = new_path(spark, "reports"), "anomaly_scores"
    rows = labelled(spark, sf).select(
        F.lit("price").alias("algorithm"),
        F.lit("train").alias("split"),
        anomaly_flag("tp3", 60000.0).alias("anomaly_flag"),
        F.col("tp3").alias("anomaly_score"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        "class",
    )
    sinks.write_report(sinks.conform(rows, name), folder, name)
    return (
        sinks.read_report(spark, folder, name)
        .groupBy("algorithm", "class")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("anomaly_flag").alias("flagged"),
            F.max("anomaly_score").alias("highest"),
        )
    )


@query(
    "stage_metrics_json",
    """SELECT 'raw' AS stage, count(*) AS "rows" FROM lineitem
       UNION ALL SELECT 'deduplicated', count(*)
         FROM (SELECT DISTINCT l_returnflag, l_linenumber, l_quantity FROM lineitem)""",
)
def stage_metrics_json(spark, sf):
    rows = telemetry(spark, sf)
    narrow = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_returnflag", "l_linenumber", "l_quantity")
    counts = stages.stage_counts({"raw": rows, "deduplicated": quality.dedup_rows(narrow)})
    path = new_path(spark, "metrics")
    timed = counts.select("stage", F.lit(0.5).alias("duration_seconds"), "rows")
    sinks.write_stage_metrics(timed, path, {"run_scalability": "false"})
    return sinks.read_stage_metrics(spark, path).select("stage", "rows")


@query("model_roundtrip", "SELECT count(*) AS row_count, count(*) AS equal_predictions FROM lineitem")
def model_roundtrip(spark, sf):
    """Rows on which a saved and reloaded model predicts as the fitted one does."""
    vectors = supervised.labelled_vectors(labelled(spark, sf), SENSORS, KEY)
    model = supervised.fit(supervised.logistic_regression(), vectors)
    path = new_path(spark, "model")
    supervised.save_model(model, path)
    again = supervised.load_model(path)
    first = model.transform(vectors).withColumnRenamed("prediction", "before")
    both = again.transform(first.drop("rawPrediction", "probability"))
    return both.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("before") == F.col("prediction")).alias("equal_predictions"),
    )
