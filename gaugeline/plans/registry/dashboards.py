"""Dashboard queries over report tables computed from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.operators import quality, reports
from gaugeline.operators.anomaly import OPERATING_POINTS
from gaugeline.operators.enrich import enrich
from gaugeline.plans.registry.base import over, query
from gaugeline.plans.registry.statistics import (
    INFLUENCE_SQL,
    _influence,
    scored_rows,
    summary_table,
    thresholds_of,
)
from gaugeline.plans.telemetry import labelled, lineitem


def _scaling_table(spark, sf) -> DataFrame:
    """A timing-like report: one row per order line number and return flag."""
    timings = (
        lineitem(spark, sf)
        .groupBy(F.col("l_linenumber").alias("partitions"), F.col("l_returnflag").alias("experiment"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("duration_seconds", F.col("rows") / 40000.0)
    )
    return reports.scaling_costs(timings)


_SCALING = """SELECT l_linenumber AS "partitions", l_returnflag AS experiment, count(*) AS "rows",
                     count(*) / 40000.0::DOUBLE AS duration_seconds,
                     round(count(*) / greatest(count(*) / 40000.0::DOUBLE, 1e-6), 2) AS throughput_rows_per_sec,
                     round(count(*) / 40000.0::DOUBLE / 3600.0 * 1 * 0.25, 6) AS estimated_cost_usd
              FROM lineitem GROUP BY ALL"""


@query(
    "report_measure_by_dim",
    over(
        "enriched",
        """SELECT 'class by rows' AS sheet, class AS first_dim, NULL AS second_dim, count(*)::DOUBLE AS value
           FROM enriched GROUP BY class
           UNION ALL
           SELECT 'mode and risk by rows', operating_mode, mode_risk, count(*)::DOUBLE FROM enriched GROUP BY ALL
           UNION ALL
           SELECT 'partitions by mean seconds', "partitions"::VARCHAR, NULL, round(avg(duration_seconds), 6)
           FROM scaling GROUP BY "partitions"
           UNION ALL
           SELECT 'partitions by mean cost', "partitions"::VARCHAR, NULL, round(avg(estimated_cost_usd), 6)
           FROM scaling GROUP BY "partitions"
           UNION ALL
           SELECT 'experiment by mean throughput', experiment, NULL, round(avg(throughput_rows_per_sec), 4)
           FROM scaling GROUP BY experiment""",
        scaling=_SCALING,
    ),
)
def report_measure_by_dim(spark, sf):
    rows = enrich(labelled(spark, sf))
    classes, modes = reports.class_distribution(rows), reports.mode_risk_distribution(rows)
    scaling = _scaling_table(spark, sf)
    total = F.sum("row_count").cast("double")
    sheets = {
        "class by rows": (classes, ["class"], total),
        "mode and risk by rows": (modes, ["app_family", "family_risk"], total),
        "partitions by mean seconds": (scaling, ["partitions"], F.round(F.avg("duration_seconds"), 6)),
        "partitions by mean cost": (scaling, ["partitions"], F.round(F.avg("estimated_cost_usd"), 6)),
        "experiment by mean throughput": (
            scaling, ["experiment"], F.round(F.avg("throughput_rows_per_sec"), 4),
        ),
    }
    parts = []
    for sheet, (table, dims, measure) in sheets.items():
        names = [F.col(d).cast("string") for d in dims] + [F.lit(None).cast("string")]
        parts.append(
            reports.measure_by(table, dims, {"value": measure}).select(
                F.lit(sheet).alias("sheet"), names[0].alias("first_dim"), names[1].alias("second_dim"), "value"
            )
        )
    return quality.union_by_name(*parts)


@query(
    "report_kpi_totals",
    over(
        "summary",
        """SELECT sum(round_even("rows" * anomaly_rate, 0) * -8.0)::DOUBLE AS expected_profit_usd,
                  CAST(NULL AS BIGINT) AS fn, CAST(NULL AS BIGINT) AS fp, CAST(NULL AS BIGINT) AS tp
           FROM summary WHERE split = 'test'""",
    ),
)
def report_kpi_totals(spark, sf):
    table = reports.business_alignment(summary_table(spark, sf))
    return reports.kpi_totals(table, ["expected_profit_usd", "fn", "fp", "tp"])


@query(
    "report_filtered_measure",
    over(
        "summary",
        """SELECT 'test anomaly rate' AS sheet, algorithm AS dimension, round(avg(anomaly_rate), 6) AS value
           FROM summary WHERE split = 'test' GROUP BY algorithm
           UNION ALL
           SELECT 'test score p99', algorithm, round(avg(score_p99), 6) FROM summary WHERE split = 'test' GROUP BY algorithm
           UNION ALL
           SELECT 'seconds by partitions', "partitions"::VARCHAR, round(avg(duration_seconds), 6)
           FROM scaling WHERE "rows" BETWEEN 5 AND 2800 GROUP BY "partitions\"""",
        scaling=_SCALING,
    ),
)
def report_filtered_measure(spark, sf):
    summary, scaling = summary_table(spark, sf), _scaling_table(spark, sf)
    on_test = F.col("split") == "test"
    sheets = {
        "test anomaly rate": (summary, on_test, "algorithm", "anomaly_rate"),
        "test score p99": (summary, on_test, "algorithm", "score_p99"),
        "seconds by partitions": (
            scaling, F.col("rows").between(5, 2800), "partitions", "duration_seconds",
        ),
    }
    parts = [
        reports.filtered_measure(table, condition, [dim], {"value": F.round(F.avg(measure), 6)}).select(
            F.lit(sheet).alias("sheet"), F.col(dim).cast("string").alias("dimension"), "value"
        )
        for sheet, (table, condition, dim, measure) in sheets.items()
    ]
    return quality.union_by_name(*parts)


@query(
    "report_metric_selector",
    over(
        "summary",
        """SELECT algorithm, 'anomaly_rate' AS metric, round(avg(anomaly_rate), 6) AS value FROM summary GROUP BY algorithm
           UNION ALL SELECT algorithm, 'score_p95', round(avg(score_p95), 6) FROM summary GROUP BY algorithm
           UNION ALL SELECT algorithm, 'score_p99', round(avg(score_p99), 6) FROM summary GROUP BY algorithm""",
    ),
)
def report_metric_selector(spark, sf):
    summary = summary_table(spark, sf)
    chosen = [reports.metric_selector(summary, m) for m in ("anomaly_rate", "score_p95", "score_p99")]
    return quality.union_by_name(*chosen).withColumn("value", F.round("value", 6))


@query(
    "report_top_n",
    over(
        "scored",
        f"""SELECT feature, round(sum(importance), 7) AS total, round(avg(importance), 7) AS average
            FROM ({INFLUENCE_SQL}) GROUP BY feature ORDER BY sum(importance) DESC, feature LIMIT 10""",
    ),
)
def report_top_n(spark, sf):
    return reports.top_n(_influence(spark, sf), "feature", "importance").withColumns(
        {"total": F.round("total", 7), "average": F.round("average", 7)}
    )


@query(
    "report_sorted_measure",
    """SELECT metric, sum(value)::BIGINT AS value FROM (
         SELECT 'total_rows' AS metric, count(*) AS value FROM lineitem
         UNION ALL SELECT 'ground_truth_label_available', 1
         UNION ALL SELECT 'duplicate_rows', count(*) - (SELECT count(*) FROM (
             SELECT DISTINCT l_returnflag, l_quantity, NULLIF(l_discount, 0.0) FROM lineitem)) FROM lineitem
         UNION ALL SELECT 'null_class', 0
         UNION ALL SELECT 'null_quantity', 0
         UNION ALL SELECT 'null_discount', count(*) FROM lineitem WHERE l_discount = 0.0)
       GROUP BY metric ORDER BY value DESC, metric""",
)
def report_sorted_measure(spark, sf):
    raw = lineitem(spark, sf).select(
        F.col("l_returnflag").alias("class"),
        F.col("l_quantity").alias("quantity"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
    )
    table = quality.quality_report(raw, ["quantity", "discount"], has_label=True)
    return reports.sorted_measure(table, "metric", "value")


@query(
    "report_fixed_lod",
    over(
        "summary",
        """SELECT 'rate by algorithm' AS lod, algorithm || ' ' || split AS member,
                  round(avg(anomaly_rate) OVER (PARTITION BY algorithm), 6) AS value FROM summary
           UNION ALL
           SELECT 'cost by experiment', experiment || ' ' || "partitions",
                  round(avg(estimated_cost_usd) OVER (PARTITION BY experiment), 6) FROM scaling""",
        scaling=_SCALING,
    ),
)
def report_fixed_lod(spark, sf):
    rate = reports.fixed_lod(summary_table(spark, sf), "algorithm", F.avg("anomaly_rate"), "value")
    cost = reports.fixed_lod(_scaling_table(spark, sf), "experiment", F.avg("estimated_cost_usd"), "value")
    return quality.union_by_name(
        rate.select(
            F.lit("rate by algorithm").alias("lod"),
            F.concat_ws(" ", "algorithm", "split").alias("member"),
            F.round("value", 6).alias("value"),
        ),
        cost.select(
            F.lit("cost by experiment").alias("lod"),
            F.concat_ws(" ", "experiment", F.col("partitions").cast("string")).alias("member"),
            F.round("value", 6).alias("value"),
        ),
    )


@query(
    "report_score_histogram",
    over(
        "flagged",
        """SELECT algorithm, bin, count(*) AS row_count, round(low + bin * width, 6) AS bin_start
           FROM (SELECT algorithm, low, width, least(floor((anomaly_score - low) / width), 19)::INTEGER AS bin
                 FROM flagged, (SELECT min(anomaly_score) AS low, (max(anomaly_score) - min(anomaly_score)) / 20 AS width
                                FROM scored))
           GROUP BY ALL""",
    ),
)
def report_score_histogram(spark, sf):
    return reports.score_histogram(scored_rows(spark, sf), list(OPERATING_POINTS))


@query(
    "report_score_trend",
    over(
        "flagged",
        """SELECT algorithm, strftime(date_trunc('month', "timestamp"), '%Y-%m-%d %H:%M:%S') AS period,
                  round(avg(anomaly_score), 6) AS mean_score, sum(anomaly_flag)::BIGINT AS flagged,
                  count(*) AS row_count FROM flagged GROUP BY ALL""",
    ),
)
def report_score_trend(spark, sf):
    scored = scored_rows(spark, sf)
    return reports.score_trend(scored, thresholds_of(scored))


@query(
    "report_histogram_by_month",
    over(
        "scored",
        """SELECT strftime(date_trunc('month', "timestamp"), '%Y-%m-%d %H:%M:%S') AS period,
                  floor(anomaly_score / width)::BIGINT AS bin, floor(anomaly_score / width) * width AS bin_start,
                  count(*) AS row_count
           FROM scored, (SELECT pow(2.0::DOUBLE, ceil(log2((max(anomaly_score) - min(anomaly_score)) / 20))) AS width FROM scored)
           GROUP BY ALL""",
    ),
)
def report_histogram_by_month(spark, sf):
    """Bins of a power of two per month, from the one scan that also gives the trend."""
    histogram, _ = reports.score_reports(scored_rows(spark, sf).select("timestamp", "anomaly_score"), {"loose": 0.5})
    return histogram
