"""Distributions, quantiles, score evaluation and business queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import labels
from gaugeline.functions.numeric import epoch_seconds
from gaugeline.operators import anomaly, evaluate, features, reports, selection, split
from gaugeline.plans.registry.base import over, query, union_all, value_query
from gaugeline.plans.telemetry import KEY, SENSORS, deviation_score, featured, labelled, lineitem, telemetry
from gaugeline.sources.workspace import stage_table

FEATURES = (*SENSORS, "sensor_risk_score", "mode_risk_score")


def scored_rows(spark, sf) -> DataFrame:
    """Featured rows with a temporal split and the plain deviation score."""
    rows, _ = featured(spark, sf)
    return split.temporal_split(rows).withColumn("anomaly_score", deviation_score())


def thresholds_of(scored: DataFrame) -> dict[str, float]:
    return anomaly.operating_points(scored.filter(F.col("split") == "train"))


def flagged_rows(spark, sf) -> DataFrame:
    scored = staged_scores(spark, sf)
    return anomaly.by_operating_point(scored, thresholds_of(scored))


def summary_of(scored: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    return anomaly.operating_point_summary(scored, thresholds).drop("anomaly_threshold")


def staged_scores(spark, sf, *columns: str) -> DataFrame:
    """The split and score of every row, computed once for all that summarise them."""
    return stage_table(scored_rows(spark, sf).select("split", "anomaly_score", *columns), "scored")


def summary_table(spark, sf) -> DataFrame:
    scored = staged_scores(spark, sf)
    return summary_of(scored, thresholds_of(scored))


@query(
    "class_distribution",
    over("labelled", "SELECT class, count(*) AS row_count FROM labelled GROUP BY class ORDER BY 2 DESC, 1"),
)
def class_distribution(spark, sf):
    return reports.class_distribution(labelled(spark, sf))


@query(
    "split_summary",
    over("split_rows", "SELECT split, class, count(*) AS row_count FROM split_rows GROUP BY ALL ORDER BY 1, 2"),
)
def split_summary(spark, sf):
    return reports.split_summary(split.temporal_split(labelled(spark, sf)))


@query(
    "family_risk_distribution",
    over(
        "enriched",
        """SELECT operating_mode AS app_family, mode_risk AS family_risk, class, count(*) AS row_count
           FROM enriched GROUP BY ALL ORDER BY 4 DESC, 1, 3""",
    ),
)
def family_risk_distribution(spark, sf):
    return reports.mode_risk_distribution(featured(spark, sf)[0])


_DEVIATIONS = union_all(
    [
        f"SELECT '{c}' AS feature, coalesce(stddev_samp({c}), 0) AS std FROM telemetry"
        for c in SENSORS
    ]
    + ["SELECT 'constant', coalesce(stddev_samp(1.0::DOUBLE), 0) FROM telemetry"]
)


def _deviations(spark, sf) -> DataFrame:
    rows = telemetry(spark, sf).withColumn("constant", F.lit(1.0))
    return reports.sensor_stddev(rows, [*SENSORS, "constant"])


@query("sensor_stddev", over("telemetry", f"SELECT feature, round(std, 6) AS std FROM ({_DEVIATIONS})"))
def sensor_stddev(spark, sf):
    return _deviations(spark, sf).withColumn("std", F.round("std", 6))


@query(
    "high_variability_sensors",
    over(
        "telemetry",
        """SELECT count(*) AS high_variability_sensors FROM d
           WHERE std > (SELECT quantile_cont(std, 0.5) FROM d)""",
        d=_DEVIATIONS,
    ),
)
def high_variability_sensors(spark, sf):
    return reports.high_variability_count(_deviations(spark, sf))


_QUANTILE_COLUMNS = ("seconds", "tp2", "tp3", "h1", "reservoirs")


@query(
    "quantiles_exact",
    over(
        "telemetry",
        union_all(
            [
                f"""SELECT '{c}' AS measure, round(quantile_cont({c}, 0.6), 6) AS q60,
                           round(quantile_cont({c}, 0.8), 6) AS q80
                    FROM (SELECT *, floor(epoch("timestamp")) AS seconds FROM telemetry)"""
                for c in _QUANTILE_COLUMNS
            ]
        ),
    ),
)
def quantiles_exact(spark, sf):
    rows = telemetry(spark, sf)
    rows = rows.withColumn("seconds", epoch_seconds(rows, "timestamp"))
    asked = {c: {f"{c}_q{i}": p for i, p in enumerate(split.BOUNDARIES)} for c in _QUANTILE_COLUMNS}
    found = selection.joint_quantiles(rows, asked)
    measures = [
        F.struct(F.lit(c).alias("measure"), F.round(f"{c}_q0", 6).alias("q60"), F.round(f"{c}_q1", 6).alias("q80"))
        for c in _QUANTILE_COLUMNS
    ]
    return found.select(F.inline(F.array(*measures)))


_BY_CLASS = ("tp3", "h1", "oil_temperature")


@query(
    "quantiles_joint_by_class",
    over(
        "telemetry",
        "SELECT class, "
        + ", ".join(
            f"round(quantile_cont({c}, {p}), 6) AS {c}_q{i}" for c in _BY_CLASS for i, p in enumerate((0.05, 0.5, 0.999))
        )
        + """, count(*) AS "rows" FROM (SELECT *, CASE WHEN lps = 1 THEN NULL ELSE label END AS class FROM telemetry)
             GROUP BY class""",
    ),
)
def quantiles_joint_by_class(spark, sf):
    """Quantiles of several columns per class, rows without a class a group of their own, from shared scans."""
    rows = telemetry(spark, sf).withColumn("class", F.when(F.col("lps") == 0, F.col("label")))
    asked = {c: {f"{c}_q{i}": p for i, p in enumerate((0.05, 0.5, 0.999))} for c in _BY_CLASS}
    found = selection.joint_quantiles(rows, asked, ("class",), {"rows": F.count(F.lit(1))}, one_tile_rows=10_000)
    return found.select("class", "rows", *[F.round(name, 6).alias(name) for names in asked.values() for name in names])


@query(
    "quantiles_approx",
    "SELECT * FROM (VALUES (0.6::DOUBLE, true), (0.8::DOUBLE, true)) AS v(probability, rank_within_error)",
)
def quantiles_approx(spark, sf):
    """Whether the sketch boundaries of the time column have their rank, to a thousandth of the rows."""
    rows = telemetry(spark, sf)
    seconds = rows.select(epoch_seconds(rows, "timestamp").alias("seconds"))
    cuts = split.approx_time_boundaries(rows)
    ranks = [
        F.struct(
            F.lit(p).alias("probability"),
            (
                (F.avg((F.col("seconds") < cut).cast("double")) <= p + 0.001)
                & (F.avg((F.col("seconds") <= cut).cast("double")) >= p - 0.001)
            ).alias("rank_within_error"),
        )
        for p, cut in zip(split.BOUNDARIES, cuts, strict=True)
    ]
    return seconds.agg(F.array(*ranks).alias("rows")).select(F.inline("rows"))


@value_query
def quantiles_approx_boundaries(spark, sf):
    """The sketch boundaries of the time column, in seconds."""
    cuts = split.approx_time_boundaries(telemetry(spark, sf))
    return spark.createDataFrame([(p, float(c)) for p, c in zip(split.BOUNDARIES, cuts, strict=True)], "probability double, seconds double")


@query(
    "score_summary",
    over("summary", "SELECT * FROM summary"),
)
def score_summary(spark, sf):
    return summary_table(spark, sf)


@query(
    "quantile_threshold",
    over("points", "SELECT algorithm, round(threshold, 9) AS threshold FROM points"),
)
def quantile_threshold(spark, sf):
    rows = [(a, round(t, 9)) for a, t in thresholds_of(staged_scores(spark, sf)).items()]
    return spark.createDataFrame(rows, "algorithm STRING, threshold DOUBLE")


@query(
    "anomaly_operating_points",
    over(
        "flagged",
        """SELECT algorithm, split, sum(anomaly_flag)::BIGINT AS flagged, count(*) AS row_count
           FROM flagged GROUP BY ALL""",
    ),
)
def anomaly_operating_points(spark, sf):
    return flagged_rows(spark, sf).groupBy("algorithm", "split").agg(
        F.sum("anomaly_flag").alias("flagged"), F.count(F.lit(1)).alias("row_count")
    )


@query(
    "anomaly_scores",
    over(
        "flagged",
        """SELECT algorithm, split, anomaly_flag, round(anomaly_score, 9) AS anomaly_score, "timestamp", class
           FROM flagged""",
    ),
)
def anomaly_scores(spark, sf):
    scored = staged_scores(spark, sf, "timestamp", "class")
    exported = anomaly.anomaly_scores(scored, thresholds_of(scored))
    return exported.withColumn("anomaly_score", F.round("anomaly_score", 9))


@query(
    "model_selection",
    over(
        "summary",
        """SELECT algorithm, CASE algorithm WHEN 'isolation_forest' THEN 0.95 ELSE 0.99 END::DOUBLE AS threshold_quantile,
                  round(threshold, 9) AS threshold_value, CAST(NULL AS DOUBLE) AS cv_metric_auc,
                  'validation_score_p99' AS selection_metric, score_p99 AS selection_value
           FROM summary JOIN points USING (algorithm) WHERE split = 'validation'""",
    ),
)
def model_selection(spark, sf):
    scored = staged_scores(spark, sf)
    cuts = thresholds_of(scored)
    table = anomaly.model_selection(summary_of(scored, cuts), cuts)
    params = F.from_json("params", "threshold_quantile DOUBLE, threshold_value DOUBLE")
    return table.select(
        "algorithm",
        params["threshold_quantile"].alias("threshold_quantile"),
        F.round(params["threshold_value"], 9).alias("threshold_value"),
        "cv_metric_auc",
        "selection_metric",
        "selection_value",
    )


_TIED = """SELECT row_key, split, floor(tp3 / 1000.0::DOUBLE) AS anomaly_score,
                  CASE WHEN class = 'malware' THEN 1 ELSE 0 END AS truth FROM split_rows"""


def _tied(spark, sf) -> DataFrame:
    """A coarse score, so that many rows tie at the cut-off."""
    return split.temporal_split(labelled(spark, sf)).select(
        KEY,
        "split",
        F.floor(F.col("tp3") / 1000.0).cast("double").alias("anomaly_score"),
        labels.is_positive("class").alias("truth"),
    )


@query(
    "topk_confusion",
    over(
        "split_rows",
        """SELECT split, tp, fp, fn, round(right_rows / n, 6) AS accuracy,
                  round(2 * p * r / greatest(p + r, 1e-12), 6) AS f1, round(p, 6) AS "weightedPrecision",
                  round(r, 6) AS "weightedRecall"
           FROM (SELECT *, tp::DOUBLE / greatest(tp + fp, 1) AS p, tp::DOUBLE / greatest(tp + fn, 1) AS r
                 FROM (SELECT split, count(*)::DOUBLE AS n, count(*) FILTER (top AND truth = 1) AS tp,
                              count(*) FILTER (top AND truth = 0) AS fp,
                              count(*) FILTER (NOT top AND truth = 1) AS fn,
                              count(*) FILTER (top = (truth = 1))::DOUBLE AS right_rows
                       FROM ranked GROUP BY split))""",
        tied=_TIED,
        ranked="""SELECT split, truth, row_number() OVER (PARTITION BY split
                           ORDER BY anomaly_score DESC, substr(md5(row_key), 1, 8), row_key)
                         <= greatest(1, sum(truth) OVER (PARTITION BY split)) AS top FROM tied""",
    ),
)
def topk_confusion(spark, sf):
    return evaluate.topk_confusion(_tied(spark, sf), KEY, "truth", ("split",))


@query(
    "roc_auc",
    over(
        "split_rows",
        """SELECT split, round((sum(truth * avg_rank) - p * (p + 1) / 2.0) / (p * (n - p)), 9) AS auc
           FROM (SELECT split, truth, min_rank + (ties - 1) / 2.0::DOUBLE AS avg_rank,
                        sum(truth) OVER (PARTITION BY split)::DOUBLE AS p,
                        count(*) OVER (PARTITION BY split)::DOUBLE AS n
                 FROM (SELECT *, rank() OVER (PARTITION BY split ORDER BY anomaly_score) AS min_rank,
                              count(*) OVER (PARTITION BY split, anomaly_score) AS ties FROM tied))
           GROUP BY split, p, n""",
        tied=_TIED,
    ),
)
def roc_auc(spark, sf):
    return evaluate.roc_auc(_tied(spark, sf), "truth", ("split",)).withColumn("auc", F.round("auc", 9))


_INFLUENCE = union_all(
    [
        f"""SELECT '{c}' AS feature, coalesce(abs(covar_pop(coalesce({c}, 0), anomaly_score)
                   / nullif(stddev_pop(coalesce({c}, 0)) * stddev_pop(anomaly_score), 0)), 0) AS importance
            FROM scored WHERE split = 'validation'"""
        for c in FEATURES
    ]
    + ["SELECT 'constant', 0.0"]
)


def _influence(spark, sf) -> DataFrame:
    scored = scored_rows(spark, sf).withColumn("constant", F.lit(1.0)).filter(F.col("split") == "validation")
    return evaluate.feature_influence(scored, [*FEATURES, "constant"], list(anomaly.OPERATING_POINTS))


INFLUENCE_SQL = f"""SELECT algorithm, feature, round(importance, 8) AS importance
    FROM ({_INFLUENCE}) CROSS JOIN (SELECT unnest(['isolation_forest', 'isolation_forest_strict']) AS algorithm)"""


@query("feature_influence", over("scored", f"SELECT algorithm, feature, round(importance, 7) AS importance FROM ({INFLUENCE_SQL})"))
def feature_influence(spark, sf):
    return _influence(spark, sf).withColumn("importance", F.round("importance", 7))


@query(
    "mean_test_rate",
    over("summary", "SELECT round(avg(anomaly_rate), 6) AS mean_test_rate FROM summary WHERE split = 'test'"),
)
def mean_test_rate(spark, sf):
    return reports.mean_test_rate(summary_table(spark, sf)).withColumn(
        "mean_test_rate", F.round("mean_test_rate", 6)
    )


@query(
    "business_insights",
    over(
        "summary",
        f"""SELECT 'estimated_anomaly_rate' AS insight, round(avg(anomaly_rate), 6) AS value,
                   CASE WHEN avg(anomaly_rate) >= 0.05 THEN 'Increase alert review staffing'
                        ELSE 'Maintain current monitoring cadence' END AS recommendation
            FROM summary WHERE split = 'test'
            UNION ALL
            SELECT 'high_variability_sensor_count', count(*)::DOUBLE,
                   'Review sensors with high variability for drift and calibration'
            FROM d WHERE std > (SELECT quantile_cont(std, 0.5) FROM d)""",
        d=_DEVIATIONS,
    ),
)
def business_insights(spark, sf):
    return reports.business_insights(summary_table(spark, sf), _deviations(spark, sf))


@query(
    "business_alignment",
    over(
        "summary",
        """SELECT algorithm, split, CAST(NULL AS BIGINT) AS tp, CAST(NULL AS BIGINT) AS fp, CAST(NULL AS BIGINT) AS fn,
                  round(round_even("rows" * anomaly_rate, 0) * -8.0, 2)::DOUBLE AS expected_profit_usd,
                  'Each anomaly alert review costs $8.00' AS assumption
           FROM summary WHERE split = 'test'""",
    ),
)
def business_alignment(spark, sf):
    return reports.business_alignment(summary_table(spark, sf))


@query(
    "topk_by_score",
    over(
        "labelled",
        """SELECT row_key, tp2 AS score FROM (
             SELECT *, row_number() OVER (ORDER BY tp2 DESC, substr(md5(row_key), 1, 8), row_key) AS place FROM labelled)
           WHERE place <= (SELECT count(*) FROM labelled WHERE class = 'malware')""",
    ),
)
def topk_by_score(spark, sf):
    """As many rows as there are positives, by a score with 50 distinct values."""
    rows = labelled(spark, sf)
    positives = rows.filter(F.col("class") == labels.POSITIVE).count()
    return selection.top_k(rows.select(KEY, F.col("tp2").alias("score")), "score", positives, KEY)


@query(
    "classification_metrics",
    over(
        "labelled",
        """SELECT round(avg((y = p)::INT), 6) AS accuracy,
                  round(2 * pr * re / greatest(pr + re, 1e-12), 6) AS f1, round(pr, 6) AS "precision", round(re, 6) AS recall,
                  round((pr * pos + pr0 * neg) / (pos + neg), 6) AS "weightedPrecision",
                  round((re * pos + re0 * neg) / (pos + neg), 6) AS "weightedRecall",
                  round((f1p * pos + f1n * neg) / (pos + neg), 6) AS "weightedF1"
           FROM predicted, (
             SELECT *, 2 * pr * re / greatest(pr + re, 1e-12) AS f1p, 2 * pr0 * re0 / greatest(pr0 + re0, 1e-12) AS f1n
             FROM (SELECT sum(y * p)::DOUBLE / sum(p) AS pr, sum(y * p)::DOUBLE / sum(y) AS re,
                          sum((1 - y) * (1 - p))::DOUBLE / sum(1 - p) AS pr0,
                          sum((1 - y) * (1 - p))::DOUBLE / sum(1 - y) AS re0,
                          sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM predicted))
           GROUP BY pr, re, pr0, re0, pos, neg, f1p, f1n""",
        predicted="""SELECT CASE WHEN class = 'malware' THEN 1 ELSE 0 END AS y,
                            CASE WHEN reservoirs > 25 THEN 1 ELSE 0 END AS p FROM labelled""",
    ),
)
def classification_metrics(spark, sf):
    predictions = labelled(spark, sf).select(
        labels.is_positive("class").alias("label"),
        (F.col("reservoirs") > 25).cast("int").alias("prediction"),
    )
    return evaluate.classifier_metrics(evaluate.confusion(predictions))


_STD = ("tp2", "tp3", "h1", "constant")


@query(
    "standardize",
    over(
        "telemetry",
        union_all(
            [
                f"""SELECT '{c}' AS feature, round(avg(z), 6) + 0.0 AS average, round(stddev_pop(z), 6) AS deviation,
                           round(min(z), 6) AS lowest, round(max(z), 6) AS highest
                    FROM (SELECT ({c} - (SELECT avg({c}) FROM wide))
                                 / coalesce(nullif((SELECT stddev_pop({c}) FROM wide), 0), 1) AS z FROM wide)"""
                for c in _STD
            ]
        ),
        wide="SELECT *, 1.0::DOUBLE AS constant FROM telemetry",
    ),
)
def standardize(spark, sf):
    rows = telemetry(spark, sf).withColumn("constant", F.lit(1.0)).select(*_STD)
    scaled = features.fit_scaling(rows, _STD).apply(rows)
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            (F.round(F.avg(c), 6) + 0.0).alias("average"),
            F.round(F.stddev_pop(c), 6).alias("deviation"),
            F.round(F.min(c), 6).alias("lowest"),
            F.round(F.max(c), 6).alias("highest"),
        )
        for c in _STD
    ]
    return scaled.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))


_NULL_GROUPS = """SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS class,
                         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS truth,
                         abs(l_extendedprice - 38000.0::DOUBLE) / 20000.0::DOUBLE AS anomaly_score FROM lineitem"""


@query(
    "null_group_scores",
    f"""WITH judged AS ({_NULL_GROUPS}),
             ranked AS (SELECT *, rank() OVER (PARTITION BY class ORDER BY anomaly_score)
                               + (count(*) OVER (PARTITION BY class, anomaly_score) - 1) / 2.0 AS place FROM judged)
        SELECT class, count(*) AS "rows", round(avg(truth), 6) AS fault_rate,
               round(avg(anomaly_score), 6) AS score_mean, round(stddev_pop(anomaly_score), 6) AS score_std,
               round(quantile_cont(anomaly_score, 0.95), 6) AS score_p95,
               round(quantile_cont(anomaly_score, 0.99), 6) AS score_p99,
               round((sum(place) FILTER (truth = 1) - sum(truth) * (sum(truth) + 1) / 2.0)
                     / nullif(sum(truth) * (count(*) - sum(truth)), 0), 6) AS auc
        FROM ranked GROUP BY class""",
)
def null_group_scores(spark, sf):
    """Score summary and AUC by class where rows without a class are a group of their own."""
    rows = lineitem(spark, sf)
    judged = rows.select(
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("class"),
        (F.col("l_linestatus") == "F").cast("int").alias("truth"),
        (F.abs(F.col("l_extendedprice") - F.lit(38000.0)) / F.lit(20000.0)).alias("anomaly_score"),
    )
    summary = evaluate.score_summary(judged, ("class",), rates={"fault_rate": F.col("truth")})
    auc = evaluate.roc_auc(judged, "truth", ("class",)).withColumn("auc", F.round("auc", 6))
    return selection.join_groups(summary, auc, ("class",))
