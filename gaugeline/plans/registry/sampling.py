"""Splits, samples, folds, replication and the bootstrap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.operators import evaluate, split
from gaugeline.operators.anomaly import anomaly_flag
from gaugeline.operators.evaluate import poisson_limits
from gaugeline.plans.registry.base import over, query
from gaugeline.plans.telemetry import KEY, labelled, telemetry


def _word(salted_key: str, word: int = 0) -> str:
    return f"('0x' || substr(md5({salted_key}), {1 + 8 * word}, 8))::BIGINT"


def _summary(df: DataFrame, *dims: str) -> DataFrame:
    return df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("tp2").alias("total"), F.min(KEY).alias("first_key")
    )


_SUMMARY = "count(*) AS row_count, sum(tp2) AS total, min(row_key) AS first_key"


@query("temporal_split", over("split_rows", f"SELECT split, {_SUMMARY} FROM split_rows GROUP BY split"))
def temporal_split(spark, sf):
    return _summary(split.temporal_split(labelled(spark, sf)), "split")


_CUT = "CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'validation' ELSE 'test' END"


@query(
    "stratified_split",
    over(
        "labelled",
        f"""SELECT class, {_CUT} AS split, {_SUMMARY}
            FROM (SELECT *, {_word("row_key || '|' || class || '|42'")} / 4294967296.0::DOUBLE AS u FROM labelled)
            GROUP BY ALL""",
    ),
)
def stratified_split(spark, sf):
    return _summary(split.stratified_split(labelled(spark, sf), KEY), "class", "split")


@query(
    "random_split",
    over(
        "labelled",
        f"""SELECT 'three draws' AS kind, {_CUT} AS split, {_SUMMARY}
            FROM (SELECT *, {_word("row_key || '|42'")} / 4294967296.0::DOUBLE AS u FROM labelled) GROUP BY ALL
            UNION ALL
            SELECT 'tiny', CASE WHEN u < 0.64 THEN 'train' WHEN u < 0.8 THEN 'validation' ELSE 'test' END, {_SUMMARY}
            FROM (SELECT *, {_word("row_key || '|42'")} / 4294967296.0::DOUBLE AS u FROM labelled) GROUP BY ALL""",
    ),
)
def random_split(spark, sf):
    rows = labelled(spark, sf)
    drawn = _summary(split.random_split(rows, KEY), "split").withColumn("kind", F.lit("three draws"))
    tiny = _summary(split.tiny_split(rows, KEY), "split").withColumn("kind", F.lit("tiny"))
    return drawn.unionByName(tiny)


@query(
    "capped_sample",
    over(
        "telemetry",
        f"""SELECT row_key, tp2 FROM (
              SELECT row_key, tp2, word, (SELECT count(*) FROM telemetry) AS n
              FROM (SELECT row_key, tp2, {_word("row_key || '|42'")} AS word FROM telemetry))
            WHERE n <= 5000 OR word / 4294967296.0::DOUBLE < 5000 / n::DOUBLE
            ORDER BY CASE WHEN n <= 5000 THEN 0 ELSE word END, row_key
            LIMIT (SELECT greatest(5000, CASE WHEN count(*) <= 5000 THEN count(*) ELSE 0 END) FROM telemetry)""",
    ),
)
def capped_sample(spark, sf):
    return split.capped_sample(telemetry(spark, sf).select(KEY, "tp2"), KEY, 5000)


@query(
    "fraction_sample",
    over(
        "labelled",
        f"""SELECT class, {_SUMMARY} FROM (
              SELECT *, (SELECT count(*) FROM labelled) AS n, {_word("row_key || '|42'")} / 4294967296.0::DOUBLE AS u
              FROM labelled)
            WHERE n <= 25000 OR u < 25000 / n::DOUBLE GROUP BY class""",
    ),
)
def fraction_sample(spark, sf):
    return _summary(split.fraction_sample(labelled(spark, sf), KEY, 25_000), "class")


@query(
    "replicate_rows",
    over(
        "labelled",
        """SELECT copies, class, count(*) * copies AS row_count, sum(tp2) * copies AS total
           FROM labelled CROSS JOIN (SELECT unnest([1, 2, 3]) AS copies) GROUP BY copies, class""",
    ),
)
def replicate_rows(spark, sf):
    rows = labelled(spark, sf)
    parts = [
        split.replicate_rows(rows, k)
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("tp2").alias("total"))
        .withColumn("copies", F.lit(k))
        for k in (1, 2, 3)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "stratified_folds",
    over(
        "labelled",
        f"""SELECT class, ({_word("row_key || '|' || class || '|42'")} % 5)::INTEGER AS fold, {_SUMMARY}
            FROM labelled GROUP BY ALL""",
    ),
)
def stratified_folds(spark, sf):
    return _summary(split.stratified_folds(labelled(spark, sf), KEY, 5), "class", "fold")


_ITERATIONS = 20
_LIMITS = poisson_limits()
_WEIGHT = "CASE " + " ".join(
    f"WHEN drawn < '{limit:08x}' THEN {w}" for w, limit in enumerate(_LIMITS)
) + f" ELSE {len(_LIMITS)} END"


@query(
    "bootstrap_ci",
    over(
        "labelled",
        f"""SELECT class, metric, round(quantile_cont(mean, 0.025), 6) AS ci_lower_95,
                   round(quantile_cont(mean, 0.975), 6) AS ci_upper_95,
                   count(*) AS bootstrap_iterations, max(n) AS sample_rows
            FROM (SELECT class, metric, b, sum(w * x)::DOUBLE / sum(w) AS mean, count(*) AS n
                  FROM (SELECT class, b, {_WEIGHT} AS w, unnest([flag::DOUBLE, tp2]) AS x,
                               unnest(['flag_rate', 'mean_tp2']) AS metric FROM drawn)
                  GROUP BY ALL)
            GROUP BY ALL""",
        drawn=f"""SELECT *, substr(md5(row_key || '|42|' || (b // 4)), 1 + 8 * (b % 4), 8) AS drawn
                  FROM (SELECT *, CASE WHEN tp3 >= 60000.0 THEN 1 ELSE 0 END AS flag FROM labelled)
                       CROSS JOIN (SELECT unnest(range({_ITERATIONS})) AS b)""",
    ),
)
def bootstrap_ci(spark, sf):
    metrics = {"flag_rate": anomaly_flag("tp3", 60000.0), "mean_tp2": F.col("tp2")}
    return evaluate.bootstrap_intervals(labelled(spark, sf), metrics, ("class",), KEY, _ITERATIONS)
