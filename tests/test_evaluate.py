import hashlib
import math
from functools import partial

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from gaugeline.operators import anomaly, evaluate, reports
from gaugeline.operators.selection import counts_below


def scored(spark, n=400, groups=1, seed=0, coarse=False):
    rng = np.random.default_rng(seed)
    truth = rng.integers(0, 2, n)
    score = rng.normal(size=n) + truth
    score = np.round(score) if coarse else score
    rows = [(f"k{i}", f"s{i % groups}", float(s), int(t)) for i, (s, t) in enumerate(zip(score, truth))]
    return spark.createDataFrame(rows, "key string, split string, anomaly_score double, truth int"), score, truth


@pytest.mark.parametrize("coarse", [False, True])
@pytest.mark.parametrize("limit", [1_000_000, 30])
def test_auc_equals_the_mllib_evaluator(spark, coarse, limit, monkeypatch):
    monkeypatch.setattr(evaluate, "counts_below", partial(counts_below, one_tile_rows=limit))
    df, _, _ = scored(spark, coarse=coarse)
    mine = evaluate.roc_auc(df, "truth").first()["auc"]
    theirs = BinaryClassificationEvaluator(
        rawPredictionCol="anomaly_score", labelCol="truth", numBins=0
    ).evaluate(df.withColumn("truth", F.col("truth").cast("double")))
    assert mine == pytest.approx(theirs, abs=1e-12)


def test_auc_is_null_with_one_label(spark):
    df, _, _ = scored(spark)
    assert evaluate.roc_auc(df.filter("truth = 1"), "truth", ("split",)).first()["auc"] is None


def test_topk_confusion(spark):
    df, score, truth = scored(spark)
    k = truth.sum()
    top = np.zeros(len(score), int)
    top[np.argsort(score)[-k:]] = 1
    row = evaluate.topk_confusion(df, "key", "truth", ("split",)).first()
    tp = int((top & truth).sum())
    assert (row["tp"], row["fp"], row["fn"]) == (tp, k - tp, k - tp)
    assert row["weightedPrecision"] == round(tp / k, 6)
    assert row["accuracy"] == pytest.approx((top == truth).mean(), abs=1e-6)


def test_topk_confusion_needs_both_labels(spark):
    df, _, _ = scored(spark, groups=2)
    one_sided = df.filter("truth = 1 or split = 's0'")
    rows = {r["split"]: r for r in evaluate.topk_confusion(one_sided, "key", "truth", ("split",)).collect()}
    assert rows["s0"]["f1"] is not None
    assert rows["s1"]["f1"] is None and rows["s1"]["tp"] is None


def test_summary_matches_numpy(spark):
    df, score, _ = scored(spark)
    row = evaluate.score_summary(df.withColumn("anomaly_flag", anomaly.anomaly_flag("anomaly_score", 1.0)), ("split",)).first()
    assert row["rows"] == 400
    assert row["anomaly_rate"] == pytest.approx((score >= 1.0).mean(), abs=1e-6)
    assert row["score_std"] == pytest.approx(score.std(), abs=1e-6)
    assert row["score_p99"] == pytest.approx(np.percentile(score, 99), abs=1e-6)


def test_operating_points_share_one_set_of_scores(spark):
    df, score, _ = scored(spark, n=2000)
    cuts = anomaly.operating_points(df)
    assert cuts["isolation_forest"] == pytest.approx(np.quantile(score, 0.95))
    summary = anomaly.operating_point_summary(df, cuts)
    rates = {r["algorithm"]: r["anomaly_rate"] for r in summary.collect()}
    assert rates == {"isolation_forest": pytest.approx(0.05, abs=1e-3), "isolation_forest_strict": pytest.approx(0.01, abs=1e-3)}
    long = evaluate.score_summary(anomaly.by_operating_point(df, cuts))
    common = ["algorithm", "split", "rows", "anomaly_rate", "score_mean", "score_p95"]
    assert sorted(map(tuple, long.select(common).collect())) == sorted(map(tuple, summary.select(common).collect()))


def test_feature_influence(spark):
    df, score, _ = scored(spark)
    wide = df.withColumns({"same": -F.col("anomaly_score"), "flat": F.lit(1.0), "gone": F.lit(None).cast("double")})
    rows = evaluate.feature_influence(wide, ["flat", "gone", "truth", "same"], ["b", "a"]).collect()
    assert [r["algorithm"] for r in rows] == ["a"] * 4 + ["b"] * 4
    assert [r["feature"] for r in rows[:4]] == ["same", "truth", "flat", "gone"]
    assert rows[0]["importance"] == 1.0 and rows[2]["importance"] == 0.0


def test_influence_is_zero_for_a_constant_score(spark):
    df, _, _ = scored(spark)
    rows = evaluate.feature_influence(df.withColumn("anomaly_score", F.lit(0.5)), ["truth"], ["a"]).collect()
    assert rows[0]["importance"] == 0.0


def test_bootstrap_interval_covers_the_mean_and_repeats(spark):
    df, score, _ = scored(spark, n=3000)
    metrics = {"score_mean": F.col("anomaly_score")}
    first = evaluate.bootstrap_intervals(df, metrics, ("split",), "key", 101).first()
    again = evaluate.bootstrap_intervals(df.repartition(7), metrics, ("split",), "key", 101).first()
    assert (first["bootstrap_iterations"], first["sample_rows"]) == (101, 3000)
    assert first["ci_lower_95"] < score.mean() < first["ci_upper_95"]
    width = first["ci_upper_95"] - first["ci_lower_95"]
    assert width == pytest.approx(2 * 1.96 * score.std() / math.sqrt(3000), rel=0.35)
    assert (again["ci_lower_95"], again["ci_upper_95"]) == (first["ci_lower_95"], first["ci_upper_95"])


@pytest.mark.parametrize("held", [4096, 1])
def test_bootstrap_matches_its_definition(spark, monkeypatch, held):
    """Weights of every row and replicate by plain md5; null metrics add nothing, a null group is a group."""
    monkeypatch.setattr(evaluate, "GROUPS_HELD", held)
    rng = np.random.default_rng(9)
    rows = [(None if i % 50 == 0 else f"k{i}", None if i % 3 == 0 else f"g{i % 2}", None if i % 7 == 0 else float(x), None) for i, x in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(rows, "key string, g string, x double, y double").repartition(6)
    found = evaluate.bootstrap_intervals(df, {"x": F.col("x"), "y": F.col("y")}, ("g",), "key", 30, 42)
    limits = [int(p * 2**32) for p in evaluate.POISSON_CDF]
    for r in found.collect():
        mine = [row for row in rows if row[1] == r["g"]]
        means = []
        for b in range(30):
            weights = []
            for key, *_ in mine:
                salted = "|".join([*([] if key is None else [key]), "42", str(b // 4)])
                word = int(hashlib.md5(salted.encode()).hexdigest()[8 * (b % 4) : 8 * (b % 4) + 8], 16)
                weights.append(sum(word >= limit for limit in limits))
            means.append(sum(w * (row[2] or 0.0) for w, row in zip(weights, mine, strict=True)) / sum(weights))
        assert r["sample_rows"] == len(mine)
        if r["metric"] == "y":
            assert r["ci_lower_95"] is None
        else:
            assert [r["ci_lower_95"], r["ci_upper_95"]] == pytest.approx(np.quantile(means, [0.025, 0.975]).tolist(), abs=1e-6)
    assert found.count() == 6


def test_bootstrap_of_nothing(spark):
    df = spark.createDataFrame([], "key string, g string, x double")
    assert evaluate.bootstrap_intervals(df, {"x": F.col("x")}, ("g",), "key", 8).count() == 0


def test_classifier_metrics(spark):
    pairs = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 9
    df = spark.createDataFrame(pairs, "label int, prediction int")
    row = evaluate.classifier_metrics(evaluate.confusion(df)).first()
    p1, r1, p0, r0 = 6 / 9, 6 / 8, 9 / 11, 9 / 12
    assert row["accuracy"] == 0.75
    assert row["precision"] == round(p1, 6) and row["recall"] == r1
    assert row["weightedPrecision"] == round((p1 * 8 + p0 * 12) / 20, 6)
    assert row["weightedRecall"] == round((r1 * 8 + r0 * 12) / 20, 6)


def test_metrics_of_a_classifier_that_never_says_yes(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = evaluate.classifier_metrics(evaluate.confusion(df)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


# -- reports ------------------------------------------------------------------------------------


def summary(spark, rates):
    rows = [(a, "test", 303208, r) for a, r in rates.items()] + [("x", "train", 10, 0.9)]
    return spark.createDataFrame(rows, "algorithm string, split string, rows long, anomaly_rate double")


def test_business_tables_give_the_published_numbers(spark):
    table = summary(spark, {"isolation_forest": 0.066288, "isolation_forest_strict": 0.013885})
    deviations = spark.createDataFrame([(f"f{i}", float(i)) for i in range(16)], "feature string, std double")
    rows = reports.business_insights(table, deviations).collect()
    assert rows[0]["value"] == pytest.approx(0.040086, abs=1.1e-6)
    assert rows[0]["recommendation"].startswith("Maintain") and rows[1]["value"] == 8.0
    profits = {r["algorithm"]: r["expected_profit_usd"] for r in reports.business_alignment(table).collect()}
    assert profits == {"isolation_forest": -160792.0, "isolation_forest_strict": -33680.0}


def test_missing_rate_costs_nothing(spark):
    table = summary(spark, {"supervised": None, "isolation_forest": 0.5})
    rows = {r["algorithm"]: r for r in reports.business_alignment(table).collect()}
    assert rows["supervised"]["expected_profit_usd"] == 0.0
    assert reports.mean_test_rate(table).first()[0] == 0.5


def test_deviation_of_one_row_is_zero(spark):
    row = reports.sensor_stddev(spark.createDataFrame([(1.0,)], "a double"), ["a"]).first()
    assert tuple(row) == ("a", 0.0)


def test_dashboard_operators(spark):
    df = spark.createDataFrame(
        [("a", "p", 1.0), ("a", "q", 2.0), ("b", "p", 5.0), (None, "p", 7.0)], "m string, d string, v double"
    )
    assert [tuple(r) for r in reports.top_n(df, "m", "v", 2).collect()] == [(None, 7.0, 7.0), ("b", 5.0, 5.0)]
    assert [r["m"] for r in reports.sorted_measure(df.dropna(), "m", "v").collect()] == ["b", "a"]
    fixed = {(r["m"], r["d"]): r["x"] for r in reports.fixed_lod(df, "m", F.avg("v"), "x").collect()}
    assert fixed == {("a", "p"): 1.5, ("a", "q"): 1.5, ("b", "p"): 5.0, (None, "p"): 7.0}
    nothing = spark.createDataFrame([(None, 1.0), (None, 2.0)], "tp long, v double")
    assert tuple(reports.kpi_totals(nothing, ["tp", "v"]).first()) == (None, 3.0)
    with pytest.raises(ValueError):
        reports.metric_selector(df, "nope")


def test_histogram_keeps_every_row(spark):
    df, _, _ = scored(spark)
    bins = reports.score_histogram(df, ["a"], 10)
    assert bins.agg(F.sum("row_count"), F.min("bin"), F.max("bin")).first()[0:3] == (400, 0, 9)
    flat = reports.score_histogram(df.select(F.lit(1.0).alias("anomaly_score")), ["a"], 10)
    assert [(r["bin"], r["row_count"]) for r in flat.collect()] == [(0, 400)]


def monthly(spark, values, parts=6):
    rows = [(None if i % 10 == 0 else f"2020-0{1 + i % 4}-11 00:00:00", None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "t string, anomaly_score double").withColumn("timestamp", F.col("t").cast("timestamp")).repartition(parts)


@pytest.mark.parametrize("held", [4096, 32])
@pytest.mark.parametrize("shape", ["wide", "far from zero", "one value", "negative"])
def test_bins_widen_and_merge_to_exact_counts(spark, monkeypatch, held, shape):
    monkeypatch.setattr(reports, "BINS_HELD", held)
    rng = np.random.default_rng(8)
    values = {"wide": np.exp(rng.normal(size=900) * 4), "far from zero": 1e9 + rng.normal(size=900), "one value": np.full(900, 2.5), "negative": -rng.exponential(size=900)}[shape]
    values = [None if i % 17 == 0 else v for i, v in enumerate(values)]
    cuts = {"a": 1.0, "b": float(np.median([v for v in values if v is not None]))}
    df = monthly(spark, values)
    histogram, trend = reports.score_reports(df, cuts)
    present = [v for v in values if v is not None]
    level = reports.width_level(min(present), max(present), 20)
    want = {}
    for i, v in enumerate(values):
        if v is not None:
            key = (None if i % 10 == 0 else f"2020-0{1 + i % 4}-01 00:00:00", math.floor(math.ldexp(v, -level)))
            want[key] = want.get(key, 0) + 1
    rows = histogram.collect()
    assert {(r["period"], r["bin"]): r["row_count"] for r in rows} == want
    assert all(r["bin_start"] == math.ldexp(r["bin"], level) for r in rows)
    assert len({b for _, b in want}) <= 22
    columns = ["period", "mean_score", "row_count", "algorithm", "flagged"]
    known = reports.score_trend(df, cuts).select(*columns)
    shown = lambda frame: sorted(map(repr, (tuple(round(x, 4) if isinstance(x, float) else x for x in r) for r in frame.collect())))
    assert shown(trend.select(*columns)) == shown(known)


def test_reports_of_nothing(spark):
    histogram, trend = reports.score_reports(monthly(spark, [None] * 4), {"a": 1.0})
    assert histogram.count() == 0 and sum(r["row_count"] for r in trend.collect()) == 4
