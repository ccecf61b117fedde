from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from gaugeline.functions import binned, trees
from gaugeline.operators import anomaly, grown, logistic, supervised
from gaugeline.operators.split import stratified_folds
from tests.conftest import plan_of


@pytest.mark.parametrize("name", ["train_lr_metrics", "cv_grid_search_metrics", "isolation_forest_values", "quantiles_approx_boundaries"])
def test_value_queries(spark, sf_dir, name):
    from gaugeline.plans.registry import VALUE_QUERIES

    found = VALUE_QUERIES[name](spark, sf_dir)
    rows = found.collect()
    if name == "train_lr_metrics":
        assert len(rows) == 1 and rows[0].split == "test" and 0.9 <= rows[0].accuracy <= 1 and 0.5 < rows[0].auc <= 1
    elif name == "cv_grid_search_metrics":
        assert [r.candidate for r in rows] == [0, 1, 2, 3] and all(0.5 < r.cv_metric_auc <= 1 for r in rows)
    elif name == "isolation_forest_values":
        assert len(rows) == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() and len({r.anomaly_score for r in rows}) > 100
        assert {r.isolation_forest for r in rows} == {0, 1}
    else:
        assert [r.probability for r in rows] == [0.6, 0.8] and rows[0].seconds < rows[1].seconds
    assert len({*VALUE_QUERIES}) == 7


def cloud(spark, n, outliers=5, parts=3):
    """Two sensors around zero, with a few rows far away."""
    base = spark.range(0, n, 1, parts).select(
        F.concat(F.lit("k"), "id").alias("key"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 500.0 - 1).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)) / 500.0 - 1).alias("b"),
    )
    far = spark.range(outliers).select(
        F.concat(F.lit("far"), "id").alias("key"), (F.col("id") * 3 + 100.0).alias("a"), F.lit(-90.0).alias("b")
    )
    return base.unionByName(far)


def test_mean_unsuccessful_search():
    assert [trees.mean_unsuccessful_search(m) for m in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert trees.mean_unsuccessful_search(256) == pytest.approx(10.244770920, abs=1e-6)


def walk(tree, row):
    """Path length by following one tree with plain Python."""
    feature, threshold, path = tree
    node = 0
    while node < len(feature):
        node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
    return path[node - len(feature)]


def test_batch_path_lengths_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4))
    forest = [trees.grow_tree(x[rng.choice(300, 64, False)], 6, rng) for _ in range(9)]
    stacked = [np.array([t[i] for t in forest]) for i in range(3)]
    expected = [np.mean([walk(t, row) for t in forest]) for row in x]
    assert np.allclose(trees.mean_path_lengths(x, *stacked), expected)


def test_tree_isolates_every_distinct_row_or_stops_at_the_depth_limit():
    x = np.arange(8.0).reshape(-1, 1)
    feature, threshold, path = trees.grow_tree(x, 7, np.random.default_rng(0))
    lengths = trees.mean_path_lengths(x, feature[None], threshold[None], path[None])
    assert (lengths >= 1).all() and (lengths <= 7).all()


def test_constant_sample_is_one_leaf():
    tree = trees.grow_tree(np.ones((10, 2)), 4, np.random.default_rng(0))
    assert walk(tree, [1.0, 1.0]) == walk(tree, [9.0, -9.0]) == trees.mean_unsuccessful_search(10)


@pytest.mark.parametrize("n", [60, 900])
def test_outliers_rank_on_top_and_scores_stay_in_range(spark, n):
    df = cloud(spark, n)
    forest = anomaly.fit_isolation_forest(df, ["a", "b"], "key", trees=40, sample_rows=64)
    rows = forest.score(df).collect()
    assert len(rows) == n + 5
    assert all(-0.5 < r["anomaly_score"] < 0.5 for r in rows)
    best = sorted(rows, key=lambda r: -r["anomaly_score"])[:5]
    assert {r["key"] for r in best} == {f"far{i}" for i in range(5)}


def test_forest_does_not_depend_on_partitioning(spark):
    few, many = cloud(spark, 5000, parts=1), cloud(spark, 5000, parts=7).repartition(11)
    fit = [anomaly.fit_isolation_forest(df, ["a", "b"], "key", trees=20, sample_rows=32) for df in (few, many)]
    assert np.array_equal(fit[0].threshold, fit[1].threshold)
    assert np.array_equal(fit[0].path, fit[1].path)
    assert np.isfinite(fit[0].threshold).any()


def test_large_tables_give_each_drawn_row_to_one_tree(spark):
    df = cloud(spark, 5000, outliers=0)
    samples = anomaly.forest_samples(df, ["a", "b"], "key", 10, 64, 42)
    assert samples.count() == samples.select("_key").distinct().count()
    sizes = [r["count"] for r in samples.groupBy("tree").count().collect()]
    assert sizes == [64] * 10


def test_copies_of_a_row_cannot_fill_a_tree(spark):
    copies = spark.range(3000).select(F.lit("same").alias("key"), F.lit(1.0).alias("a"), F.lit(1.0).alias("b"))
    df = cloud(spark, 6000, outliers=0).unionByName(copies)
    samples = anomaly.forest_samples(df, ["a", "b"], "key", 10, 64, 42)
    assert samples.filter("_key = 'same'").count() <= 1


def test_null_features_count_as_zero(spark):
    df = cloud(spark, 300)
    forest = anomaly.fit_isolation_forest(df, ["a", "b"], "key", trees=10, sample_rows=32)
    pair = spark.createDataFrame([("x", None, 0.0), ("y", 0.0, 0.0)], "key string, a double, b double")
    first, second = [r["anomaly_score"] for r in forest.score(pair).collect()]
    assert first == second


def test_forest_saves_and_loads(spark, tmp_path):
    df = cloud(spark, 300)
    forest = anomaly.fit_isolation_forest(df, ["a", "b"], "key", trees=10, sample_rows=32)
    forest.save(spark, str(tmp_path / "f"))
    again = anomaly.IsolationForest.load(spark, str(tmp_path / "f"))
    scores = [{r["key"]: r["anomaly_score"] for r in f.score(df).collect()} for f in (forest, again)]
    assert scores[0] == scores[1]
    assert again.columns == ["a", "b"]


def test_saved_forest_flags_new_rows_by_its_thresholds(spark, tmp_path):
    df = cloud(spark, 300)
    forest = anomaly.fit_isolation_forest(df, ["a", "b"], "key", trees=10, sample_rows=32)
    kept = replace(forest, cuts=anomaly.operating_points(forest.score(df)))
    kept.save(spark, str(tmp_path / "f"))
    again = anomaly.IsolationForest.load(spark, str(tmp_path / "f"))
    assert again.cuts == kept.cuts and list(again.sample_rows) == [32] * 10
    flagged = again.flag(df).agg(*[F.sum(name) for name in anomaly.OPERATING_POINTS]).first()
    assert 0 < flagged[1] <= flagged[0] < 40


@pytest.mark.parametrize("n", [40, 3000])
def test_repeated_keys_leave_scores_alike(spark, n):
    df = cloud(spark, n)
    copies = df.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("_c")
    fit = [anomaly.fit_isolation_forest(x, ["a", "b"], "key", trees=30, sample_rows=64) for x in (df, copies)]
    scores = [{r["key"]: r["anomaly_score"] for r in f.score(df).collect()} for f in fit]
    assert max(abs(scores[0][k] - scores[1][k]) for k in scores[0]) < 0.02
    assert min(fit[1].sample_rows) == min(64, n + 5)


def test_every_tree_of_a_tiny_table_gets_every_row(spark):
    samples = anomaly.forest_samples(cloud(spark, 20, outliers=0), ["a", "b"], "key", 12, 64, 42)
    assert {r["count"] for r in samples.groupBy("tree").count().collect()} == {20}
    assert samples.select("tree").distinct().count() == 12


@pytest.mark.parametrize("n", [70, 300, 4000])
def test_samples_are_exact_and_do_not_depend_on_tasks(spark, n):
    """Every tree gets as many rows as wanted, the same from one task and from many."""
    few, many = cloud(spark, n, outliers=0, parts=1), cloud(spark, n, outliers=0).repartition(40)
    copies = many.unionByName(many)
    drawn = [
        sorted(tuple(r) for r in anomaly.forest_samples(df, ["a", "b"], "key", 20, 64, 42).select("tree", "_order", "_key").collect())
        for df in (few, many, copies)
    ]
    assert drawn[0] == drawn[1] == drawn[2] and len(drawn[0]) == 20 * 64
    assert len({(t, k) for t, _, k in drawn[0]}) == 20 * 64


def test_all_rows_are_equally_likely_in_all_trees(spark):
    samples = anomaly.forest_samples(cloud(spark, 400, outliers=0), ["a", "b"], "key", 100, 64, 42)
    per_key = np.array([r["count"] for r in samples.groupBy("_key").count().collect()])
    assert len(per_key) == 400 and per_key.sum() == 6400
    assert 6 < per_key.min() and per_key.max() < 30  # 16 on average


def test_empty_training_table_is_an_error(spark):
    with pytest.raises(ValueError):
        anomaly.fit_isolation_forest(cloud(spark, 10).limit(0), ["a", "b"], "key")


def test_model_selection_reads_the_validation_split(spark):
    rows = [("isolation_forest", "train", 0.1), ("isolation_forest", "validation", 0.2),
            ("isolation_forest_strict", "validation", 0.3)]
    summary = spark.createDataFrame(rows, "algorithm string, split string, score_p99 double")
    cuts = {"isolation_forest": 0.5, "isolation_forest_strict": 0.75}
    found = {r["algorithm"]: (r["params"], r["selection_value"]) for r in anomaly.model_selection(summary, cuts).collect()}
    assert found == {
        "isolation_forest": ('{"threshold_quantile":0.95,"threshold_value":0.5}', 0.2),
        "isolation_forest_strict": ('{"threshold_quantile":0.99,"threshold_value":0.75}', 0.3),
    }


# -- classifiers --------------------------------------------------------------------------------


def labelled(spark, n):
    return cloud(spark, n, outliers=0).withColumn("class", F.when(F.col("a") > 0, "malware").otherwise("benign"))


def test_models_learn_save_and_load(spark, tmp_path):
    vectors = supervised.labelled_vectors(labelled(spark, 400), ["a", "b"], "key")
    model = supervised.fit(supervised.logistic_regression(), vectors)
    row = supervised.evaluate(model, vectors).first()
    assert row["accuracy"] > 0.95 and row["auc"] > 0.99
    supervised.save_model(model, str(tmp_path / "m"))
    again = supervised.load_model(str(tmp_path / "m"))
    both = again.transform(model.transform(vectors).select("key", "features", F.col("prediction").alias("p")))
    assert both.filter("p <> prediction").count() == 0


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosted_trees"])
def test_trees_do_not_depend_on_the_cluster(spark, kind):
    """The layout of the training rows follows the rows, not the input's partitions."""
    vectors = supervised.labelled_vectors(labelled(spark, 500), ["a", "b"], "key")
    estimator = getattr(supervised, kind)()
    if kind == "gradient_boosted_trees":
        estimator.setMaxIter(5)
    found = [supervised.fit(estimator, vectors.repartition(n)).stages[0].toDebugString for n in (3, 8, 50)]
    text = [x.split("\n", 1)[1] for x in found]  # the first line holds the model's own id
    assert text[0] == text[1] == text[2]


def test_declared_parameters():
    assert supervised.logistic_regression().getMaxIter() == 50
    assert supervised.logistic_regression().getRegParam() == 0.01
    assert (supervised.random_forest().getNumTrees(), supervised.random_forest().getMaxDepth()) == (40, 8)
    gbt = supervised.gradient_boosted_trees()
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getSeed()) == (40, 5, 42)


def test_too_few_rows_give_null_metrics(spark):
    row = supervised.supervised_baselines(labelled(spark, 3), ["a", "b"], "key").first()
    assert row["accuracy"] is None and row["split"] == "test"


def test_grid_search_uses_every_fold_and_candidate(spark):
    df = labelled(spark, 300)
    folds = stratified_folds(df, "key", 3)
    assert folds.select("class", "fold").distinct().count() == 6
    vectors = supervised.labelled_vectors(df, ["a", "b"], "key")
    results = supervised.grid_results(spark, supervised.cross_validate(vectors, "key")).collect()
    assert len(results) == 4 and all(r["cv_metric_auc"] > 0.9 for r in results)


def test_training_partitions_follow_the_rows(spark, monkeypatch):
    """A larger table has more partitions, so no task's share grows with it; held on disk, as learners hold copies."""
    vectors = supervised.labelled_vectors(labelled(spark, 400), ["a", "b"], "key")
    with supervised.training_table(vectors) as held:
        assert held.rdd.getNumPartitions() == supervised.TRAINING_PARTITIONS
    monkeypatch.setattr(supervised, "PARTITION_ROWS", 10)
    with supervised.training_table(vectors) as held:
        assert held.rdd.getNumPartitions() == 40 and held.count() == 400
        assert held.storageLevel.useDisk and not held.storageLevel.useMemory


def test_baselines_share_one_layout(spark, monkeypatch):
    layouts = []
    plain = supervised.training_layout
    monkeypatch.setattr(supervised, "training_layout", lambda *a: layouts.append(a[1]) or plain(*a))
    rows = supervised.supervised_baselines(labelled(spark, 300), ["a", "b"], "key").collect()
    assert [r.algorithm for r in rows] == ["logistic_regression", "random_forest"] and all(r.accuracy > 0.8 for r in rows)
    assert layouts == [supervised.TRAINING_PARTITIONS]


def test_grid_search_holds_no_fold_in_memory_and_agrees_with_the_validator(spark, monkeypatch):
    vectors = supervised.labelled_vectors(labelled(spark, 300), ["a", "b"], "key")
    estimator = LogisticRegression(maxIter=20)
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.01, 5.0]).build()
    folded = supervised.training_layout(stratified_folds(vectors, "key", 3, label="label"), 4, ("fold",))
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=3, foldCol="fold"
    )
    expected = validator.fit(folded)
    monkeypatch.setattr(supervised, "PARTITION_ROWS", 15)
    monkeypatch.setattr(type(vectors), "cache", lambda self: pytest.fail("a fold is held in memory"))
    found = supervised.cross_validate(vectors, "key", estimator, grid)
    assert found.avgMetrics == pytest.approx(expected.avgMetrics) and found.stdMetrics == pytest.approx(expected.stdMetrics)
    assert found.getNumFolds() == 3 and found.bestModel.coefficients.toArray() == pytest.approx(expected.bestModel.coefficients.toArray())


def test_flag_all_scores_each_row_once(spark, monkeypatch):
    df = cloud(spark, 400).withColumn("split", F.when(F.col("a") > 0, "train").otherwise("test"))
    train = df.filter("split = 'train'")
    forest = anomaly.fit_isolation_forest(train, ["a", "b"], "key", trees=20, sample_rows=32)
    expected = replace(forest, cuts=anomaly.operating_points(forest.score(train))).flag(df)
    scored = []
    plain = anomaly.IsolationForest.score
    monkeypatch.setattr(anomaly.IsolationForest, "score", lambda self, rows: scored.append(rows) or plain(self, rows))
    flagged = anomaly.flag_all(forest, df, F.col("split") == "train", ("key", "split"))
    columns = ["key", "split", "anomaly_score", *anomaly.OPERATING_POINTS]
    assert sorted(flagged.select(columns).collect()) == sorted(expected.select(columns).collect())
    assert len(scored) == 1
    assert "ArrowEvalPython" not in plan_of(flagged)  # later reads take the staged scores


def noisy(spark, n):
    """Three sensors, two of them related, and a label that follows them with errors."""
    df = cloud(spark, n, outliers=0).withColumn("c", F.col("a") * 3 + F.col("b") + F.lit(40.0))
    flip = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(10)) == 0
    return df.withColumn("class", F.when((F.col("a") + F.col("b") / 2 > 0.3) != flip, "malware").otherwise("benign"))


def test_large_grid_searches_fit_all_points_and_folds_together(spark, monkeypatch):
    """As many fits as best models, and the areas of the fits one by one."""
    vectors = supervised.labelled_vectors(noisy(spark, 3000), ["a", "b", "c"], "key")
    plain = supervised.cross_validate(vectors, "key")
    fits, fit_one = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, *a: fits.append(a) or fit_one(self, *a))
    monkeypatch.setattr(supervised, "PARTITION_ROWS", 100)
    found = supervised.cross_validate(vectors, "key")
    assert len(fits) == 1
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=2e-6) and found.stdMetrics == pytest.approx(plain.stdMetrics, abs=2e-6)
    assert found.bestModel.coefficients.toArray() == pytest.approx(plain.bestModel.coefficients.toArray(), rel=1e-6)


def test_joint_fits_reach_the_optimum_of_the_library(spark, monkeypatch):
    """Coefficients of one left-out fold, also with features that the L1 part drops or that never vary."""
    df = noisy(spark, 2000).withColumn("d", F.lit(5.0))
    folded = stratified_folds(supervised.labelled_vectors(df, ["a", "b", "c", "d"], "key"), "key", 2, label="label")
    estimator = LogisticRegression(maxIter=500, tol=1e-12)
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.02]).addGrid(estimator.elasticNetParam, [0.0, 0.5, 1.0]).build()
    ended, scored = [], logistic.blocks.margins
    monkeypatch.setattr(logistic.blocks, "margins", lambda held, *a: ended.append(held.value + a[:2]) or scored(held, *a))
    assert logistic.grid_areas(folded, estimator, grid, 2).shape == (2, 3)
    left_out, coefficients, mean, scale = ended[0]
    for i, own in enumerate(coefficients):
        expected = estimator.fit(folded.filter(F.col("fold") != int(left_out[i])), grid[i % len(grid)])
        assert own[:-1] / scale == pytest.approx(expected.coefficients.toArray(), abs=1e-5)
        assert own[-1] - (own[:-1] / scale) @ mean == pytest.approx(expected.intercept, abs=1e-3)


def test_rows_that_do_not_suit_are_left_to_the_library(spark):
    df = labelled(spark, 60)
    one = stratified_folds(supervised.labelled_vectors(df.filter("class = 'malware'"), ["a", "b"], "key"), "key", 3, label="label")
    estimator = LogisticRegression()
    assert logistic.grid_areas(one, estimator, [{}], 3) is None
    assert not logistic.fits_together(estimator, [{estimator.maxIter: 3}]) and not logistic.fits_together(supervised.random_forest(), [{}])


def coarse(spark, n):
    """Vectors with fewer values than bins, where candidate cuts do not depend on a sample."""
    df = noisy(spark, n).withColumns({c: F.floor(F.col(c) * 6).cast("double") for c in ("a", "b", "c")})
    return supervised.labelled_vectors(df, ["a", "b", "c"], "key")


def probabilities(model, vectors):
    return {r["key"]: r["probability"][1] for r in model.transform(vectors).collect()}


def test_grown_boosting_is_that_of_the_library(spark, monkeypatch):
    """Also with many chunks and slices, and scores stored between the trees."""
    monkeypatch.setattr(binned, "CHUNK_ROWS", 150)
    monkeypatch.setattr(binned, "SLICE_ROWS", 64)
    vectors = coarse(spark, 3000)
    estimator = GBTClassifier(maxIter=5, maxDepth=3, seed=7)
    expected, found = estimator.fit(vectors), grown.grow_model(estimator, vectors.repartition(5), 3000)
    assert found.totalNumNodes == expected.totalNumNodes and found.treeWeights == expected.treeWeights
    first, second = probabilities(expected, vectors), probabilities(found, vectors)
    assert max(abs(first[k] - second[k]) for k in first) < 1e-9
    assert found.featureImportances.toArray() == pytest.approx(expected.featureImportances.toArray(), abs=1e-9)


def test_grown_forest_is_like_that_of_the_library(spark):
    vectors = coarse(spark, 4000)
    estimator = RandomForestClassifier(numTrees=60, maxDepth=5, seed=7)
    expected, found = estimator.fit(vectors), grown.grow_model(estimator, vectors, 4000)
    assert found.getNumTrees == 60 and found.totalNumNodes == pytest.approx(expected.totalNumNodes, rel=0.1)
    first, second = probabilities(expected, vectors), probabilities(found, vectors)
    gaps = [abs(first[k] - second[k]) for k in first]
    assert np.mean(gaps) < 0.02 and max(gaps) < 0.15
    weights = binned.bootstrap_weights()
    assert weights.mean() == pytest.approx(1, abs=1e-3) and weights.var() == pytest.approx(1, abs=1e-2)


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosted_trees"])
def test_trees_of_large_tables_grow_on_binned_rows_on_any_cluster(spark, monkeypatch, kind, tmp_path):
    vectors = supervised.labelled_vectors(noisy(spark, 600), ["a", "b", "c"], "key")
    estimator = getattr(supervised, kind)()
    estimator.setMaxIter(4) if kind == "gradient_boosted_trees" else estimator.setNumTrees(6)
    monkeypatch.setattr(supervised, "PARTITION_ROWS", 20)
    seen, plain = [], type(estimator)._fit
    monkeypatch.setattr(type(estimator), "_fit", lambda self, rows: seen.append(rows.count()) or plain(self, rows))
    models = [supervised.fit(estimator, vectors.repartition(n)) for n in (3, 9)]
    text = [m.stages[0].toDebugString.split("\n", 1)[1] for m in models]
    assert text[0] == text[1] and set(seen) == {2}  # the library fits two rows, for the frame of the model
    supervised.save_model(models[0], str(tmp_path / "m"))
    assert supervised.load_model(str(tmp_path / "m")).stages[0].toDebugString.split("\n", 1)[1] == text[0]
    assert supervised.evaluate(models[0], vectors).first()["accuracy"] > 0.8


def test_candidate_cuts_lie_between_values():
    assert binned.candidate_cuts(np.array([3.0, 1.0, 1.0, 2.0]), 32).tolist() == [1.5, 2.5]
    assert binned.candidate_cuts(np.full(9, 4.0), 32).tolist() == []
    cuts = binned.candidate_cuts(np.arange(1000.0), 4)
    assert len(cuts) == 3 and abs(cuts - np.array([250, 500, 750])).max() <= 1


def test_unknown_parameters_are_left_to_the_library():
    assert grown.grows(supervised.random_forest()) and grown.grows(supervised.gradient_boosted_trees())
    assert not grown.grows(RandomForestClassifier(subsamplingRate=0.5)) and not grown.grows(GBTClassifier(minInstancesPerNode=3))
    assert not grown.grows(LogisticRegression())
