import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gaugeline.operators import features, quality, stages
from gaugeline.sources.workspace import shared_root
from tests.conftest import plan_of


def as_dict(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def test_quality_report_counts_copies_and_nulls(spark):
    rows = [("a", 1, None)] * 3 + [("b", 2, 1.0), (None, 2, 1.0)]
    df = spark.createDataFrame(rows, "class string, x int, y double")
    assert as_dict(quality.quality_report(df, ["x", "y"], True)) == {
        "ground_truth_label_available": 1, "total_rows": 5, "duplicate_rows": 2,
        "null_class": 1, "null_x": 0, "null_y": 3,
    }


def test_quality_report_of_an_empty_table(spark):
    df = spark.createDataFrame([], "class string, x int")
    assert set(as_dict(quality.quality_report(df, ["x"], False)).values()) == {0}


def test_quality_report_checks_all_features_in_one_scan(spark, tmp_path):
    columns = [f"s{i}" for i in range(12)]
    spark.range(10).select(F.lit("a").alias("class"), *[F.col("id").alias(c) for c in columns]).write.parquet(
        str(tmp_path / "t")
    )
    report = quality.quality_report(spark.read.parquet(str(tmp_path / "t")), columns, True)
    assert report.count() == 3 + 1 + 12
    assert plan_of(report).count("FileScan") == 1
    few = quality.quality_report(spark.read.parquet(str(tmp_path / "t")), columns, True, null_checked=10)
    assert few.count() == 3 + 1 + 10


def test_clean_rows_drops_copies_even_when_one_row_fills_most_of_the_table(spark):
    df = spark.range(5000).select(
        F.lit(" Fault ").alias("class"), F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("x")
    )
    cleaned = quality.clean_rows(df)
    assert cleaned.count() == 1001
    assert cleaned.select("class").distinct().first()[0] == "fault"
    assert "partial_count" not in plan_of(df) and "HashAggregate" in plan_of(cleaned)


def tricky(spark):
    """Rows that differ only in where the null is, signed zeros, NaNs, and copies."""
    nan = float("nan")
    rows = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), ("a", "a", nan), ("a", "a", nan), (None, None, None), (None, None, None), ("", "", 0.0), ("", None, 0.0)]
    return spark.createDataFrame(rows, "class string, x string, z double").repartition(4)


@pytest.mark.parametrize("repeated", [500_000, 1])
def test_collapse_equals_a_group_by_of_whole_rows(spark, monkeypatch, repeated):
    monkeypatch.setattr(quality, "REPEATED_ROWS", repeated)
    df = tricky(spark)
    whole = df.groupBy(*[f"`{c}`" for c in df.columns]).count()
    found = quality.collapse_copies(df)
    assert found.columns == [*df.columns, quality.COPIES]
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, (tuple(r) for r in whole.collect())))
    assert quality.dedup_rows(df).count() == 6 == df.distinct().count()
    report = as_dict(quality.quality_report(df, ["x", "z"], True))
    assert (report["total_rows"], report["duplicate_rows"], report["null_class"], report["null_x"], report["null_z"]) == (9, 3, 3, 5, 2)


def test_equal_fingerprints_merge_nothing(spark, monkeypatch):
    monkeypatch.setattr(quality, "row_fingerprint", lambda columns, seed=0: F.lit(1).cast("bigint"))
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2)], "class string, x int")
    assert sorted(tuple(r) for r in quality.collapse_copies(df).collect()) == [("a", 1, 1), ("a", 2, 2)]
    honest = lambda columns, seed=0: F.xxhash64(F.lit(1), *columns) if seed == 2 else F.lit(1).cast("bigint")
    monkeypatch.setattr(quality, "row_fingerprint", honest)
    with pytest.raises(Exception, match="share a fingerprint"):
        quality.quality_report(df, ["x"], True).collect()


def test_nested_columns_are_compared_whole(spark):
    df = spark.createDataFrame([("a", [None, 1]), ("a", [1, None]), ("a", [1, None])], "class string, x array<int>")
    assert quality.dedup_rows(df).count() == 2
    assert as_dict(quality.quality_report(df, ["x"], True))["duplicate_rows"] == 1


def test_fingerprints_alone_are_shuffled(spark, tmp_path):
    """The exchange of a table with many columns carries two numbers a row."""
    columns = [F.col("id").alias(f"s{i}") for i in range(80)]
    spark.range(50).select(F.lit("a").alias("class"), *columns).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(quality.repeated_fingerprints(table))
    assert "hashpartitioning(_f0" in plan and "keys=[_f0" in plan and "s79" not in plan.split("Exchange hashpartitioning")[0]
    assert "Exchange" not in plan_of(quality.collapse_copies(table))  # no row stands twice
    assert "BroadcastHashJoin" in plan_of(quality.collapse_copies(table.unionByName(table)))
    assert quality.quality_report(table, [f"s{i}" for i in range(80)], True).count() == 4 + 80 - 0


def test_stages_are_held_before_they_count(spark):
    log = stages.StageLog()
    slow = F.udf(lambda x: __import__("time").sleep(0.02) or x, "long")
    held = log.run("slow", lambda: spark.range(0, 40, 1, 1).select(slow("id").alias("x")), None, "n")
    (name, seconds, rows), paths = log.timings[0], []
    assert rows == 40 and seconds > 0.8 and "FileScan parquet" in plan_of(held)
    assert "ReadSchema: struct<>" in plan_of(held.groupBy().count())
    log.run("next", lambda: held, log.rows_of("slow"), "n", paths=paths)
    assert len(paths) == 1 and log.rows_of("next") == 40


def test_ground_truth(spark):
    df = spark.createDataFrame([("unknown",), ("malware",)], "class string")
    assert quality.has_ground_truth(df)
    assert not quality.has_ground_truth(df.filter("class = 'unknown'"))


def test_risk_score_sums_left_to_right_and_keeps_null(spark):
    df = spark.createDataFrame([(1, 2.5, True), (1, None, True)], "a int, b double, c boolean")
    scored = features.SensorRiskScore(inputCols=["a", "b", "c"]).transform(df)
    assert [r["sensor_risk_score"] for r in scored.collect()] == [4.5, None]
    empty = features.SensorRiskScore(outputCol="r").transform(df)
    assert [r["r"] for r in empty.collect()] == [0.0, 0.0]


def test_risk_score_saves_and_loads_in_a_pipeline(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[features.SensorRiskScore(inputCols=["a", "b"], outputCol="r")]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    assert PipelineModel.load(str(tmp_path / "m")).transform(df).first()["r"] == 3.0


def test_risk_columns_prefer_known_sensors():
    assert features.risk_columns(["x", "h1", "tp2"]) == ["tp2", "h1"]
    assert features.risk_columns(list("abcdefgh")) == list("abcdef")


def test_assemble_keeps_nulls_as_nan(spark):
    df = spark.createDataFrame([(1.0, True), (None, False)], "a double, b boolean")
    vectors = [r[0] for r in features.assemble(df, ["a", "b"]).select(vector_to_array("features")).collect()]
    assert vectors[0] == [1.0, 1.0]
    assert vectors[1][0] != vectors[1][0] and vectors[1][1] == 0.0


def test_fill_replaces_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 2), (None, None), (float("nan"), 3)], "a double, b int")
    assert [tuple(r) for r in features.fill_features(df, ["a", "b"]).collect()] == [(1.0, 2.0), (0.0, 0.0), (0.0, 3.0)]


def test_scaling_uses_population_deviation_and_leaves_constants_centred(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    scaling = features.fit_scaling(df, ["a", "b"])
    assert scaling.scales == [1.0, 1.0]
    assert [tuple(r) for r in scaling.apply(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_materialized_always_releases(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError), stages.materialized(df) as held:
        assert held.storageLevel.useMemory and held.storageLevel.useDisk
        raise RuntimeError
    assert not held.storageLevel.useMemory


def test_checkpointed_stage_goes_to_the_shared_folder(spark):
    with stages.materialized(spark.range(10).withColumn("x", F.col("id") * 2), checkpoint=True) as held:
        assert held.count() == 10
        assert "Range" not in plan_of(held)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == shared_root(spark)


def test_stage_log_records_rows_and_failures(spark):
    log = stages.StageLog()
    log.run("first", lambda: spark.range(7), None, "n")
    with pytest.raises(Exception, match="nope"):
        log.run("second", lambda: spark.range(1).select("nope"), 7, "n")
    rows = [tuple(r)[:4] for r in log.lineage_table(spark).collect()]
    assert rows == [("first", "success", 7, 7), ("second", "failed", 0, 0)]
    assert "nope" in log.lineage[1][4] and "\n" not in log.lineage[1][4]
    assert [(r["stage"], r["rows"]) for r in log.stage_metrics(spark).collect()] == [("first", 7)]
