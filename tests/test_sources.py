import json

import pytest
from pyspark.sql import functions as F

from gaugeline.plans.full_run import run_reports
from gaugeline.operators.anomaly import OPERATING_POINTS, IsolationForest
from gaugeline.operators.supervised import load_model
from gaugeline.plans.registry import ORACLE_SQL, QUERIES
from gaugeline.plans.telemetry import KEY, telemetry
from gaugeline.sources import reports, telemetry as scans, workspace
from tests.conftest import plan_of


def test_source_resolution(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "MetroPT3(AirCompressor).csv").write_text("timestamp,TP2\n2020-01-01 00:00:00,1.5\n")
    (raw / "other.csv").write_text("timestamp,TP2\n2020-01-01 00:00:00,9.5\n")
    (raw / "x MetroPT3 AirCompressor 2.csv").write_text("timestamp,TP2\n2020-01-02 00:00:00,2.5\n")
    found = scans.scan_source(spark, str(tmp_path / "gone.csv"), str(raw))
    assert sorted(r["TP2"] for r in found.collect()) == [1.5, 2.5]
    given = scans.scan_source(spark, str(raw / "other.csv"), str(raw))
    assert given.first()["TP2"] == 9.5
    with pytest.raises(FileNotFoundError):
        scans.scan_source(spark, None, str(tmp_path))


def test_curated_table_is_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "curated")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, class string")
    scans.write_curated(df, path)
    scans.write_curated(df.filter("class = 'a'"), path)
    read = spark.read.parquet(path)
    assert read.count() == 1
    assert "PartitionFilters: [isnotnull(class" in plan_of(read.filter(F.col("class") == "a"))


def test_one_class_is_written_anew_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "curated")
    scans.write_curated(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, class string"), path)
    scans.update_curated(spark.createDataFrame([(9, "b"), (8, "c")], "x int, class string"), path)
    assert sorted((r["x"], r["class"]) for r in spark.read.parquet(path).collect() if r["class"]) == [(1, "a"), (8, "c"), (9, "b")]
    assert spark.read.parquet(path).filter("class IS NULL").first()["x"] == 3


@pytest.mark.parametrize("write", [scans.write_curated, scans.update_curated])
def test_a_failed_write_leaves_the_old_table(spark, tmp_path, write):
    path = str(tmp_path / "curated")
    scans.write_curated(spark.createDataFrame([(1, "a"), (2, "b")], "x int, class string"), path)
    bad = F.when(F.col("id") == 900, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("int"))
    rows = spark.range(0, 1000, 1, 4).select(bad.alias("x"), F.lit("a").alias("class"))
    with pytest.raises(Exception, match="broken row"):
        write(rows, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]


def test_an_interrupted_swap_is_recovered(spark, tmp_path):
    path = tmp_path / "curated"
    scans.write_curated(spark.createDataFrame([(1, "a")], "x int, class string"), str(path))
    path.rename(tmp_path / "curated.old")
    assert scans.recover_curated(spark, str(path)) and spark.read.parquet(str(path)).count() == 1
    assert not scans.recover_curated(spark, str(path))


def planted_csv(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir(exist_ok=True)
    lines = ["timestamp,TP2,TP3", "2020-01-01 00:00:00,1.5,2", "soon,1.0,2", "2020-01-01 00:00:01,,2", "2020-01-01 00:00:02,x,2"]
    lines += ["2020-01-01 00:00:03,1.0", "2020-01-01 00:00:04,1,2,3", '2020-01-01 00:00:05,"1.25",4']
    (raw / "a.csv").write_text("\n".join(lines) + "\n")
    return str(raw)


def test_bad_lines_are_kept_apart(spark, tmp_path):
    schema = "timestamp timestamp, TP2 double, TP3 double"
    found = scans.scan_quarantined(spark, None, planted_csv(tmp_path), spark.createDataFrame([], schema).schema, "*.csv")
    assert found.rows.columns == ["timestamp", "TP2", "TP3"]
    assert sorted((r["TP2"] is None, r["TP3"]) for r in found.rows.collect()) == [(False, 2.0), (False, 4.0), (True, 2.0)]
    bad = {r["line"]: r["fields"] for r in found.bad_lines.collect()}
    assert bad == {"soon,1.0,2": 3, "2020-01-01 00:00:02,x,2": 3, "2020-01-01 00:00:03,1.0": 2, "2020-01-01 00:00:04,1,2,3": 4}
    assert found.bad_lines.first()["file"].endswith("a.csv")
    assert {r["metric"]: r["value"] for r in found.report().collect()} == {"malformed_rows": 4, "malformed_field_count": 2}
    inferred = scans.scan_quarantined(spark, None, planted_csv(tmp_path), None, "*.csv")
    assert inferred.rows.count() + inferred.bad_lines.count() == 7


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    rows = telemetry(spark, sf_dir).filter(F.col("tp2") > 49).select("tp2")
    plan = plan_of(rows)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49.0)]" in plan
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_report_is_one_file_and_typed_scan_refuses_bad_text(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([("a", 1), ("b, \"c\"", 2)], "class string, row_count int").repartition(2)
    path = reports.write_report(reports.conform(df, "class_distribution"), folder, "class_distribution")
    assert len(list((tmp_path / "class_distribution").glob("part-*"))) == 1
    read = reports.read_report(spark, folder, "class_distribution")
    assert sorted(tuple(r) for r in read.collect()) == [("a", 1), ("b, \"c\"", 2)]
    bad = tmp_path / "data_quality_report"
    bad.mkdir()
    (bad / "x.csv").write_text("metric,value\na,notanumber\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        reports.read_report(spark, folder, "data_quality_report").collect()
    assert path.endswith("class_distribution")


def test_stage_metrics_json(spark, tmp_path):
    rows = [("a", 0.5, 10), ("b", 1.5, 20)]
    table = spark.createDataFrame(rows, reports.REPORT_DDL["etl_stage_timings"])
    path = str(tmp_path / "m")
    reports.write_stage_metrics(table, path, {"selected_stage": "all"})
    text = next((tmp_path / "m").glob("part-*")).read_text()
    content = json.loads(text)
    assert content["extra"] == {"selected_stage": "all"} and len(content["stage_metrics"]) == 2
    assert sorted(tuple(r) for r in reports.read_stage_metrics(spark, path).collect()) == rows
    reports.write_stage_metrics(table, path)
    assert reports.read_stage_metrics(spark, path).count() == 2


def test_small_tables_are_pinned_and_large_ones_are_not(spark):
    small = workspace.pin_if_small(spark.range(10), 10)
    assert "LocalTableScan" in plan_of(small) and small.count() == 10
    large = workspace.pin_if_small(spark.range(11), 10)
    assert "Range" in plan_of(large)


def test_only_small_scans_are_spread(spark, sf_dir):
    small = telemetry(spark, sf_dir)
    assert "Exchange RoundRobin" in plan_of(workspace.spread_if_narrow(small))
    wide = spark.range(10**10)
    assert "Exchange" not in plan_of(workspace.spread_if_narrow(wide))


def test_every_query_has_unique_columns_and_sql_where_it_can():
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert set(ORACLE_SQL) == set(QUERIES) <= set(queries)


@pytest.mark.parametrize("with_label", [True, False])
def test_full_run(spark, sf_dir, tmp_path, with_label):
    raw = telemetry(spark, sf_dir).drop(KEY, "lps" if with_label else "label")
    raw = raw.withColumn("timestamp", F.col("timestamp").cast("string")).toDF(
        *[c.upper().replace("_", " ") for c in raw.columns]
    )
    written = run_reports(raw, str(tmp_path), measure_scaling=not with_label)
    read = {name: reports.read_report(spark, str(tmp_path), name) for name in written}
    total = raw.distinct().count()
    assert read["anomaly_scores"].count() == 2 * total
    assert read["split_summary"].agg(F.sum("row_count")).first()[0] == total
    metrics = {r["metric"]: r["value"] for r in read["data_quality_report"].collect()}
    assert metrics["total_rows"] == raw.count() and metrics["ground_truth_label_available"] == int(with_label)
    model = read["model_metrics"].filter("engine = 'spark_isolation_forest'")
    assert model.count() == 6
    assert model.filter("auc is not null").count() == (6 if with_label else 0)
    train = {r["algorithm"]: r["anomaly_rate"] for r in model.filter("split = 'train'").collect()}
    assert train["isolation_forest"] == pytest.approx(0.05, abs=0.002)
    assert train["isolation_forest_strict"] == pytest.approx(0.01, abs=0.002)
    assert read["bootstrap_confidence_intervals"].count() == 2 * 3 * 2
    stages = [r["stage"] for r in read["pipeline_lineage"].collect()]
    assert stages[0] == "ingestion_validation" and len(stages) == 6
    assert spark.read.parquet(str(tmp_path / "curated_parquet")).count() == total
    if not with_label:
        assert read["cost_performance"].count() == 7
        assert read["family_risk_distribution"].select("class").distinct().first()[0] == "unknown"


def test_rows_without_a_readable_time_are_counted_and_scored(spark, sf_dir, tmp_path):
    raw = telemetry(spark, sf_dir).drop(KEY)
    broken = F.col("tp2") == 7
    time = F.when(broken, F.lit("soon")).when(F.col("tp2") == 8, None).otherwise(F.col("timestamp").cast("string"))
    raw = raw.withColumn("timestamp", time)
    written = run_reports(raw, str(tmp_path))
    read = {name: reports.read_report(spark, str(tmp_path), name) for name in written}
    metrics = {r["metric"]: r["value"] for r in read["data_quality_report"].collect()}
    unread, without = raw.filter(broken).count(), raw.filter("tp2 IN (7, 8)").count()
    assert (metrics["unparsed_timestamp"], metrics["null_timestamp"]) == (unread, without)
    untimed = read["anomaly_scores"].filter("split = 'untimed'").count()
    assert untimed == 2 * (without - raw.filter("tp2 IN (7, 8)").exceptAll(raw.filter("tp2 IN (7, 8)").distinct()).count())
    assert read["model_metrics"].filter("split = 'untimed'").count() == 2
    assert read["model_metrics"].filter("runtime_seconds IS NULL").count() == 0
    forest = IsolationForest.load(spark, str(tmp_path / "models" / "isolation_forest"))
    assert set(forest.cuts) == set(OPERATING_POINTS)
    for name in ("logistic_regression", "random_forest"):
        load_model(str(tmp_path / "models" / name))


def test_full_run_of_a_quarantined_scan(spark, sf_dir, tmp_path):
    rows = telemetry(spark, sf_dir).drop(KEY).limit(1500)
    rows.withColumn("tp2", F.when(F.col("lps") == 1, F.lit("high")).otherwise(F.col("tp2").cast("string"))).write.option("header", True).csv(str(tmp_path / "raw"))
    planted = rows.filter("lps = 1").count()
    found = scans.scan_quarantined(spark, None, str(tmp_path / "raw"), rows.schema, "part-*.csv")
    run_reports(found, str(tmp_path / "out"))
    metrics = {r["metric"]: r["value"] for r in reports.read_report(spark, str(tmp_path / "out"), "data_quality_report").collect()}
    assert planted > 0 and (metrics["malformed_rows"], metrics["malformed_field_count"]) == (planted, 0)
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine")).count() == planted
    times = {r["stage"]: r["duration_seconds"] for r in reports.read_report(spark, str(tmp_path / "out"), "etl_stage_timings").collect()}
    assert set(times) == {"ingestion_validation", "basic_etl", "broadcast_etl", "feature_engineering", "data_split", "train_unsupervised"}
    assert min(times.values()) > 0


def test_scores_are_written_once_per_row(spark, tmp_path):
    rows = [(float(i), "train" if i < 6 else "test", "a") for i in range(10)]
    scored = spark.createDataFrame(rows, "anomaly_score double, split string, class string")
    path = reports.write_scores(scored, {"loose": 5.0, "strict": 9.0}, str(tmp_path))
    assert spark.read.parquet(path).count() == 10
    read = reports.read_report(spark, str(tmp_path), "anomaly_scores")
    assert read.columns == ["algorithm", "split", "anomaly_flag", "anomaly_score", "timestamp", "class"]
    flagged = {(r["algorithm"], r["split"]): r["n"] for r in read.groupBy("algorithm", "split").agg(F.sum("anomaly_flag").alias("n")).collect()}
    assert read.count() == 20 and flagged == {("loose", "train"): 1, ("loose", "test"): 4, ("strict", "train"): 0, ("strict", "test"): 1}


def test_released_tables_hold_no_rows(spark):
    paths = []
    staged = workspace.stage_table(spark.range(10), "spare", paths)
    assert staged.count() == 10
    workspace.release_tables(spark, paths)
    assert len(paths) == 1 and spark.read.parquet(paths[0]).count() == 0


def test_failed_run_leaves_its_lineage(spark, tmp_path):
    raw = spark.createDataFrame([("x",)], "class string")
    with pytest.raises(ValueError):
        run_reports(raw, str(tmp_path))
    row = reports.read_report(spark, str(tmp_path), "pipeline_lineage").first()
    assert row["status"] == "failed" and "feature" in row["notes"]


def test_labelled_sample_without_time(spark, tmp_path):
    """The five-row permission sample: default mode, draws within labels, null-free reports."""
    rows = [(1, 0, 1, 1, "malware", "a"), (0, 0, 0, 1, "benign", "b"), (1, 1, 1, 1, "malware", "c"),
            (0, 0, 1, 1, "benign", "b"), (1, 0, 0, 1, "malware", "a")]
    raw = spark.createDataFrame(rows, "perm_camera int, perm_sms int, perm_contacts int, perm_internet int, class string, app_family string")
    from gaugeline.operators import split
    from gaugeline.operators.enrich import enrich
    from gaugeline.operators.schema import ingest
    from gaugeline.plans.full_run import with_row_key

    ingested = ingest(raw)
    keyed = with_row_key(ingested.frame, ingested.frame.columns)
    assert enrich(keyed).select("operating_mode").distinct().first()[0] == "unknown"
    assert split.split_rows(split.upsample(keyed), KEY).count() == 125
