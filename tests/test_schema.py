import pytest
from pyspark.sql import functions as F

from gaugeline.functions import labels, modes
from gaugeline.functions.numeric import alert_count, epoch_seconds, executor_cost, review_profit, throughput
from gaugeline.operators import schema
from gaugeline.operators.enrich import enrich, join_mode_risk, mode_lookup, with_operating_mode
from tests.conftest import plan_of


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        (["A", "a", "Oil Temp (C)", "  ", "x_2", "x", "x"], ["a", "a_2", "oil_temp_c", "col", "x_2", "x", "x_3"]),
        (["x", "x", "x", "x_2"], ["x", "x_3", "x_4", "x_2"]),
        ([" __TP2__ ", "tp2", "", "", "Ünit"], ["tp2", "tp2_2", "col", "col_2", "nit"]),
        (["_c0", "DV-pressure", "COMP"], ["c0", "dv_pressure", "comp"]),
    ],
)
def test_clean_names(raw, clean):
    assert schema.clean_names(raw) == clean
    assert len(set(clean)) == len(clean)


def test_sanitize_keeps_columns_apart_that_differ_by_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("A", "a", "A ")
    clean = schema.sanitize_columns(df)
    assert clean.columns == ["a", "a_2", "a_3"]
    assert tuple(clean.first()) == (1, 2, 3)


def test_index_column_of_an_unnamed_csv_header_is_dropped(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",timestamp,TP2,Label\n0,2020-01-01 00:00:00,1.5,Fault\n1,zz,1.5,normal\n")
    ingested = schema.ingest(spark.read.option("header", True).csv(str(tmp_path)).withColumn("TP2", F.col("TP2").cast("double")))
    assert ingested.features == ["tp2"]
    assert ingested.has_label
    rows = sorted((r["class"], r["timestamp"] is None) for r in ingested.frame.collect())
    assert rows == [("benign", True), ("malware", False)]


def test_timestamp_failures_counts_unreadable_text_only(spark):
    df = spark.createDataFrame([("2020-01-01",), ("zz",), (None,)], "timestamp string")
    assert schema.timestamp_failures(df).first()["value"] == 1


def test_features_include_decimals_and_flags_but_not_look_alikes(spark):
    df = spark.sql(
        "SELECT 1 AS i, CAST(1 AS DECIMAL(5,2)) AS d, true AS b, array(1) AS a, named_struct('x', 1) AS s, "
        "INTERVAL '1' DAY AS v, 'q' AS class, TIMESTAMP '2020-01-01' AS timestamp"
    )
    assert schema.select_features(df) == ["i", "d", "b"]
    with pytest.raises(ValueError):
        schema.select_features(df.select("class", "timestamp", "a"))


@pytest.mark.parametrize("name", ["class", "result", "label", "target"])
def test_label_is_found_and_renamed(spark, name):
    df = spark.createDataFrame([(1, "x")], f"a int, {name} string")
    assert schema.rename_label(df).columns == ["a", "class"]


def test_first_label_candidate_wins(spark):
    df = spark.createDataFrame([("t", "l")], "target string, label string")
    assert schema.rename_label(df).columns == ["target", "class"]


def test_labels_are_trimmed_before_matching(spark):
    raw = [" Fault ", "1", "TRUE", "anomaly", "0", "Normal", "benign", " Other ", None]
    df = spark.createDataFrame([(v,) for v in raw], "class string")
    found = [r["class"] for r in schema.normalize_class(df).collect()]
    assert found == ["malware"] * 4 + ["benign"] * 3 + ["other", None]


def test_label_vocabulary_is_a_parameter(spark):
    df = spark.createDataFrame([("bad",), ("good",)], "class string")
    named = schema.normalize_class(
        df, positive="fault", negative="fine", positive_spellings=["bad"], negative_spellings=["good"]
    )
    assert [r["class"] for r in named.collect()] == ["fault", "fine"]


def test_missing_label_defaults_to_unknown(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert schema.normalize_class(df).first()["class"] == labels.UNLABELLED


def test_null_label_is_not_positive(spark):
    df = spark.createDataFrame([("malware",), ("benign",), (None,)], "class string")
    assert [r[0] for r in df.select(labels.is_positive("class")).collect()] == [1, 0, 0]


def test_operating_mode_falls_through_null_operands(spark):
    rows = [
        (1, 1, 0, "production"), (0, 0, 1, "idle"), (1, 0, 1, "pressure_event"), (0, 1, 0, "transition"),
        (1, None, 1, "pressure_event"), (1, None, 0, "transition"), (None, None, None, "transition"),
        (1, 1, 1, "pressure_event"),
    ]
    df = spark.createDataFrame(rows, "comp int, towers int, lps int, expected string")
    for row in with_operating_mode(df).collect():
        assert row["operating_mode"] == row["expected"]
    assert with_operating_mode(df.drop("lps")).select("operating_mode").distinct().first()[0] == "unknown"


def test_enrich_broadcasts_the_lookup_and_defaults_unmatched_modes(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 1, 0)], "comp int, towers int, lps int")
    assert "BroadcastHashJoin" in plan_of(enrich(df))
    partial = mode_lookup(spark).filter("operating_mode = 'production'")
    found = {r["operating_mode"]: (r["mode_risk"], r["maintenance_priority"]) for r in enrich(df, partial).collect()}
    assert found == {"production": ("medium", "observe"), "transition": ("unknown", "investigate")}


def test_a_large_lookup_is_not_broadcast(spark):
    big = spark.range(30_000).select(
        F.col("id").cast("string").alias("operating_mode"),
        F.lit("low").alias("mode_risk"),
        F.lit("x").alias("maintenance_priority"),
    )
    df = spark.createDataFrame([("5",)], "operating_mode string")
    joined = join_mode_risk(df, big)
    assert "hint=(strategy=broadcast)" not in joined._jdf.queryExecution().analyzed().toString()
    assert joined.first()["mode_risk"] == "low"


def test_risk_ordinals(spark):
    df = spark.createDataFrame([("high",), ("medium",), ("low",), ("unknown",), (None,)], "mode_risk string")
    assert [r[0] for r in df.select(modes.mode_risk_ordinal()).collect()] == [3.0, 2.0, 1.0, 0.0, 0.0]


def test_epoch_seconds_of_both_timestamp_types(spark):
    df = spark.sql("SELECT TIMESTAMP '1970-01-02 00:00:01.9' AS z, TIMESTAMP_NTZ '1970-01-02 00:00:01.9' AS n")
    assert tuple(df.select(epoch_seconds(df, "z"), epoch_seconds(df, "n")).first()) == (86401, 86401)


def test_report_arithmetic_gives_the_published_values(spark):
    row = spark.range(1).select(
        alert_count(F.lit(303208), F.lit(0.066288)).alias("alerts"),
        alert_count(F.lit(303208), F.lit(0.013885)).alias("strict"),
        alert_count(F.lit(5), F.lit(0.5)).alias("half_even"),
        alert_count(F.lit(5), F.lit(None).cast("double")).alias("no_rate"),
        review_profit(F.lit(20099)).alias("profit"),
        executor_cost(F.lit(0.4577)).alias("cost"),
        throughput(F.lit(10), F.lit(0.0)).alias("instant"),
    ).first()
    assert tuple(row) == (20099, 4210, 2, 0, -160792.0, 3.2e-05, 10_000_000.0)
