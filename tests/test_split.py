import hashlib

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import keys
from gaugeline.operators import split, stages
from gaugeline.plans.telemetry import KEY, labelled


def word(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def keyed(spark, n, classes=("a", "b", "c", None), parts=1):
    index = F.col("id").cast("int")
    label = F.element_at(F.array(*[F.lit(c) for c in classes]), index % len(classes) + 1)
    return spark.range(0, n, 1, parts).select(F.concat(F.lit("k"), "id").alias("key"), label.alias("class"), "id")


def assigned(df):
    return {r["key"]: r["split"] for r in df.collect()}


def test_hash_columns_match_md5(spark):
    row = spark.createDataFrame([("k1",)], "key string").select(
        keys.bucket32("key").alias("a"), keys.bucket32("key", 42).alias("b"),
        keys.digest_word(keys.digest("key"), 3).alias("c"), keys.hash_bucket("key", 5, "x").alias("d"),
    ).first()
    full = hashlib.md5(b"k1").hexdigest()
    assert tuple(row) == (word("k1"), word("k1|42"), int(full[24:], 16), word("k1|x") % 5)


def test_temporal_split_boundaries_and_null_times(spark):
    df = spark.range(101).select(
        F.concat(F.lit("k"), "id").alias("key"), F.lit("a").alias("class"), "id",
        F.when(F.col("id") < 100, F.timestamp_seconds("id")).alias("timestamp"),
    )
    done = split.temporal_split(df)
    counts = {r["split"]: r["count"] for r in done.groupBy("split").count().collect()}
    assert counts == {"train": 60, "validation": 20, "test": 20, "untimed": 1}
    assert done.filter("split = 'train'").agg(F.max("id")).first()[0] == 59
    with pytest.raises(ValueError):
        split.temporal_split(df.filter("id = 100"))


def test_split_falls_back_when_times_are_all_equal(spark):
    df = keyed(spark, 400).withColumn("timestamp", F.timestamp_seconds(F.lit(5)))
    found = assigned(split.split_rows(df, "key"))
    assert set(found.values()) == set(split.SPLITS)
    assert len(found) == 400


@pytest.mark.parametrize("maker", [
    lambda df: split.stratified_split(df, "key"),
    lambda df: split.random_split(df, "key"),
    lambda df: split.tiny_split(df, "key"),
    lambda df: split.stratified_folds(df, "key", 4, output="split"),
])
def test_draws_partition_the_input_and_ignore_partitioning(spark, maker):
    reference = assigned(maker(keyed(spark, 1000)))
    assert len(reference) == 1000 and None not in reference.values()
    for parts in (4, 16):
        assert assigned(maker(keyed(spark, 1000, parts=parts))) == reference


def test_every_label_is_split_in_proportion(spark):
    done = split.stratified_split(keyed(spark, 8000), "key")
    for label, rows in done.groupBy("class").pivot("split").count().rdd.map(lambda r: (r[0], r.asDict())).collect():
        total = sum(rows[s] for s in split.SPLITS)
        assert total == 2000, label
        assert abs(rows["train"] / total - 0.6) < 0.05
        assert abs(rows["test"] / total - 0.2) < 0.05


def test_tiny_split_takes_validation_out_of_train(spark):
    found = assigned(split.tiny_split(keyed(spark, 3000), "key"))
    shares = {s: sum(v == s for v in found.values()) / 3000 for s in split.SPLITS}
    assert abs(shares["train"] - 0.64) < 0.03 and abs(shares["validation"] - 0.16) < 0.03


def test_samples(spark):
    df = keyed(spark, 2000, parts=5)
    assert split.capped_sample(df, "key", 2000).count() == 2000
    capped = split.capped_sample(df, "key", 300)
    assert 200 < capped.count() <= 300
    assert {r["key"] for r in capped.collect()} == {
        r["key"] for r in split.capped_sample(df.repartition(3), "key", 300).collect()
    }
    expected = {f"k{i}" for i in range(2000) if word(f"k{i}|42") / 2**32 < 0.5}
    assert {r["key"] for r in split.fraction_sample(df, "key", 1000).collect()} == expected


def test_replication(spark):
    df = keyed(spark, 50)
    assert split.replicate_rows(df, 3).count() == 150
    assert split.upsample(df, 120).count() == 150
    assert split.upsample(df, 50).count() == 50
    assert split.upsample(df, 60).count() == 100


def test_repartition_counts_do_not_depend_on_partitions(spark):
    df = keyed(spark, 900, parts=3)
    reference = sorted(map(tuple, split.repartition_group_count(df, 1).collect()), key=repr)
    for n in (2, 16):
        assert sorted(map(tuple, split.repartition_group_count(df, n).collect()), key=repr) == reference


def test_salting_spreads_a_dominant_label(spark):
    df = keyed(spark, 20_000, classes=("a",))
    sizes = [r["rows"] for r in stages.partition_sizes(split.salted_repartition(df, 8, "class", "key")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 20_000 * 0.6 and len(sizes) >= 4


def test_temporal_split_of_the_sensor_view(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    done = split.split_rows(rows, KEY)
    counts = {r["split"]: r["count"] for r in done.groupBy("split").count().collect()}
    assert sum(counts.values()) == rows.count()
    assert abs(counts["train"] / rows.count() - 0.6) < 0.01
