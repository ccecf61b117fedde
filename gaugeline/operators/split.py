"""Train / validation / test splits, samples, folds and replication.

All draws are functions of a unique row key and a seed, so a recomputed task repeats them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import keys
from gaugeline.functions.numeric import epoch_seconds
from gaugeline.operators.selection import quantile_values

SEED = 42
SPLITS = ("train", "validation", "test")
UNTIMED = "untimed"
FRACTIONS = (0.6, 0.2, 0.2)
BOUNDARIES = (0.6, 0.8)


def _with_split(df: DataFrame, position: Column, boundaries: Sequence[float], inclusive: bool) -> DataFrame:
    """Names the range each position falls in.

    The position is a column of its own first, as a hash inside the CASE would be computed
    again for every branch.
    """
    at, (first, second) = F.col("_position"), boundaries
    below = (at <= first, at <= second) if inclusive else (at < first, at < second)
    name = (
        F.when(at.isNull(), None).when(below[0], SPLITS[0]).when(below[1], SPLITS[1]).otherwise(SPLITS[2])
    )
    return df.withColumn("_position", position).withColumn("split", name).drop("_position")


def approx_time_boundaries(
    df: DataFrame, timestamp: str = "timestamp", relative_error: float = 0.001
) -> list[float]:
    seconds = df.select(epoch_seconds(df, timestamp).alias("_seconds"))
    return seconds.approxQuantile("_seconds", list(BOUNDARIES), relative_error)


def time_boundaries(df: DataFrame, timestamp: str = "timestamp") -> list[float]:
    """Exact 0.6 / 0.8 quantiles of the epoch seconds; empty when no row has a time."""
    seconds = df.select(epoch_seconds(df, timestamp).alias("_seconds"))
    return quantile_values(seconds, "_seconds", BOUNDARIES)


def temporal_split(
    df: DataFrame, timestamp: str = "timestamp", boundaries: Sequence[float] | None = None
) -> DataFrame:
    """Adds ``split`` by time.  Rows without a time stay, as the split ``untimed``."""
    boundaries = list(boundaries or time_boundaries(df, timestamp))
    if len(boundaries) != 2:
        raise ValueError(f"no value in {timestamp!r} to split on")
    placed = _with_split(df, epoch_seconds(df, timestamp), boundaries, inclusive=True)
    return placed.withColumn("split", F.coalesce("split", F.lit(UNTIMED)))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = "class",
    fractions: Sequence[float] = FRACTIONS,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``split`` drawn separately within each label; every label, null included, is kept."""
    stratum = F.coalesce(F.col(label).cast("string"), F.lit("<null>"))
    position = keys.unit_interval(key, stratum, seed)
    return _with_split(df, position, (fractions[0], fractions[0] + fractions[1]), inclusive=False)


def random_split(
    df: DataFrame, key: str, fractions: Sequence[float] = FRACTIONS, seed: int = SEED
) -> DataFrame:
    position = keys.unit_interval(key, seed)
    return _with_split(df, position, (fractions[0], fractions[0] + fractions[1]), inclusive=False)


def tiny_split(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """80/20 for tables too small for three draws; validation is a fifth taken out of train."""
    return random_split(df, key, (0.64, 0.16, 0.20), seed)


def split_rows(df: DataFrame, key: str, label: str = "class", timestamp: str = "timestamp") -> DataFrame:
    """By time when that fills all three splits, else within labels, else as a tiny table."""
    if timestamp in df.columns:
        boundaries = time_boundaries(df, timestamp)
        if len(boundaries) == 2:
            split = temporal_split(df, timestamp, boundaries)
            if _fills(split, SPLITS):
                return split
    split = stratified_split(df, key, label)
    return split if _fills(split, SPLITS[2:]) else tiny_split(df, key)


def _fills(df: DataFrame, names: Sequence[str]) -> bool:
    return df.groupBy("split").count().filter(F.col("split").isin(*names)).count() == len(names)


def stratified_folds(
    df: DataFrame, key: str, folds: int, label: str = "class", seed: int = SEED, output: str = "fold"
) -> DataFrame:
    """Adds a fold number drawn separately within each label."""
    stratum = F.coalesce(F.col(label).cast("string"), F.lit("<null>"))
    return df.withColumn(output, keys.hash_bucket(key, folds, stratum, seed))


def fraction_sample(df: DataFrame, key: str, target_rows: int, seed: int = SEED) -> DataFrame:
    """All rows up to the target, else each row with probability target / rows."""
    rows = df.count()
    if rows <= target_rows:
        return df
    return df.filter(keys.unit_interval(key, seed) < F.lit(target_rows / rows))


def capped_sample(df: DataFrame, key: str, cap_rows: int, seed: int = SEED) -> DataFrame:
    """As ``fraction_sample``, then at most ``cap_rows`` rows, those with the smallest hashes.

    The draw already leaves about ``cap_rows`` rows, so the limit sorts a bounded set.
    """
    rows = df.count()
    if rows <= cap_rows:
        return df
    drawn = df.withColumn("_word", keys.bucket32(key, seed)).filter(
        F.col("_word") / float(keys.BUCKET_RANGE) < F.lit(cap_rows / rows)
    )
    return drawn.orderBy("_word", key).limit(cap_rows).drop("_word")


def replicate_rows(df: DataFrame, copies: int) -> DataFrame:
    """Each row ``copies`` times from one scan."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")


def upsample(df: DataFrame, target_rows: int = 120) -> DataFrame:
    """Replicates a table smaller than the target; never fewer than two copies."""
    rows = df.limit(target_rows).count()
    if rows >= target_rows:
        return df
    return replicate_rows(df, max(2, target_rows // max(rows, 1) + 1))


def repartition_group_count(df: DataFrame, partitions: int, label: str = "class") -> DataFrame:
    """The scaling workload: rows per label after a round-robin repartition."""
    return df.repartition(partitions).groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))


def salted_repartition(
    df: DataFrame, partitions: int, label: str, key: str, salts: int | None = None
) -> DataFrame:
    """Partition by label and a salt from the row key, so a dominant label fills many partitions."""
    salt = keys.hash_bucket(key, salts or partitions, "salt")
    return df.repartition(partitions, F.col(label), salt)
