"""Score summaries, top-k confusion, AUC, feature influence, bootstrap and classifier metrics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from gaugeline.functions import keys
from gaugeline.operators.selection import counts_below, joint_quantiles, top_k_flags
from gaugeline.sources.workspace import spread_if_narrow, stage_table

SCORE_QUANTILES = {"score_p95": 0.95, "score_p99": 0.99}


def score_summary(
    scored: DataFrame,
    by: Sequence[str] = ("algorithm", "split"),
    score: str = "anomaly_score",
    rates: dict[str, Column] | None = None,
) -> DataFrame:
    """Flag rate, mean, population deviation, p95 and p99 of the score per group, to 6 places.

    ``rates`` maps output columns to 0/1 expressions whose mean is wanted; by default the
    mean of ``anomaly_flag``.  ``rows`` is the size of the group.
    """
    rates = rates or {"anomaly_rate": F.col("anomaly_flag")}
    moments = {
        "rows": F.count(F.lit(1)),
        **{name: F.avg(flag.cast("double")) for name, flag in rates.items()},
        "score_mean": F.avg(score),
        "score_std": F.stddev_pop(score),
    }
    found = joint_quantiles(scored, {score: SCORE_QUANTILES}, by, moments)
    return found.select(
        *by, "rows", *[F.round(name, 6).alias(name) for name in [*moments, *SCORE_QUANTILES] if name != "rows"]
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def harmonic_mean(precision: Column, recall: Column) -> Column:
    return 2 * precision * recall / F.greatest(precision + recall, F.lit(1e-12))


def topk_confusion(
    scored: DataFrame,
    key: str,
    label: str,
    by: Sequence[str],
    score: str = "anomaly_score",
) -> DataFrame:
    """Confusion of "flag the k highest scores" with k = max(1, positives), per group.

    ``label`` is 1 or 0.  A group with a single label value gets null metrics.  The four columns are
    staged first, as positives, cut-offs and counts each read them.
    """
    by = list(by)
    scored = stage_table(scored.select(*by, key, score, label), "judged")
    labelled = scored.groupBy(*by).agg(
        F.sum(label).alias("_positives"), (F.min(label) < F.max(label)).alias("_both")
    )
    sizes = labelled.filter("_both").select(*by, F.greatest("_positives", F.lit(1)).alias("_k"))
    flagged = top_k_flags(scored, score, sizes, key, by)
    hit, truth = F.col("_top") == 1, F.col(label) == 1
    counts = flagged.groupBy(*by).agg(
        F.count_if(hit & truth).alias("tp"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
        F.count(F.lit(1)).alias("_rows"),
        (F.min(label) < F.max(label)).alias("_both"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn)
    metrics = {
        "accuracy": 1.0 - (fp + fn) / F.col("_rows"),
        "f1": harmonic_mean(precision, recall),
        "weightedPrecision": precision,
        "weightedRecall": recall,
    }
    return counts.select(
        *by,
        *[F.when(F.col("_both"), F.col(c)).alias(c) for c in ("tp", "fp", "fn")],
        *[F.when(F.col("_both"), F.round(m, 6)).alias(name) for name, m in metrics.items()],
    )


def roc_auc(scored: DataFrame, label: str, by: Sequence[str] = (), score: str = "anomaly_score") -> DataFrame:
    """Probability that a positive outranks a negative, ties counted half; null with one label value."""
    is_pos = F.col(label) == 1
    amounts = {
        "_pos": F.when(is_pos, 1).otherwise(0),
        "_neg": F.when(is_pos, 0).otherwise(1),
    }
    ranked = counts_below(scored.filter(F.col(label).isNotNull()), score, amounts, by)
    won = F.col("_pos").cast("double") * (F.col("_neg_below") + F.col("_neg") / 2.0)
    totals = ranked.groupBy(*by).agg(
        F.sum(won).alias("_won"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")
    )
    pairs = F.col("_p").cast("double") * F.col("_n")
    return totals.select(*by, F.try_divide(F.col("_won"), pairs).alias("auc"))


def feature_influence(
    scored: DataFrame,
    features: Sequence[str],
    algorithms: Sequence[str],
    score: str = "anomaly_score",
) -> DataFrame:
    """Absolute Pearson correlation of each feature with the score, nulls as 0, to 8 places.

    One aggregate for all features.  A (near) constant feature counts 0.
    """
    s = F.col(score)
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    wide = scored.agg(
        *[
            F.when(
                F.stddev_pop(x) > 1e-12,
                F.try_divide(F.covar_pop(x, s), F.stddev_pop(x) * F.stddev_pop(s)),
            ).alias(name)
            for name, x in values.items()
        ]
    )
    importance = F.round(F.abs(F.coalesce(F.nanvl("importance", F.lit(0.0)), F.lit(0.0))), 8)
    return (
        wide.unpivot([], list(features), "feature", "importance")
        .select(
            F.explode(F.array(*[F.lit(a) for a in algorithms])).alias("algorithm"),
            "feature",
            importance.alias("importance"),
        )
        .orderBy("algorithm", F.desc("importance"), "feature")
    )


# -- bootstrap ----------------------------------------------------------------------------------

# P(Poisson(1) <= w) for w = 0..4; a draw above all of them weighs 5.
POISSON_CDF = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015)
WORDS_PER_DIGEST = 4
#: Groups a task sums up before it hands them on.
GROUPS_HELD = 4_096


def poisson_limits() -> list[int]:
    """The same limits as 32-bit words."""
    return [int(p * keys.BUCKET_RANGE) for p in POISSON_CDF]


def _group_numbers(batch: pa.RecordBatch, by: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Where each group of a batch first occurs, and the group number of every row; null is a group."""
    number = np.zeros(batch.num_rows, np.int64)
    for c in by:
        coded = batch.column(c).dictionary_encode(null_encoding="encode")
        number = number * (len(coded.dictionary) + 1) + coded.indices.to_numpy()
        number = np.unique(number, return_inverse=True)[1]
    _, first, number = np.unique(number, return_index=True, return_inverse=True)
    return first, number


def _replicate_sums(by: list[str], metrics: int, iterations: int, seed: int, schema: pa.Schema):
    """Per task the weight and the weighted metrics of every group and replicate."""
    limits = np.array(poisson_limits(), np.uint32)
    blocks = -(-iterations // WORDS_PER_DIGEST)

    def emit(held: dict[tuple, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for group, (counts, weights, sums) in held.items():
            columns = [pa.array([value] * iterations, schema.field(c).type) for c, value in zip(by, group, strict=True)]
            columns += [pa.array(np.arange(iterations)), *(pa.array(np.full(iterations, n)) for n in counts), pa.array(weights[:iterations])]
            columns += [pa.array(np.ascontiguousarray(sums[:iterations, i])) for i in range(metrics)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        md5 = hashlib.md5
        for batch in batches:
            if not batch.num_rows:
                continue
            first, number = _group_numbers(batch, by)
            order = np.argsort(number, kind="stable")
            starts = np.searchsorted(number[order], np.arange(len(first)))
            values = [batch.column(f"_m{i}") for i in range(metrics)]
            present = np.stack([np.ones(batch.num_rows, np.int64), *(v.is_valid().to_numpy(zero_copy_only=False).astype(np.int64) for v in values)])
            matrix = np.stack([v.fill_null(0.0).to_numpy(zero_copy_only=False) for v in values], axis=1)[order]
            # A null key leaves only the salts in the digest.
            words = [b"" if k is None else k.encode("utf-8") + b"|" for k in batch.column("_key").to_pylist()]
            weights = np.empty((len(first), blocks * WORDS_PER_DIGEST))
            sums = np.empty((len(first), blocks * WORDS_PER_DIGEST, metrics))
            for block in range(blocks):
                salts = f"{seed}|{block}".encode()
                drawn = np.frombuffer(b"".join([md5(w + salts).digest() for w in words]), ">u4").astype(np.uint32)
                weight = np.zeros(len(drawn), np.float64)
                for limit in limits:
                    weight += drawn >= limit
                weight = weight.reshape(-1, WORDS_PER_DIGEST)[order]
                part = slice(block * WORDS_PER_DIGEST, (block + 1) * WORDS_PER_DIGEST)
                weights[:, part] = np.add.reduceat(weight, starts, axis=0)
                for i in range(metrics):
                    sums[:, part, i] = np.add.reduceat(weight * matrix[:, i : i + 1], starts, axis=0)
            counts = np.add.reduceat(present[:, order], starts, axis=1)
            groups = zip(*(batch.column(c).take(pa.array(first)).to_pylist() for c in by), strict=True) if by else [()]
            for i, group in enumerate(groups):
                if group in held:
                    for mine, more in zip(held[group], (counts[:, i], weights[i], sums[i]), strict=True):
                        mine += more
                else:
                    held[group] = [counts[:, i].copy(), weights[i].copy(), sums[i].copy()]
            if len(held) > GROUPS_HELD:
                yield from emit(held)
                held = {}
        yield from emit(held)

    return run


def bootstrap_intervals(
    df: DataFrame,
    metrics: dict[str, Column],
    by: Sequence[str],
    key: str,
    iterations: int = 200,
    seed: int = 42,
) -> DataFrame:
    """95 % intervals of the means of ``metrics`` by the Poisson bootstrap.

    Each row weighs Poisson(1) in every replicate, drawn from the md5 of its key, so replicates need
    no resampling shuffle: a task multiplies weights and metrics of its rows and hands on one row per
    group and replicate.  One digest serves four replicates.
    """
    by, names = list(by), list(metrics)
    slim = df.select(
        *by, F.col(key).cast("string").alias("_key"), *[m.cast("double").alias(f"_m{i}") for i, m in enumerate(metrics.values())]
    )
    counted = ["_rows", *[f"_p{i}" for i in range(len(names))]]
    summed = ["_weight", *[f"_s{i}" for i in range(len(names))]]
    fields = [StructField("_replicate", LongType()), *[StructField(c, LongType()) for c in counted], *[StructField(c, DoubleType()) for c in summed]]
    schema = StructType([*[slim.schema[c] for c in by], *fields])
    run = _replicate_sums(by, len(names), iterations, seed, to_arrow_schema(schema))
    partial = spread_if_narrow(slim).mapInArrow(run, schema)
    sums = partial.groupBy(*by, "_replicate").agg(*[F.sum(c).alias(c) for c in counted + summed])
    replicates = sums.select(
        *by,
        "_rows",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("metric"),
                        F.when(F.col(f"_p{i}") > 0, F.try_divide(F.col(f"_s{i}"), F.col("_weight"))).alias("_mean"),
                    )
                    for i, name in enumerate(names)
                ]
            )
        ),
    )
    # At most ``iterations`` values per group and metric from here on.
    ends = F.percentile("_mean", F.array(F.lit(0.025), F.lit(0.975)))
    return (
        replicates.groupBy(*by, "metric")
        .agg(ends.alias("_ends"), F.max("_rows").alias("sample_rows"))
        .select(
            *by,
            "metric",
            F.round(F.col("_ends")[0], 6).alias("ci_lower_95"),
            F.round(F.col("_ends")[1], 6).alias("ci_upper_95"),
            F.lit(iterations).cast("bigint").alias("bootstrap_iterations"),
            "sample_rows",
        )
    )


# -- classifiers --------------------------------------------------------------------------------


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``: at most classes squared rows."""
    return predictions.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def classifier_metrics(table: DataFrame, places: int = 6) -> DataFrame:
    """One row from a confusion table: accuracy, then f1, precision and recall of class 1, then
    the same three averaged over all classes by their support."""
    right = F.col("label") == F.col("prediction")
    roles = F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("support"), F.lit(0).alias("predicted")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).alias("support"), F.col("n").alias("predicted")),
    )
    per_class = (
        table.withColumn("_tp", F.when(right, F.col("n")).otherwise(0))
        .select("_tp", F.inline(roles))
        .groupBy("c")
        .agg(
            F.sum(F.when(F.col("support") > 0, F.col("_tp")).otherwise(0)).alias("tp"),
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
        )
        .withColumn("p", safe_ratio(F.col("tp"), F.col("predicted")))
        .withColumn("r", safe_ratio(F.col("tp"), F.col("support")))
        .withColumn("f", harmonic_mean(F.col("p"), F.col("r")))
    )

    def of_positive(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("c") == 1, F.col(name))), F.lit(0.0))

    def weighted(name: str) -> Column:
        return safe_ratio(F.sum(F.col(name) * F.col("support")), F.sum("support"))

    metrics = {
        "accuracy": safe_ratio(F.sum("tp"), F.sum("support")),
        "f1": of_positive("f"),
        "precision": of_positive("p"),
        "recall": of_positive("r"),
        "weightedPrecision": weighted("p"),
        "weightedRecall": weighted("r"),
        "weightedF1": weighted("f"),
    }
    return per_class.agg(*[F.round(m, places).alias(name) for name, m in metrics.items()])
