"""Isolation forest on executors, score thresholds and scored-row exports.

The forest follows Liu, Ting and Zhou, "Isolation Forest" (ICDM 2008): each tree is grown on a
small random sample, and the score of a row is 2^(-mean path length / c(sample)) - 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from gaugeline.functions.trees import (
    grow_tree,
    mean_path_lengths,
    mean_unsuccessful_search,
    tree_depth,
)
from gaugeline.operators.evaluate import score_summary
from gaugeline.operators.features import fill_features
from gaugeline.operators.selection import quantile_values
from gaugeline.sources.workspace import spread_if_narrow, stage_table

TREES = 300
SAMPLE_ROWS = 256
SEED = 42
# The two operating points and their quantiles of the training scores.
OPERATING_POINTS = {"isolation_forest": 0.95, "isolation_forest_strict": 0.99}
TREE_DDL = "tree INT, feature ARRAY<INT>, threshold ARRAY<DOUBLE>, path ARRAY<DOUBLE>, sample_rows INT"


@dataclass(frozen=True)
class IsolationForest:
    """The trees, the rows each was grown on, and the score thresholds once they are known."""

    columns: list[str]
    sample_rows: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    cuts: dict[str, float] = field(default_factory=dict)

    def score(self, df: DataFrame, output: str = "anomaly_score") -> DataFrame:
        """Adds the score of every row of the frame; higher is more anomalous, range (-0.5, 0.5).

        The trees (a few hundred times 511 nodes, whatever the table size) are broadcast.
        """
        spark = df.sparkSession
        trees = spark.sparkContext.broadcast((self.feature, self.threshold, self.path))
        scale = float(np.mean([mean_unsuccessful_search(n) for n in self.sample_rows])) or 1.0

        @F.pandas_udf("double")
        def path_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            feature, threshold, path = trees.value
            for batch in batches:
                x = np.column_stack([column.to_numpy(dtype=float) for column in batch])
                lengths = mean_path_lengths(x, feature, threshold, path)
                yield pd.Series(np.exp2(-lengths / scale) - 0.5)

        filled = [
            F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in self.columns
        ]
        return spread_if_narrow(df).withColumn(output, path_score(*filled))

    def flag(self, df: DataFrame) -> DataFrame:
        """Scores the frame and adds a 1/0 column per operating point, by the kept thresholds."""
        scored = self.score(df)
        return scored.withColumns({name: anomaly_flag("anomaly_score", cut) for name, cut in self.cuts.items()})

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees, feature list and thresholds as one Parquet row per tree."""
        cuts = {name: float(cut) for name, cut in self.cuts.items()}
        trees = zip(self.feature, self.threshold, self.path, self.sample_rows, strict=True)
        rows = [
            (i, f.tolist(), t.tolist(), p.tolist(), int(n), self.columns, cuts)
            for i, (f, t, p, n) in enumerate(trees)
        ]
        ddl = f"{TREE_DDL}, columns ARRAY<STRING>, cuts MAP<STRING, DOUBLE>"
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda row: row["tree"])
        return _from_rows(rows, rows[0]["columns"], rows[0]["cuts"])


def _from_rows(rows: Sequence, columns: Sequence[str], cuts: dict[str, float]) -> IsolationForest:
    return IsolationForest(
        list(columns),
        np.array([r["sample_rows"] for r in rows], dtype=np.int64),
        np.array([r["feature"] for r in rows], dtype=np.int32),
        np.array([r["threshold"] for r in rows], dtype=float),
        np.array([r["path"] for r in rows], dtype=float),
        dict(cuts),
    )


def _next_prime(n: int) -> int:
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, isqrt(n) + 1)):
        n += 1
    return n


#: Parts in which the samples of a tree meet before they meet in one, and groups of trees that meet together.
COMBINERS, TREE_GROUPS = 32, 16


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _first_places(rows: pa.Table, sample_rows: int) -> pa.Table:
    """Of each tree the ``sample_rows`` rows of lowest order; a key counts once."""
    tree, order, word = (rows.column(c).to_numpy() for c in ("tree", "_order", "_word"))
    by = np.lexsort((word, order, tree))
    tree, order, word = tree[by], order[by], word[by]
    again = np.zeros(len(by), bool)
    again[1:] = (tree[1:] == tree[:-1]) & (order[1:] == order[:-1]) & (word[1:] == word[:-1])
    by, tree = by[~again], tree[~again]
    nth = np.arange(len(by)) - np.searchsorted(tree, tree)
    return rows.take(pa.array(by[nth < sample_rows]))


def _task_samples(trees: int, sample_rows: int, slots: int, schema: pa.Schema):
    """The lowest ``sample_rows`` places of every tree among a task's rows.

    A key's place number c, counted from 0, is in tree ``first + c * step`` modulo a prime and has the
    order c plus a fraction.  Once a tree is full of orders below c, later places cannot enter it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = schema.empty_table()
        worst = np.full(trees, np.inf)  # order of the last row of each full tree
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column("_word").to_numpy().view(np.uint64)
            first = (_scrambled(word ^ np.uint64(0xA5A5A5A5)) % np.uint64(slots)).astype(np.int64)
            step = (_scrambled(word ^ np.uint64(0x5A5A5A5A)) % np.uint64(max(slots - 1, 1))).astype(np.int64) + 1
            for place in range(slots):
                if not (worst >= place).any():
                    break
                tree = (first + place * step) % slots
                order = place + (_scrambled(word + np.uint64(2 * place + 1)) >> np.uint64(11)) / float(1 << 53)
                own = np.flatnonzero(tree < trees)
                own = own[order[own] <= worst[tree[own]]]
                if not len(own):
                    continue
                drawn = [pa.array(tree[own].astype(np.int32)), pa.array(order[own]), *(c.take(pa.array(own)) for c in batch.columns)]
                held = pa.concat_tables([held, pa.Table.from_arrays(drawn, schema=schema)])
                held = _first_places(held, sample_rows).combine_chunks()
                counts = np.bincount(held.column("tree").to_numpy(), minlength=trees)
                last = np.cumsum(counts) - 1
                full = counts >= sample_rows
                worst[full] = held.column("_order").to_numpy()[last[full]]
        yield from held.to_batches()

    return run


def forest_samples(df: DataFrame, columns: Sequence[str], key: str, trees: int, sample_rows: int, seed: int) -> DataFrame:
    """``(tree, _order, _key, *columns)``: exactly ``sample_rows`` rows for every tree, or every key if there are fewer.

    A bottom-k sample that merges: each task keeps the lowest orders of every tree, these meet in a
    few parts and then in one, so neither the number of rows nor that of keys has to be known before.
    Rows with the same key are drawn once, so copies of a row neither fill a tree nor thin out the
    draw.  Every key has a first tree, a second tree and so on from its hash; lower places go first,
    so a large table gives each drawn row to one tree and a tiny one puts every key into every tree.
    """
    slots = _next_prime(trees)
    named = F.coalesce(F.col(key).cast("string"), F.lit("<null>"))
    slim = fill_features(df, columns).select(
        F.xxhash64(named, F.lit(seed)).alias("_word"), named.alias("_key"), *[F.col(c).cast("double").alias(c) for c in columns]
    )
    schema = StructType([StructField("tree", IntegerType()), StructField("_order", DoubleType()), *slim.schema.fields])
    arrow = to_arrow_schema(schema)
    drawn = spread_if_narrow(slim).mapInArrow(_task_samples(trees, sample_rows, slots, arrow), schema)

    def lowest(rows: pa.Table) -> pa.Table:
        return _first_places(rows, sample_rows)

    salted = drawn.withColumns(
        {"_part": F.pmod(F.spark_partition_id(), F.lit(COMBINERS)), "_group": F.pmod("tree", F.lit(TREE_GROUPS))}
    )
    kept = salted.groupBy("_group", "_part").applyInArrow(lambda rows: lowest(rows.drop(["_group", "_part"])), schema)
    met = kept.withColumn("_group", F.pmod("tree", F.lit(TREE_GROUPS)))
    return met.groupBy("_group").applyInArrow(lambda rows: lowest(rows.drop(["_group"])), schema).drop("_word")


def fit_isolation_forest(
    train: DataFrame,
    columns: Sequence[str],
    key: str,
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> IsolationForest:
    """Draws the samples on Spark and grows the trees in parallel, one small group per tree.

    The samples are held once, which also says how many rows every tree has.
    """
    columns = list(columns)
    samples = stage_table(forest_samples(train, columns, key, trees, sample_rows, seed), "forest-samples")
    sizes = [r["rows"] for r in samples.groupBy("tree").agg(F.count(F.lit(1)).alias("rows")).collect()]
    if not sizes:
        raise ValueError("no training rows")
    depth = tree_depth(max(sizes))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        picked = group.sort_values(["_order", "_key"])
        x = picked[columns].to_numpy(dtype=float)
        feature, threshold, path = grow_tree(x, depth, np.random.default_rng([seed, tree]))
        return pd.DataFrame(
            {
                "tree": [tree],
                "feature": [feature],
                "threshold": [threshold],
                "path": [path],
                "sample_rows": [len(x)],
            }
        )

    # A fixed partition number, as AQE would merge these few megabytes into a single task.
    tasks = min(trees, train.sparkSession.sparkContext.defaultParallelism)
    grown = samples.repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, TREE_DDL).collect()
    # One row per tree came back: bounded by the parameters, not by the table.
    return _from_rows(sorted(grown, key=lambda row: row["tree"]), columns, {})


# -- thresholds and exports ---------------------------------------------------------------------


def anomaly_flag(score: Column | str, threshold: Column | float) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    threshold = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (score >= threshold).cast("int")


def operating_points(
    train_scores: DataFrame, score: str = "anomaly_score", points: dict[str, float] | None = None
) -> dict[str, float]:
    """Threshold of every operating point: one set of scores, several quantiles."""
    points = points or OPERATING_POINTS
    return dict(zip(points, quantile_values(train_scores, score, list(points.values())), strict=True))


def flag_all(forest: IsolationForest, rows: DataFrame, training: Column, keep: Sequence[str]) -> DataFrame:
    """``keep``, score and flags of every row, by thresholds of the scores of the ``training`` rows.

    Each row is scored once: the scores are staged, as the quantiles read theirs up to three times.
    """
    scored = stage_table(forest.score(rows.withColumn("_training", training)).select(*keep, "_training", "anomaly_score"), "scored")
    cuts = operating_points(scored.filter("_training"))
    return scored.drop("_training").withColumns({name: anomaly_flag("anomaly_score", cut) for name, cut in cuts.items()})


def by_operating_point(scored: DataFrame, thresholds: dict[str, float], score: str = "anomaly_score") -> DataFrame:
    """Each scored row once per operating point, with its flag."""
    literal = F.array(
        *[F.struct(F.lit(a).alias("algorithm"), F.lit(t).alias("_threshold")) for a, t in thresholds.items()]
    )
    return (
        scored.select("*", F.inline(literal))
        .withColumn("anomaly_flag", anomaly_flag(score, F.col("_threshold")))
        .drop("_threshold")
    )


def operating_point_summary(
    scored: DataFrame, thresholds: dict[str, float], score: str = "anomaly_score"
) -> DataFrame:
    """``score_summary`` per algorithm and split without repeating the rows per algorithm: the
    scores are summarised once per split, and only the flag rate differs between the points."""
    points = list(thresholds.items())
    rates = {f"_rate{i}": anomaly_flag(score, t) for i, (_, t) in enumerate(points)}
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("algorithm"),
                F.col(f"_rate{i}").alias("anomaly_rate"),
                F.round(F.lit(t), 6).alias("anomaly_threshold"),
            )
            for i, (name, t) in enumerate(points)
        ]
    )
    return score_summary(scored, ("split",), score, rates).select("*", F.inline(rows)).drop(*rates)


def anomaly_scores(scored: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """The scored-row export; time and label only where the table has them."""
    optional = [c for c in ("timestamp", "class") if c in scored.columns]
    return by_operating_point(scored, thresholds).select(
        "algorithm", "split", "anomaly_flag", "anomaly_score", *optional
    )


def model_selection(
    summary: DataFrame, thresholds: dict[str, float], points: dict[str, float] | None = None
) -> DataFrame:
    """One row per operating point: its parameters as JSON and the validation p99 it is chosen by."""
    points = points or OPERATING_POINTS
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("_algorithm"),
                F.lit(points[a]).alias("threshold_quantile"),
                F.lit(t).alias("threshold_value"),
            )
            for a, t in thresholds.items()
        ]
    )
    return (
        summary.filter(F.col("split") == "validation")
        .select("algorithm", "score_p99", F.inline(rows))
        .filter(F.col("algorithm") == F.col("_algorithm"))
        .select(
            "algorithm",
            F.to_json(F.struct("threshold_quantile", "threshold_value")).alias("params"),
            F.lit(None).cast("double").alias("cv_metric_auc"),
            F.lit("validation_score_p99").alias("selection_metric"),
            F.col("score_p99").alias("selection_value"),
        )
    )
