"""Exact order statistics of large columns without sorting the table in one task.

A column is cut into value ranges ("tiles") at quantiles of a sample.  Only row counts per
tile are gathered; from them follows which few tiles hold the wanted ranks, and only the
rows of those tiles are looked at again.  The sampled cuts decide how even the tiles are,
never the result: ranks come from exact counts.  Equal values are collapsed to
(value, count) before any shuffle, so one dominant value cannot overload a task.  Quantiles use
sketched brackets instead, shared by all columns and groups, and a full ranking cuts the sorted
distinct values into ranges of equally many rows.

A frame counted to have at most ``ONE_TILE_ROWS`` rows takes Spark's own exact aggregate or
window instead, which is fewer passes; both ways give the same rows.  The frame is read up to
four times (rows, sample, tile counts, wanted tiles), so pass a table or a materialised stage.

Null is a group like any other: inside this module the group columns travel as one struct, and
structs whose fields are null are equal in joins, where plain nulls never are.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil
from typing import NamedTuple

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions import keys
from gaugeline.sources.workspace import pin_if_small, stage_table

ONE_TILE_ROWS = 1_000_000
# Few tiles are looked at again, and those can be cut again.
SELECTION_TILES = 4096
SAMPLES_PER_TILE = 16
MIN_SAMPLE = 100_000
MAX_LEVELS = 3
# Accuracy of the sketched brackets: their rank error is at most rows / SKETCH.
SKETCH = 10_000
SEED = 42
GROUP = "_group"


def grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame with its group columns as one struct, and the name to group by."""
    return (df.withColumn(GROUP, F.struct(*by)), [GROUP]) if by else (df, [])


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of per-group tables on the group columns; the null group meets itself."""
    if not by:
        return left.join(right, how="left")
    (first, key), (second, _) = grouped(left, by), grouped(right, by)
    return first.join(second.drop(*by), key, "left").drop(*key)


def sampled_cuts(df: DataFrame, value: str, rows: int, one_tile_rows: int, max_tiles: int) -> list[float]:
    """Distinct finite tile boundaries from a sample of bounded size; more tiles for more rows."""
    tiles = min(max_tiles, 2 * ceil(rows / one_tile_rows) + 6)
    share = min(1.0, max(MIN_SAMPLE, SAMPLES_PER_TILE * tiles) / rows)
    drawn = df.select(F.col(value).cast("double").alias("v")).sample(False, share, SEED).toArrow()
    values = drawn.column("v").to_numpy()
    values = values[np.isfinite(values)] + 0.0
    if not values.size:
        return [0.0]
    return np.unique(np.quantile(values, np.arange(1, tiles) / tiles, method="lower")).tolist()


def with_tiles(
    df: DataFrame,
    value: str,
    rows: int,
    one_tile_rows: int,
    max_tiles: int,
) -> DataFrame:
    """Adds ``_tile``: the number of the value range; it never decreases with the value."""
    if rows <= one_tile_rows:
        return df.withColumn("_tile", F.lit(0))
    ranges = Bucketizer(
        splits=[
            float("-inf"), *sampled_cuts(df, value, rows, one_tile_rows, max_tiles), float("inf"),
        ],
        inputCol="_cut",
        outputCol="_tile",
        handleInvalid="keep",
    )
    # Adding 0.0 turns -0.0 into 0.0: equal values must share a tile.
    tiled = ranges.transform(df.withColumn("_cut", F.col(value).cast("double") + F.lit(0.0)))
    # Never null, so joins on it add no filter that would compute the tile a second time.
    return tiled.withColumn("_tile", F.coalesce(F.col("_tile").cast("int"), F.lit(-1))).drop("_cut")


def rows_before(amount: str, order: str, by: Sequence[str]) -> Column:
    """Sum of ``amount`` over the group's rows that precede this one."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(window), F.lit(0))


class Tiled(NamedTuple):
    """A column cut into tiles, with the exact row count and start rank of each tile."""

    frame: DataFrame
    value: str
    by: list[str]
    starts: DataFrame
    totals: DataFrame
    one_tile_rows: int


def tile_column(
    df: DataFrame, value: str, by: Sequence[str] = (), one_tile_rows: int = ONE_TILE_ROWS
) -> Tiled:
    by = list(by)
    present = df.filter(F.col(value).isNotNull())
    totals = pin_if_small(present.groupBy(*by).agg(F.count(F.lit(1)).alias("_total")))
    rows = totals.agg(F.sum("_total")).first()[0] or 0
    frame = with_tiles(present, value, rows, one_tile_rows, SELECTION_TILES)
    if rows <= one_tile_rows:
        starts = totals.select(
            *by,
            F.lit(0).alias("_tile"),
            F.col("_total").alias("_rows"),
            F.lit(True).alias("_mixed"),
            F.lit(0).alias("_start"),
        )
    else:
        counts = pin_if_small(
            frame.groupBy(*by, "_tile").agg(
                F.count(F.lit(1)).alias("_rows"), (F.min(value) < F.max(value)).alias("_mixed")
            )
        )
        # One row per group and tile, at most SELECTION_TILES + 1 rows per group.
        starts = counts.withColumn("_start", rows_before("_rows", "_tile", by))
    return Tiled(frame, value, by, starts, totals, one_tile_rows)


def values_at(tiled: Tiled, ranks: DataFrame | Sequence[int], level: int = 1) -> DataFrame:
    """The values at 0-based ascending ranks.

    ``ranks`` is a list, or for grouped tiles a frame ``(*by, _rank)``.  Returns
    ``(*by, _rank, value, _below, _equal)``: how many rows of the group are smaller than
    the value, and how many equal it.  A wanted tile that is itself too large for one task is
    cut again into tiles, unless it holds one value only and so collapses to one row.
    """
    frame, value, by, starts, _, one_tile_rows = tiled
    if isinstance(ranks, DataFrame):
        located = starts.join(ranks, by)
    else:
        located = starts.withColumn("_rank", F.explode(F.array(*[F.lit(int(r)) for r in ranks])))
    inside = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_rows"))
    outer = f"_tile{level}"
    wanted = pin_if_small(
        located.filter(inside)
        .groupBy(*by, F.col("_tile").alias(outer))
        .agg(
            F.first("_start").alias("_start"),
            F.first(F.when(F.col("_mixed"), F.col("_rows"))).alias("_rows"),
            F.collect_set("_rank").alias("_ranks"),
        )
    )
    tile_key = [*by, outer]
    band = frame.withColumnRenamed("_tile", outer).join(wanted.select(*tile_key), tile_key, "left_semi")
    largest = wanted.agg(F.max("_rows")).first()[0] or 0
    if largest > one_tile_rows and level < MAX_LEVELS:
        asked = wanted.select(*tile_key, "_start", F.explode("_ranks").alias("_asked"))
        asked = asked.withColumn("_rank", F.col("_asked") - F.col("_start"))
        inner = tile_column(band, value, tile_key, one_tile_rows)
        found = values_at(inner, asked.select(*tile_key, "_rank"), level + 1)
        return found.join(asked, [*tile_key, "_rank"]).select(
            *by,
            F.col("_asked").alias("_rank"),
            value,
            (F.col("_start") + F.col("_below")).alias("_below"),
            "_equal",
        )
    ranked = (
        band.groupBy(*tile_key, value)
        .agg(F.count(F.lit(1)).alias("_equal"))
        .withColumn("_below", rows_before("_equal", value, tile_key))
        .join(wanted, tile_key)
        .withColumn("_below", F.col("_start") + F.col("_below"))
        .withColumn("_rank", F.explode("_ranks"))
    )
    hit = (F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_equal"))
    return ranked.filter(hit).select(*by, "_rank", value, "_below", "_equal")


# -- quantiles ----------------------------------------------------------------------------------


class Slot(NamedTuple):
    """One wanted quantile: the number of its column, its name, and its probability."""

    column: int
    name: str
    probability: float


def joint_quantiles(
    df: DataFrame,
    wanted: dict[str, dict[str, float]],
    by: Sequence[str] = (),
    extra: dict[str, Column] | None = None,
    one_tile_rows: int = ONE_TILE_ROWS,
) -> DataFrame:
    """Exact quantiles of several columns per group: ``(*by, *extra, <name>...)``.

    ``wanted`` is ``{column: {name: probability}}`` with linear interpolation; names are unique.
    Columns and groups share their scans, at most three whatever their number: one counts the rows,
    computes the ``extra`` aggregates, and sketches a narrow bracket around each wanted rank; one
    counts the values below each bracket; one gathers the few values inside.  With at most
    ``one_tile_rows`` rows, which a look at so many rows tells, one scan aggregates all of it exactly.  Ranks
    come from exact counts: a bracket that misses its rank is opened to the whole column and counted again.
    """
    frame, key = grouped(df, by)
    groups = [F.col(GROUP)[c].alias(c) for c in by]
    slots = [Slot(i, name, float(p)) for i, asked in enumerate(wanted.values()) for name, p in asked.items()]
    # Adding 0.0 turns -0.0 into 0.0.
    values = {f"_v{i}": F.col(c).cast("double") + F.lit(0.0) for i, c in enumerate(wanted)}
    counts = [F.count(v).alias(f"_n{i}") for i, v in enumerate(values.values())]
    extra = extra or {}
    own = [e.alias(f"_x{i}") for i, e in enumerate(extra.values())]
    sketches = [
        F.percentile_approx(v, F.array(*[F.lit(e) for s in slots if s.column == i for e in _bracket(s.probability)]), SKETCH).alias(f"_s{i}")
        for i, v in enumerate(values.values())
    ]
    slim = frame.select(*key, *[v.alias(n) for n, v in values.items()])
    if slim.limit(one_tile_rows + 1).count() <= one_tile_rows:
        exact = [
            F.percentile(v, F.array(*[F.lit(s.probability) for s in slots if s.column == i])).alias(f"_q{i}") for i, v in enumerate(values.values())
        ]
        place = {s: [x for x in slots if x.column == s.column].index(s) for s in slots}
        joined = frame.groupBy(*key).agg(*own, *exact)
        joined = joined.withColumns({f"_a{i}": F.col(f"_q{s.column}")[place[s]] for i, s in enumerate(slots)})
    else:
        summary = pin_if_small(frame.groupBy(*key).agg(*own, *counts, *sketches))
        answers = _bracketed(slim, summary, slots, key, one_tile_rows)
        joined = summary.join(answers, key, "left") if key else summary.join(answers)
    names = [F.col(f"_a{i}").alias(s.name) for i, s in enumerate(slots)]
    extras = [F.col(f"_x{i}").alias(name) for i, name in enumerate(extra)]
    return joined.select(*groups, *extras, *names)


def _bracket(probability: float) -> tuple[float, float]:
    """Probabilities that hold the wanted rank between them, twice the sketch's error apart."""
    return max(0.0, probability - 2 / SKETCH), min(1.0, probability + 2 / SKETCH)


def _bracketed(slim: DataFrame, summary: DataFrame, slots: list[Slot], key: list[str], one_tile_rows: int) -> DataFrame:
    """``(*key, _a0, _a1, ...)``: the wanted quantiles from counts below and inside their brackets."""
    edges, seen = [], dict.fromkeys(range(len(slots)), 0)
    for i, s in enumerate(slots):
        at = 2 * seen[s.column]
        seen[s.column] += 1
        low, high = _bracket(s.probability)
        # Open ends: nothing is below minus infinity, and NaN is the largest double.
        edges.append((F.lit(float("-inf")) if low <= 0 else F.col(f"_s{s.column}")[at]).alias(f"_lo{i}"))
        edges.append((F.lit(float("nan")) if high >= 1 else F.col(f"_s{s.column}")[at + 1]).alias(f"_hi{i}"))
    total = {i: F.col(f"_n{s.column}") for i, s in enumerate(slots)}
    bounds = summary.select(*key, *[f"_n{i}" for i in sorted({s.column for s in slots})], *edges)
    every = range(len(slots))
    for last in (False, True):
        bounds = pin_if_small(bounds)
        facing = slim.join(bounds, key) if key else slim.join(bounds)
        value = [F.col(f"_v{s.column}") for s in slots]
        inside = [(value[i] >= F.col(f"_lo{i}")) & (value[i] <= F.col(f"_hi{i}")) for i in every]
        below = pin_if_small(facing.groupBy(*key).agg(*[F.count_if(value[i] < F.col(f"_lo{i}")).alias(f"_b{i}") for i in every]))
        some = inside[0]
        for condition in inside[1:]:
            some = some | condition
        met = F.array(*[F.when(inside[i], F.struct(F.lit(i).alias("_slot"), value[i].alias("_value"))) for i in every])
        near = facing.filter(some).select(*key, F.inline(F.filter(met, lambda x: x.isNotNull())))
        collapsed = stage_table(near.groupBy(*key, "_slot", "_value").agg(F.count(F.lit(1)).alias("_rows")), "brackets")
        ranks = bounds.join(below, key) if key else bounds.join(below)
        ranks = ranks.select(
            *key,
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("_slot"), ((total[i] - 1) * F.lit(s.probability)).alias("_at"), F.col(f"_b{i}").alias("_before"), total[i].alias("_total"))
                        for i, s in enumerate(slots)
                    ]
                )
            ),
        )
        held = collapsed.groupBy(*key, "_slot").agg(F.sum("_rows").alias("_inside"))
        checked = pin_if_small(ranks.join(held, [*key, "_slot"], "left"))
        reached = (F.col("_before") <= F.floor("_at")) & (F.ceil("_at") < F.col("_before") + F.coalesce("_inside", F.lit(0)))
        if last or checked.filter((F.col("_total") > 0) & ~reached).isEmpty():
            break
        missed = [r["_slot"] for r in checked.filter((F.col("_total") > 0) & ~reached).select("_slot").distinct().collect()]
        bounds = bounds.withColumns(
            {f"_{end}{i}": F.lit(open_) for i in missed for end, open_ in (("lo", float("-inf")), ("hi", float("nan")))}
        )
    summed = running_sums(collapsed, "_value", ["_rows"], [*key, "_slot"], one_tile_rows)
    placed = summed.join(checked, [*key, "_slot"]).withColumn("_below", F.col("_before") + F.col("_rows_below"))

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_below")) & (rank < F.col("_below") + F.col("_rows"))

    low, high = F.floor("_at"), F.ceil("_at")
    ends = placed.filter(holds(low) | holds(high)).groupBy(*key, "_slot").agg(
        F.max(F.when(holds(low), F.col("_value"))).alias("_low"),
        F.max(F.when(holds(high), F.col("_value"))).alias("_high"),
        F.first(F.col("_at") - F.floor("_at")).alias("_part"),
    )
    between = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    )
    return ends.groupBy(*key).agg(*[F.max(F.when(F.col("_slot") == i, between)).alias(f"_a{i}") for i in every])


def quantile_values(
    df: DataFrame, value: str, probabilities: Sequence[float], one_tile_rows: int = ONE_TILE_ROWS
) -> list[float]:
    """Exact quantiles of one column with linear interpolation; empty input gives an empty list."""
    asked = {value: {f"q{i}": p for i, p in enumerate(probabilities)}}
    found = joint_quantiles(df.select(value), asked, one_tile_rows=one_tile_rows).first()
    return [] if found is None or found[0] is None else [float(q) for q in found]


def quantiles_by(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: Sequence[str],
    one_tile_rows: int = ONE_TILE_ROWS,
) -> DataFrame:
    """Exact quantiles per group: ``(*by, <name>...)`` for ``{name: probability}``.

    Groups without a value are left out.
    """
    present = df.select(*by, value).filter(F.col(value).isNotNull())
    return joint_quantiles(present, {value: probabilities}, by, one_tile_rows=one_tile_rows)


def approx_quantiles_by(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str], accuracy: int = 10_000
) -> DataFrame:
    """One-pass sketch quantiles, rank error at most rows / accuracy."""
    return df.groupBy(*by).agg(
        *[F.percentile_approx(value, p, accuracy).cast("double").alias(n) for n, p in probabilities.items()]
    )


# -- top k --------------------------------------------------------------------------------------


def _best_first(score: str, key: str) -> list[Column]:
    return [F.desc(score), F.asc("_word"), F.asc(key)]


def top_k(
    df: DataFrame, score: str, k: int, key: str, one_tile_rows: int = ONE_TILE_ROWS
) -> DataFrame:
    """The k rows with the highest score; ties go to the smaller hash of the unique row key.

    A k that grows with the table is no limit and no sort of k rows in one task: rows are
    kept by comparing them with a cut-off found by ``values_at``.
    """
    present = df.filter(F.col(score).isNotNull())
    hashed = present.withColumn("_word", keys.bucket32(key))
    rows = present.count()
    if k <= 0 or rows <= k:
        return present if k > 0 else present.limit(0)
    if rows <= one_tile_rows:
        return hashed.orderBy(*_best_first(score, key)).limit(k).drop("_word")
    cut = values_at(tile_column(present, score, (), one_tile_rows), [rows - k]).first()
    needed = k - (rows - cut["_below"] - cut["_equal"])
    cut_score = F.lit(cut[score])
    if needed == cut["_equal"]:
        return present.filter(F.col(score) >= cut_score)

    ties = hashed.filter(F.col(score) == cut_score)
    tie = values_at(tile_column(ties, "_word", (), one_tile_rows), [needed - 1]).first()
    last = needed - tie["_below"]
    certain = (F.col(score) > cut_score) | ((F.col(score) == cut_score) & (F.col("_word") < tie["_word"]))
    # Rows that agree in score and in the 32-bit hash: about one per four billion ties.
    collided = ties.filter(F.col("_word") == tie["_word"])
    if last < tie["_equal"]:
        collided = collided.orderBy(key).limit(last)
    return hashed.filter(certain).unionByName(collided).drop("_word")


def top_k_flags(
    df: DataFrame,
    score: str,
    sizes: DataFrame,
    key: str,
    by: Sequence[str],
    one_tile_rows: int = ONE_TILE_ROWS,
) -> DataFrame:
    """Adds ``_top`` (1/0): whether the row is among its group's ``_k`` highest scores.

    ``sizes`` holds ``(*by, _k)``.  Same tie rule as ``top_k``.
    """
    columns = df.columns
    sizes = grouped(sizes, by)[0].drop(*by)
    df, by = grouped(df, by)
    hashed = df.withColumn("_word", keys.bucket32(key))
    if df.count() <= one_tile_rows:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*_best_first(score, key)))
        top = F.col(score).isNotNull() & (place <= F.col("_k"))
        ranked = hashed.join(pin_if_small(sizes), by, "left")
        return ranked.withColumn("_top", F.coalesce(top, F.lit(False)).cast("int")).select(*columns, "_top")

    tiled = tile_column(df, score, by, one_tile_rows)
    ranks = (
        tiled.totals.join(sizes, by)
        .withColumn("_rank", F.greatest(F.col("_total") - F.col("_k"), F.lit(0)))
        .select(*by, "_total", "_k", "_rank")
    )
    cuts = pin_if_small(
        values_at(tiled, ranks.select(*by, "_rank"))
        .join(ranks, [*by, "_rank"])
        .select(
            *by,
            F.col(score).alias("_cut"),
            F.col("_equal").alias("_ties"),
            (F.col("_k") - (F.col("_total") - F.col("_below") - F.col("_equal"))).alias("_need"),
        )
    )
    joined = hashed.join(cuts, by, "left")
    tie = (F.col(score) == F.col("_cut")) & (F.col("_need") < F.col("_ties"))
    by_hash = F.lit(False)
    split_groups = cuts.filter(F.col("_need") < F.col("_ties"))
    if not split_groups.isEmpty():
        ties = joined.filter(tie).select(*by, key, "_word")
        last_ranks = split_groups.select(*by, (F.col("_need") - 1).alias("_rank"))
        words = pin_if_small(
            values_at(tile_column(ties, "_word", by, one_tile_rows), last_ranks)
            .join(split_groups, by)
            .select(
                *by,
                F.col("_word").alias("_last_word"),
                (F.col("_need") - F.col("_below")).alias("_last"),
                F.col("_equal").alias("_collided"),
            )
        )
        # Only rows equal in score and 32-bit hash are ranked by the key itself.
        won = pin_if_small(
            ties.join(words.filter(F.col("_last") < F.col("_collided")), by)
            .filter(F.col("_word") == F.col("_last_word"))
            .withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(key)))
            .filter(F.col("_place") <= F.col("_last"))
            .select(*by, key, F.lit(True).alias("_won"))
        )
        joined = joined.join(words, by, "left").join(won, [*by, key], "left")
        settled = (F.col("_last") >= F.col("_collided")) | F.coalesce("_won", F.lit(False))
        by_hash = (F.col("_word") < F.col("_last_word")) | (
            (F.col("_word") == F.col("_last_word")) & settled
        )
    top = (F.col(score) > F.col("_cut")) | (
        (F.col(score) == F.col("_cut")) & ((F.col("_need") >= F.col("_ties")) | by_hash)
    )
    return joined.withColumn("_top", F.coalesce(top, F.lit(False)).cast("int")).select(*columns, "_top")


# -- full ranking -------------------------------------------------------------------------------


def counts_below(
    df: DataFrame,
    value: str,
    amounts: dict[str, Column],
    by: Sequence[str] = (),
    one_tile_rows: int = ONE_TILE_ROWS,
) -> DataFrame:
    """Per distinct value: the summed amounts and their sums over all smaller values.

    ``amounts`` maps a name to an expression; each gives columns ``<name>`` and
    ``<name>_below``.  Values are summed map-side first, then ranked range by range.
    """
    names = list(amounts)
    groups = [F.col(GROUP)[c].alias(c) for c in by]
    present, by = grouped(df.filter(F.col(value).isNotNull()), by)
    counted = present.groupBy(*by, value).agg(*[F.sum(expr).alias(name) for name, expr in amounts.items()])
    below = running_sums(stage_table(counted, "distinct-values"), value, names, by, one_tile_rows)
    return below.select(*groups, value, *names, *[f"{n}_below" for n in names])


def value_ranges(distinct: DataFrame, value: str, by: Sequence[str], task_rows: int) -> DataFrame:
    """Adds ``_task``: rows in the order of group and value, cut into ranges of about ``task_rows``.

    The ranges follow the rows, not the values: however densely values lie, each range is one task's.
    """
    rows = distinct.count()
    if rows <= task_rows:
        return distinct.withColumn("_task", F.lit(0))
    dealt = distinct.repartitionByRange(-(-rows // task_rows), *by, value)
    return stage_table(dealt.withColumn("_task", F.spark_partition_id()), "value-ranges")


def running_sums(distinct: DataFrame, value: str, names: Sequence[str], by: Sequence[str], task_rows: int) -> DataFrame:
    """Adds ``<name>_below`` for each amount: its sum over the group's smaller values.

    ``distinct`` is a staged table with one row per group and value.  A range starts from the sums of
    the ranges before it, so no task holds a whole group.
    """
    placed = value_ranges(distinct, value, by, task_rows)
    task_key = [*by, "_task"]
    starts = placed.groupBy(*task_key).agg(*[F.sum(n).alias(n) for n in names])
    starts = pin_if_small(starts.select(*task_key, *[rows_before(n, "_task", by).alias(f"_{n}_start") for n in names]))
    inside = placed.select("*", *[rows_before(n, value, task_key).alias(f"_{n}_inside") for n in names])
    joined = inside.join(starts, task_key)
    return joined.select(
        *distinct.columns, *[(F.col(f"_{n}_start") + F.col(f"_{n}_inside")).alias(f"{n}_below") for n in names]
    )
