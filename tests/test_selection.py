"""Order statistics against brute force, with the tile path forced on small data."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.functions import keys
from gaugeline.operators import selection
from tests.conftest import plan_of

SMALL, TILED = 1_000_000, 50


def frame(spark, values, groups=None):
    groups = groups if groups is not None else ["g"] * len(values)
    rows = [(f"k{i}", g, None if v is None else float(v)) for i, (g, v) in enumerate(zip(groups, values))]
    return spark.createDataFrame(rows, "key string, g string, v double").repartition(3)


def shapes(n=1500):
    rng = np.random.default_rng(1)
    return {
        "distinct": rng.normal(size=n),
        "a third equal": np.where(np.arange(n) % 3 == 0, 5.0, rng.normal(size=n) * 10),
        "few values": rng.integers(0, 4, n).astype(float),
        "constant": np.ones(n),
        "heavy tail": np.exp(rng.normal(size=n) * 8),
    }


@pytest.mark.parametrize("shape", ["distinct", "a third equal", "heavy tail"])
@pytest.mark.parametrize("limit", [SMALL, TILED])
def test_quantiles_equal_numpy(spark, shape, limit):
    values = shapes()[shape]
    probabilities = [0.0, 0.3, 0.6, 0.95, 1.0]
    found = selection.quantile_values(frame(spark, values), "v", probabilities, limit)
    assert np.allclose(found, np.quantile(values, probabilities), rtol=1e-12)


@pytest.mark.parametrize("limit", [SMALL, 20])
def test_quantiles_by_group_ignore_nulls(spark, limit):
    rng = np.random.default_rng(2)
    groups = np.where(np.arange(600) % 7 == 0, "small", "large")
    values = [None if i % 11 == 0 else v for i, v in enumerate(rng.normal(size=600))]
    found = selection.quantiles_by(frame(spark, values, groups.tolist()), "v", {"a": 0.25, "b": 0.99}, ["g"], limit)
    for row in found.collect():
        mine = [v for v, g in zip(values, groups, strict=True) if g == row["g"] and v is not None]
        assert np.allclose([row["a"], row["b"]], np.quantile(mine, [0.25, 0.99]), rtol=1e-12)
    assert found.count() == 2


def test_quantiles_of_nothing(spark):
    assert selection.quantile_values(frame(spark, [None, None]), "v", [0.5]) == []
    assert selection.quantile_values(frame(spark, []), "v", [0.5], 0) == []


@pytest.mark.parametrize("limit", [SMALL, 20])
def test_joint_quantiles_of_columns_and_groups(spark, limit):
    rng = np.random.default_rng(6)
    n = 3000
    columns = {"a": rng.normal(size=n), "b": np.where(np.arange(n) % 3 == 0, 7.0, rng.exponential(size=n) * 1e6), "c": rng.integers(-3, 3, n) * 1.0}
    rows = [
        (None if i % 4 == 0 else f"g{i % 2}", *(None if (i + j) % 13 == 0 else float(v[i]) for j, v in enumerate(columns.values()))) for i in range(n)
    ]
    df = spark.createDataFrame(rows + [("empty", None, None, None)], "g string, a double, b double, c double").repartition(5)
    asked = {c: {f"{c}{i}": p for i, p in enumerate((0.0, 0.013, 0.5, 0.95, 1.0))} for c in columns}
    found = selection.joint_quantiles(df, asked, ["g"], {"rows": F.count(F.lit(1))}, limit).collect()
    assert {r["g"] for r in found} == {None, "g0", "g1", "empty"} and sum(r["rows"] for r in found) == n + 1
    for r in found:
        for j, c in enumerate(columns):
            mine = [row[1 + j] for row in rows if row[0] == r["g"] and row[1 + j] is not None]
            for name, p in asked[c].items():
                assert r[name] is None if not mine else r[name] == pytest.approx(np.quantile(mine, p), rel=1e-12), (r["g"], name)


@pytest.mark.parametrize("limit", [SMALL, 500])
def test_joint_quantiles_read_the_table_three_times_at_most(spark, tmp_path, monkeypatch, limit):
    """Whatever the number of columns and quantiles; counted where the frames that read it are run."""
    columns = [f"c{i}" for i in range(8)]
    spark.range(4000).select(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100_000)).alias(c) for i, c in enumerate(columns)]).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    scans = []
    reads = lambda df: len(re.findall(r"FileScan parquet \[c\d", plan_of(df)))
    for name in ("pin_if_small", "stage_table"):
        original = getattr(selection, name)
        monkeypatch.setattr(selection, name, lambda df, *a, run=original: scans.append(reads(df)) or run(df, *a))
    found = selection.joint_quantiles(table, {c: {f"{c}_{p}": p for p in (0.1, 0.5, 0.9)} for c in columns}, one_tile_rows=limit)
    assert sum(scans) + reads(found) == (3 if limit == 500 else 1)
    assert found.count() == 1


def test_a_bracket_that_misses_is_opened(spark, monkeypatch):
    monkeypatch.setattr(selection, "_bracket", lambda p: (0.9, 0.95))  # a sketch that is far off
    values = shapes(800)["distinct"]
    found = selection.quantile_values(frame(spark, values), "v", [0.1, 0.5], 20)
    assert np.allclose(found, np.quantile(values, [0.1, 0.5]), rtol=1e-12)


def test_dense_values_are_ranked_in_bounded_tasks(spark):
    """Nine tenths of the distinct values lie within a millionth of the range."""
    values = np.concatenate([np.arange(900) * 1e-9, np.linspace(1, 100, 100)])
    df = frame(spark, values)
    distinct = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    placed = selection.value_ranges(distinct, "v", [], 50)
    sizes = [r["count"] for r in placed.groupBy("_task").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 200 and len(sizes) >= 10
    both = [
        sorted((r["v"], r["n_below"]) for r in selection.counts_below(df, "v", {"n": F.lit(1)}, (), limit).collect()) for limit in (SMALL, 50)
    ]
    assert both[0] == both[1] == [(float(v), i) for i, v in enumerate(np.sort(values))]


def test_infinite_and_negative_values_keep_their_order(spark):
    values = [float("-inf"), -3.0, -3.0, 0.0, 1.0, float("inf")] * 20
    found = selection.quantile_values(frame(spark, values), "v", [0.0, 0.5, 1.0], 10)
    assert found == [float("-inf"), -1.5, float("inf")]


def ranked(pairs):
    """Keys best first: higher score, then smaller hash word, then key."""
    import hashlib

    def order(item):
        key, score = item
        return (-score, hashlib.md5(key.encode()).hexdigest()[:8], key)

    return [key for key, _ in sorted(pairs, key=order)]


@pytest.mark.parametrize("shape", ["distinct", "a third equal", "constant"])
@pytest.mark.parametrize("k", [1, 137, 5000])
@pytest.mark.parametrize("limit", [SMALL, TILED])
def test_top_k_is_exact_under_ties(spark, shape, k, limit):
    values = shapes(800)[shape]
    found = selection.top_k(frame(spark, values), "v", k, "key", limit)
    expected = ranked([(f"k{i}", v) for i, v in enumerate(values)])[:k]
    assert sorted(r["key"] for r in found.collect()) == sorted(expected)


@pytest.mark.parametrize("limit", [SMALL, TILED])
def test_top_k_flags_per_group(spark, limit):
    values = shapes(900)["a third equal"]
    groups = [("a", "b", "c")[i % 5 % 3] for i in range(900)]
    sizes = {"a": 200, "b": 1, "c": 999}
    sizes_df = spark.createDataFrame(list(sizes.items()), "g string, _k long")
    flagged = selection.top_k_flags(frame(spark, values, groups), "v", sizes_df, "key", ["g"], limit)
    assert flagged.columns == ["key", "g", "v", "_top"]
    assert flagged.count() == 900
    for g, k in sizes.items():
        mine = [(f"k{i}", v) for i, (v, x) in enumerate(zip(values, groups, strict=True)) if x == g]
        found = {r["key"] for r in flagged.filter((F.col("g") == g) & (F.col("_top") == 1)).collect()}
        assert found == set(ranked(mine)[:k])


def test_equal_hash_words_are_ranked_by_key(spark, monkeypatch):
    monkeypatch.setattr(keys, "bucket32", lambda key, *salts: F.lit(7).cast("bigint"))
    df = frame(spark, [1.0] * 200)
    expected = sorted(f"k{i}" for i in range(200))[:30]
    assert sorted(r["key"] for r in selection.top_k(df, "v", 30, "key", 50).collect()) == expected
    sizes = spark.createDataFrame([("g", 30)], "g string, _k long")
    flagged = selection.top_k_flags(df, "v", sizes, "key", ["g"], 50)
    assert sorted(r["key"] for r in flagged.filter("_top = 1").collect()) == expected


@pytest.mark.parametrize("limit", [SMALL, TILED])
@pytest.mark.parametrize("shape", ["distinct", "few values", "heavy tail"])
def test_counts_below(spark, limit, shape):
    values = shapes(700)[shape]
    groups = [("a", "b")[i % 3 == 0] for i in range(700)]
    found = selection.counts_below(frame(spark, values, groups), "v", {"n": F.lit(1)}, ["g"], limit)
    rows = found.collect()
    assert sum(r["n"] for r in rows) == 700
    by_group = {g: np.array([v for v, x in zip(values, groups, strict=True) if x == g]) for g in "ab"}
    for r in rows:
        assert r["n_below"] == (by_group[r["g"]] < r["v"]).sum()


def test_tile_path_never_windows_the_whole_table(spark):
    tiled = selection.tile_column(frame(spark, shapes(2000)["distinct"]), "v", (), TILED)
    assert tiled.starts.count() > 10
    assert max(r["_rows"] for r in tiled.starts.collect()) < 400
    assert tiled.totals.first()["_total"] == 2000


@pytest.mark.parametrize("shape", ["distinct", "a third equal", "constant"])
def test_tiles_too_large_are_cut_again(spark, shape, monkeypatch):
    monkeypatch.setattr(selection, "SELECTION_TILES", 4)
    values = shapes(1200)[shape]
    found = selection.quantile_values(frame(spark, values), "v", [0.1, 0.5, 0.999], 20)
    assert np.allclose(found, np.quantile(values, [0.1, 0.5, 0.999]), rtol=1e-12)


def test_sketch_quantiles_are_within_their_error(spark):
    values = shapes(5000)["distinct"]
    found = selection.approx_quantiles_by(frame(spark, values), "v", {"q": 0.9}, ["g"], 1000).first()["q"]
    assert abs((values <= found).mean() - 0.9) <= 0.002


def test_null_groups_are_kept_on_both_paths(spark):
    rows = spark.range(6000).selectExpr(
        "CAST(id AS STRING) AS key",
        "IF(id % 3 = 0, NULL, CAST(id % 3 AS STRING)) AS g",
        "CAST((id * 7919) % 2003 AS DOUBLE) AS score",
        "CAST(id % 5 = 0 AS INT) AS label",
    )
    sizes = rows.groupBy("g").agg((F.sum("label") + 1).alias("_k"))
    amounts = {"n": F.lit(1), "hits": F.col("label")}
    results = []
    for one_tile_rows in (1_000_000, 200):
        quantiles = selection.quantiles_by(rows, "score", {"p50": 0.5, "p99": 0.99}, ["g"], one_tile_rows)
        below = selection.counts_below(rows, "score", amounts, ["g"], one_tile_rows)
        flags = selection.top_k_flags(rows, "score", sizes, "key", ["g"], one_tile_rows).filter("_top = 1")
        results.append([sorted(map(repr, frame.collect())) for frame in (quantiles, below, flags.select("g", "key"))])
    assert results[0] == results[1]
    assert any("g=None" in row for part in results[0] for row in part)
    assert len(results[0][0]) == 3
    assert len(results[0][2]) == sum(row["_k"] for row in sizes.collect())
