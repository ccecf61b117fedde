from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import negatives

SCALE = 256


def plain(rows: list, every: int, positives: int, count: int, low: int) -> list:
    usable = [
        (i, label, tuple(math.floor(SCALE * x) for x in v))
        for i, v, label, *_ in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, label, q in sorted({u for u in usable if u[0] % every == 0}):
        scored = [(-sum(a * b for a, b in zip(q, v, strict=True)), j, other) for j, other, v in usable if j != i and len(v) == len(q)]
        same = sorted((s, j) for s, j, other in scored if other == label)[:positives]
        for s, j in same:
            found = sorted((t, h) for t, h, other in scored if other != label and low * -s <= 100 * -t <= 100 * -s)[:count]
            out += [(i, j, n + 1, h, -s, -t) for n, (t, h) in enumerate(found)]
    return sorted(out)


def awkward(rng: random.Random) -> list:
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(10)], rng.randrange(4), "x") for i in range(500)]
    rows += [(1000 + i, rows[i % 5][1], i % 3, "copy") for i in range(80)]  # copies and ties
    rows += [(3000 + i, [0.5] * 10, i % 2, "hot") for i in range(150)]
    rows += [(20, rows[20][1], rows[20][2], "again"), (40, rows[7][1], 3, "other vector"), (60, rows[60][1], 9, "other label")]
    rows += [(5000, None, 1, ""), (5020, [None] * 10, 1, ""), (5040, [math.nan] * 10, 1, ""), (5060, [math.inf] + [0.0] * 9, 1, "")]
    rows += [(None, [0.1] * 10, 1, ""), (5080, [0.2] * 10, None, ""), (5100, [0.0] * 10, 1, ""), (5120, [], 1, ""), (5140, [], 2, "")]
    rows += [(5160, [1.0, 2.0], 1, ""), (5161, [2.0, 1.0], 1, ""), (5162, [2.0, 1.0], 2, ""), (5163, [-9.0, 0.0], 1, "")]
    return rows


@pytest.mark.parametrize(("block", "group"), [(8_192, 4_096), (40, 7)])
def test_matches_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(negatives, "ANCHOR_GROUP", group)
    rows = awkward(random.Random(3))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, block string").repartition(4)
    usable = negatives.usable_rows(frame, SCALE)
    found = negatives.hard_negatives(usable, F.col("vec_id") % 20 == 0, 5, 5, 80, block=block)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 20, 5, 5, 80)


def test_tree_covers_its_rows():
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.integers(-300, 300, (700, 8)), np.repeat(rng.integers(-300, 300, (1, 8)), 90, axis=0), np.zeros((3, 8), np.int64)])
    tree = negatives.build_tree(vectors)
    units, _ = negatives.unit_rows(vectors)
    assert sorted(tree["order"]) == list(range(len(vectors)))
    for node in range(len(tree["centre"])):
        rows = tree["order"][tree["begin"][node] : tree["end"][node]]
        reach = negatives.angle(units[rows] @ units[tree["centre"][node]])
        assert reach.max() <= tree["spread"][node] + 1e-7
        kids = range(tree["first"][node], tree["last"][node])
        if kids:
            assert sum(tree["end"][c] - tree["begin"][c] for c in kids) == len(rows)
            assert max(tree["spread"][c] for c in kids) <= tree["spread"][node] + 1e-7
            proper = [c for c in kids if not tree["pooled"][c]]
            centres = units[tree["centre"][proper]]
            apart = negatives.angle(centres @ centres.T)[np.triu_indices(len(centres), 1)]
            assert apart.min(initial=9) >= max((tree["spread"][c] for c in proper), default=0) - 1e-6  # separation
        else:
            assert len(rows) <= negatives.LEAF or tree["spread"][node] == 0 or tree["pooled"][node]


def searched(vectors: np.ndarray, queries: np.ndarray, low: int, high: int, k: int) -> tuple[list, int]:
    tree, seen = negatives.build_tree(vectors), {}
    count = len(queries)
    window = lambda x: np.full((count, 1), x, np.int64)
    ids = np.arange(len(vectors))
    anchor, _, row, score = negatives.search(
        tree, vectors, ids, np.zeros(len(vectors), np.int64), queries, np.full(count, -1), np.ones(count, np.int64), window(low), window(high), False, k, seen
    )
    return sorted(zip(anchor.tolist(), (-score).tolist(), row.tolist(), strict=True)), seen["verified"]


def test_bounds_skip_most_rows_of_clustered_vectors():
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(40, 16)) * 100
    vectors = np.floor(np.repeat(middles, 100, axis=0) + rng.normal(size=(4000, 16)) * 4).astype(np.int64)
    queries = vectors[::400]
    products = queries @ vectors.T
    for low, high in ((negatives.NO_LOW, negatives.NO_HIGH), (20_000, 60_000)):
        found, verified = searched(vectors, queries, low, high, 5)
        want = [
            (a, s, r)
            for a in range(len(queries))
            for s, r in sorted((-int(p), r) for r, p in enumerate(products[a]) if low <= p <= high)[:5]
        ]
        assert found == want
        assert verified < 0.2 * products.size


def test_scores_beyond_doubles_stay_whole():
    rng = np.random.default_rng(2)
    for size in (1 << 26, 1 << 30):
        vectors, queries = rng.integers(-size, size, (300, 4)), rng.integers(-size, size, (6, 4))
        exact = queries.astype(object) @ vectors.T.astype(object)
        found, _ = searched(vectors, queries, negatives.NO_LOW, negatives.NO_HIGH, 3)
        assert found == [(a, s, r) for a in range(6) for s, r in sorted((-int(p), r) for r, p in enumerate(exact[a]))[:3]]


def test_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(negatives.usable_rows(frame, SCALE), F.col("vec_id") % 20 == 0, 5, 5, 80).count() == 0
