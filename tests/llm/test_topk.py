from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import topk


def plain(rows: list, k: int) -> dict:
    usable = [
        (i, [math.floor(64 * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for i, q in usable:
        if i % 20 == 0:
            scores = [(-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in usable if j != i and len(v) == len(q)]
            for n, (s, j) in enumerate(sorted(scores)[:k]):
                out[i, n + 1] = (j, -s)
    return out


@pytest.mark.parametrize("block", [8_192, 64])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)], "x", 0) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1], "copy", 0) for i in range(60)]
    rows += [(2000, None, "", 0), (2020, [None] * 12, "", 0), (2040, [float("nan")] * 12, "", 0), (2060, [math.inf] * 12, "", 0)]
    rows += [(2080, [0.0] * 12, "", 0), (2100, [1.0, 2.0], "", 0), (2101, [3.0, 1.0], "", 0), (None, [0.1] * 12, "", 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim string, block int").repartition(3)
    found = topk.top_k(frame, F.col("vec_id") % 20 == 0, 20, 64).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found} == plain(rows, 20)


def test_early_stops_and_large_numbers():
    """Few strong components let queries stop early; scores beyond doubles stay whole."""
    rng = np.random.default_rng(1)
    vectors = np.zeros((3000, 6), np.int64)
    vectors[np.arange(3000), rng.integers(0, 6, 3000)] = rng.integers(1, 10**6, 3000)
    for factor in (1, 10**7):
        queries = rng.integers(-5, 6, (15, 6)) * factor
        place, candidate, score = topk.block_best(queries, np.full(15, -1), vectors * factor, np.arange(3000), 5)
        exact = queries.astype(object) @ vectors.T.astype(object) * factor
        for p in range(15):
            mine = sorted(score[place == p], reverse=True)[:5]
            assert [int(s) for s in mine] == sorted(exact[p], reverse=True)[:5]
        assert len(place) < 15 * 3000


def test_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, F.col("vec_id") % 20 == 0, 20, 64).count() == 0
