from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from gaugeline.llm import sharding


def least_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity under which greedy contiguous shards suffice; larger groups stand alone."""
    for capacity in sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)}):
        used, at = 0, 0
        while at < len(sizes):
            used += 1
            total, start = sizes[at], at
            at += 1
            while total <= capacity and at < len(sizes) and total + sizes[at] <= capacity:
                total += sizes[at]
                at += 1
            del start
        if used <= shards:
            return capacity
    raise AssertionError


@pytest.mark.parametrize("blocks", [2, 4, 1 << 16])
def test_cuts_match_brute_force(spark, monkeypatch, blocks):
    """Also where few ranges are seen at a time, so that they are divided over several passes."""
    monkeypatch.setattr(sharding, "MOST_BLOCKS", blocks)
    monkeypatch.setattr(sharding, "FIRST_BITS", blocks.bit_length() - 1)
    rng = random.Random(blocks)
    for shards in (1, 3, 7):
        keys = list({rng.getrandbits(63) for _ in range(30)})
        sizes = [rng.randint(8, 60) for _ in keys]
        sizes[4] = 500
        rows = sorted(zip(keys, sizes, strict=True))
        cuts = sharding.minimax_cuts(spark.createDataFrame(rows, "key long, size long"), shards)
        assert len(cuts) <= shards - 1
        parts = defaultdict(list)
        for k, s in rows:
            parts[sum(k >= c for c in cuts)].append(s)
        best = least_capacity([s for _, s in rows], shards)
        assert all(sum(p) <= best or len(p) == 1 for p in parts.values())


def test_documents(docs, by_id, no_docs):
    rows = sharding.shard_documents(docs, 6).collect()
    assert len(rows) == len(by_id)
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in rows:
        body = by_id[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(body) + 8, zlib.crc32(body))
        slots[r.shard].append(r.slot)
        of_text[body].add(r.shard)
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(6))
    assert sharding.shard_documents(no_docs, 6).count() == 0


def test_repeated_rows_and_one_text(spark):
    rows = [(1, "a")] * 5 + [(None, "a")] * 3
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert sorted(r.slot for r in found) == list(range(8)) and {r.shard for r in found} == {0}
