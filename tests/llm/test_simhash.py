from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from gaugeline.llm import simhash


def plain_fingerprint(text: str) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks: dict, max_bits: int) -> dict:
    ids = sorted(marks)
    least = {i: i for i in ids}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (marks[a] ^ marks[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                least[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_documents(docs, by_id, no_docs):
    rows = simhash.near_duplicates(docs, 4, 4).collect()
    marks = {i: plain_fingerprint(t) for i, t in by_id.items()}
    assert {r.doc_id: r.fingerprint & (1 << 64) - 1 for r in rows} == marks
    assert {r.doc_id: r.component_id for r in rows} == plain_components(marks, 4)
    assert simhash.near_duplicates(no_docs, 4, 4).count() == 0


@pytest.mark.parametrize("part", [2_048, 8])
def test_chains_and_dense_balls(spark, monkeypatch, part):
    """Chains of links, a dense ball, pairs at exactly the budget; buckets dealt into small parts."""
    monkeypatch.setattr(simhash, "BUCKET_PART", part)
    rng = random.Random(4)
    marks = [rng.getrandbits(64) for _ in range(150)]
    for m in marks[:20]:
        for _ in range(5):
            m ^= sum(1 << b for b in rng.sample(range(64), rng.choice([3, 4, 4, 5])))
            marks.append(m)
    marks += [marks[50] ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(60)]
    marks = list(dict.fromkeys(marks))
    rows = [(m - (1 << 64) if m >> 63 else m,) for m in marks]
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "fingerprint long"), 4)
    found = {r.node: r.component for r in simhash.components(links).collect()}
    mine = defaultdict(set)
    for (m,) in rows:
        mine[found.get(m, m)].add(m)
    plain = defaultdict(set)
    for i, c in plain_components(dict(enumerate(marks)), 4).items():
        plain[c].add(rows[i][0])
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, plain.values()))


@pytest.mark.parametrize("count", [10, 10**7, 10**10])
def test_buckets_cover_every_pair_within_the_budget(count):
    masks = simhash.bucket_masks(4, count)
    rng = np.random.default_rng(0)
    for _ in range(2000):
        flip = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not m & flip for m in masks)


def test_missing_ids_and_long_texts(spark):
    text = "word " * 200_000 + "end"
    rows = [(None, "a b c d e"), (7, "a b c d e"), (5, text), (None, "lone words of no other text")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 4).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == [("5", "5"), ("7", "7"), ("None", "7"), ("None", "None")]
