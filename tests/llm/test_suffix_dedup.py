from __future__ import annotations

import hashlib
import random

import pytest

from gaugeline.llm import suffix_dedup
from gaugeline.sources.workspace import stage_table


def plain(by_id: dict, match: int = 50) -> dict:
    first: dict[bytes, int] = {}
    for i in sorted(by_id):
        body = by_id[i].encode()
        for p in range(len(body) - match + 1):
            first.setdefault(body[p : p + match], i)
    out = {}
    for i, text in by_id.items():
        body = text.encode()
        gone = bytearray(len(body))
        for p in range(len(body) - match + 1):
            if first[body[p : p + match]] < i:
                gone[p : p + match] = b"\1" * match
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        out[i] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def result(frame) -> dict:
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in frame.collect()}


def test_documents(docs, by_id, no_docs):
    assert result(suffix_dedup.remove_repeats(docs)) == plain(by_id)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_shared_passages(spark, monkeypatch, small):
    """Passages at all offsets, exactly at and just under the match length, periodic texts and zero bytes."""
    if small:
        monkeypatch.setattr(suffix_dedup, "BUFFER_BYTES", 700)
        monkeypatch.setattr(suffix_dedup, "PART_BYTES", 2_000)
        monkeypatch.setattr(suffix_dedup, "LOCAL_RUNS", 2)
        monkeypatch.setattr(suffix_dedup, "ALL_RUNS", 5)
        monkeypatch.setattr(suffix_dedup, "SORT_RUNS", 16)
    rng = random.Random(11)
    junk = lambda n: "".join(rng.choices("abcdefgh é\0\n", k=n))
    common = [junk(n) for n in (45, 49, 50, 51, 60, 90, 300)]
    texts = ["ab" * 60, "ba" * 55, "a" * 200, "a" * 49, "a" * 50 + "b" * 50, "b" * 70, ""]
    for _ in range(90):
        parts = [junk(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(common), junk(rng.choice([0, 0, 1, 5, 60]))]
        texts.append("".join(parts))
    texts += texts[10:20]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    frame = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    assert result(suffix_dedup.remove_repeats(frame)) == plain(dict(zip(ids, texts, strict=True)))


def test_equal_and_missing_ids(spark):
    text = "some passage that is longer than fifty bytes, to be found again later on"
    rows = [(4, text), (4, text), (None, text), (None, "x" + text), (9, text + "!")]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("4", 0), ("4", 0), ("9", 72), ("None", 72), ("None", 72)]


def test_spans_are_not_staged(spark, monkeypatch):
    staged = []

    def stage(df, purpose):
        staged.append(purpose)
        return stage_table(df, purpose)

    monkeypatch.setattr(suffix_dedup, "stage_table", stage)
    by_id = {1: "x" * 10 + "abcdefghij" * 6, 2: "abcdefghij" * 6 + "y" * 60, 3: None, 4: "y" * 55}
    frame = spark.createDataFrame(list(by_id.items()), "doc_id long, text string")
    assert result(suffix_dedup.remove_repeats(frame)) == plain({i: t or "" for i, t in by_id.items()})
    assert staged == ["buffers", "answers", "edges"]
