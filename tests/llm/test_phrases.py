from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import phrases, word_arrays


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(rows: list[tuple], support: int, top: int, most: int = 5) -> tuple[dict, list]:
    """Counts of frequent phrases and the ranked collocations, by the definition."""
    count: Counter = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text or "")):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            for i in range(len(words)):
                for k in range(1, min(most, len(words) - i) + 1):
                    count[lang or "und", tuple(words[i : i + k])] += 1
    sizes = Counter()
    for (lang, p), n in count.items():
        sizes[lang] += n if len(p) == 1 else 0
    often = {key: n for key, n in count.items() if n >= support}
    scored: dict = {}
    for (lang, p), a in often.items():
        inside = [
            q for (other, q), b in often.items() if other == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ]
        if len(p) < 2 or inside:
            continue
        cuts = [(1000 * a * sizes[lang] // (often[lang, p[:k]] * often[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        scored.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), often[lang, p[:k]], often[lang, p[k:]]))
    out = [
        (lang, i + 1, p.decode(), -a, l, r, sizes[lang], -s) for lang, found in scored.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    ]
    return often, sorted(out)


def sample(texts: list) -> list[tuple]:
    rng = random.Random(4)
    words = ["Alpha", "beta", "gamma", "delta", "Ünder", "北京", "x"]
    prose = [" ".join(rng.choices(words, weights=[9, 7, 5, 4, 2, 2, 1], k=rng.randint(2, 40))).replace("x", "x.") for _ in range(300)]
    rows = [(rng.choice(["en", "de", None, "und"]), t) for t in prose]
    return rows + [("en", t) for t in texts] + [("fr", "the same page again and again, every time\nthe same page")] * 40


@pytest.mark.parametrize(("parts", "shard_bytes"), [(1, 1 << 25), (7, 700)])
def test_matches_brute_force(spark, texts, monkeypatch, parts, shard_bytes):
    """Many shards, their size and the languages they hold change nothing."""
    monkeypatch.setattr(phrases, "PLACES", 1 << 20 if parts == 1 else 50)
    rows = sample(texts)
    frame = spark.createDataFrame([(i % 3, lang, t, 1, "p", 5) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, n long, phrase string, hash long")
    often, ranked = plain(rows, 20, 25)
    found = phrases.frequent_phrases(frame.repartition(parts), 20, shard_bytes=shard_bytes)
    counted = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.collect() if r.words}
    assert counted == often
    got = sorted(tuple(r) for r in phrases.collocations(found, 25).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == ranked


def test_shards_prune(spark, texts):
    """What a shard returns is a small part of all its phrases."""
    batch = phrases.pa.RecordBatch.from_pylist([{"lang": "en", "text": t or "", "lang_bytes": 10**5} for t in texts])
    mined = sum(b.num_rows for b in phrases._mine(20, 5, 1 << 25)(iter([batch])))
    everything = sum(b.num_rows for b in phrases._mine(1, 5, 1 << 25)(iter([batch])))
    assert 0 < mined < everything / 5


def test_union_holds_every_frequent_phrase_and_few_more(spark, texts, monkeypatch):
    """Counted by the filter's members: at most a third of what the shards return is counted again."""
    rows = sample(texts)
    frame = spark.createDataFrame([(lang, t) for lang, t in rows], "lang string, text string").repartition(6)
    kept, held = [], phrases.bloom_filter
    monkeypatch.setattr(phrases, "bloom_filter", lambda hashes, bits: kept.append(hashes.count()) or held(hashes, bits))
    monkeypatch.setattr(phrases, "LEAST_LOCAL", 1)
    often = plain(rows, 20, 25)[0]
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in phrases.frequent_phrases(frame, 20).collect() if r.words} == often
    assert len(often) <= kept[0] < 3 * len(often)


@pytest.mark.parametrize("most", [1, 3, 7])
def test_many_shards_are_mined_level_by_level(spark, texts, monkeypatch, most):
    """A shard at a support near one would return every phrase; counts over all shards rule them out length by length."""
    rows = sample(texts)
    frame = spark.createDataFrame([(lang, t) for lang, t in rows], "lang string, text string").repartition(6)
    kept, held = [], phrases.bloom_filter
    monkeypatch.setattr(phrases, "bloom_filter", lambda hashes, bits: kept.append(hashes.count()) or held(hashes, bits))
    monkeypatch.setattr(phrases, "_mine", lambda *_: pytest.fail("mined at a support near one"))
    often = plain(rows, 20, 25, most)[0]
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in phrases.frequent_phrases(frame, 20, most, shard_bytes=4000).collect() if r.words} == often
    assert kept[-1] == len(often)  # the filter of the counting pass holds nothing else


def test_levels_look_only_where_shorter_parts_are_frequent(spark, texts):
    """Triples returned at a pass are those whose pairs are in the filter."""
    batch = phrases.pa.RecordBatch.from_pylist([{"lang": "en", "text": t or ""} for t in texts])
    full, empty = (np.full(64, fill, np.uint8) for fill in (255, 0))
    held = [{n: type("Held", (), {"value": bits}) for n in (1, 2)} for bits in (full, empty)]
    returned = [sum(b.num_rows for b in phrases._mine_levels((3,), 1 << 25, h)(iter([batch]))) for h in held]
    assert returned[0] > 0 and returned[1] == 0


def test_filter_holds_every_member(spark):
    hashes = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 4000)
    held = phrases.bloom_filter(spark.createDataFrame([(int(h),) for h in hashes], "hash long"), 1 << 16)
    assert phrases.in_filter(held, hashes.view(np.uint64)).all()
    others = np.random.default_rng(8).integers(0, 1 << 62, 4000).view(np.uint64)
    assert phrases.in_filter(held, others).mean() < 0.05


def test_false_positives_change_nothing(spark, texts, monkeypatch):
    rows = sample(texts)
    frame = spark.createDataFrame([(lang, t) for lang, t in rows], "lang string, text string")
    monkeypatch.setattr(phrases, "BITS_EACH", 1)
    found = phrases.frequent_phrases(frame, 20)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in found.collect() if r.words} == plain(rows, 20, 25)[0]


def test_no_rows_and_large_products(spark, no_docs):
    assert phrases.collocations(phrases.frequent_phrases(no_docs, 3), 10).count() == 0
    big = 10**14
    frame = spark.createDataFrame([("en", 0, "", big), ("en", 1, "a", 10**12), ("en", 1, "b", 10**12), ("en", 2, "a b", 10**12 - 1)], "lang string, words int, phrase string, n long")
    (row,) = phrases.collocations(frame, 10).collect()
    assert row.score == 1000 * (10**12 - 1) * big // 10**24


def test_words_and_hashes_are_those_of_a_plain_split(texts):
    """Also over slices, in texts of megabytes and with very long words."""
    rng = random.Random(2)
    long_text = " ".join("".join(rng.choices("abcXYZ\t\x85ü", k=rng.randint(1, 30))) for _ in range(150_000)) + " " + "q" * 700_000 + " " + "ab" * 3000
    data, places = word_arrays.joined([t.encode() if t else None for t in [*texts, long_text]])
    starts, ends, hashes = word_arrays.words(data, word_arrays.byte_set(" \t\n\r\x0b\x0c"))
    found = [word_arrays.lower(data[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    assert found == data.lower().split()
    by_word = dict(zip(found, hashes.tolist(), strict=True))
    assert len(set(by_word.values())) == len(by_word)
    assert all(by_word[w] == h for w, h in zip(found, hashes.tolist(), strict=True))
