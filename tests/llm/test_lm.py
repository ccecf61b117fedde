from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import lm


def tokens(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w] + ["</s>"]


class Plain:
    """The model by its definition, with dictionaries."""

    def __init__(self, texts: list, least: int):
        self.least = least
        self.grams = {n: Counter() for n in (1, 2, 3)}
        self.count: Counter = Counter()
        for t in texts:
            words = tokens(t)
            self.count.update(words)
            run = ["<s>", "<s>", *words]
            self.grams[3].update(zip(run, run[1:], run[2:], strict=False))
        for n in (2, 1):
            self.grams[n].update(g[1:] for g in self.grams[n + 1])
        self.context = {n: defaultdict(list) for n in (1, 2, 3)}
        for n, grams in self.grams.items():
            for g, c in grams.items():
                self.context[n][g[:-1]].append(c)
        self.d = {n: lm.discounts(*(sum(c == i for c in grams.values()) for i in (1, 2, 3, 4))) for n, grams in self.grams.items()}
        self.total, self.words = sum(self.count.values()), len(self.count)

    def p(self, gram: tuple) -> float:
        n = len(gram)
        lower = self.p(gram[1:]) if n > 1 else 1 / (self.words + 1)
        followers = self.context[n].get(gram[:-1])
        if not followers:
            return lower
        least = self.least if n == 3 else 1
        cut = lambda c: self.d[n][min(c, 3)] if c >= least else c
        c = self.grams[n].get(gram, 0)
        return (max(c - cut(c), 0) + sum(map(cut, followers)) * lower) / sum(followers)

    def score(self, text) -> tuple:
        words = tokens(text)
        run = ["<s>", "<s>", *words]
        base = sum(math.log10((self.count[w] + 1) / (self.total + self.words + 1)) for w in words)
        return len(words), sum(self.count[w] > 0 for w in words), base, sum(math.log10(self.p(g)) for g in zip(run, run[1:], run[2:], strict=False))


def held_out(i) -> bool:
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def prose(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    words = ["The", "cat", "dog", "house", "Über", "北京", *(f"w{i}" for i in range(60))]
    after = {w: rng.choices(words, k=6) for w in words}
    out = []
    for _ in range(count):
        run = [rng.choice(words)]
        while len(run) < rng.randint(3, 60):
            run.append(rng.choice(after[run[-1]]) if rng.random() < 0.8 else rng.choice(words))
        out.append(rng.choice([" ", "\n", " \t"]).join(run))
    return out


@pytest.mark.parametrize(("least", "small"), [(1, False), (2, True), (3, False)])
def test_matches_brute_force(spark, texts, monkeypatch, least, small):
    """Also with many parts, buffers and word files."""
    if small:
        monkeypatch.setattr(lm, "PART_TOKENS", 900)
        monkeypatch.setattr(lm, "PART_WORDS", 100)
        monkeypatch.setattr(lm, "BUFFER_BYTES", 500)
    rows = list(enumerate([*texts, *prose(1, 150), "unseen words only qqq zzz"]))
    rows += [(None, "the cat"), (5, texts[5]), (5, texts[5])]
    frame = spark.createDataFrame([(i, t, 1, "x", 7) for i, t in rows], "doc_id long, text string, n_tokens int, lm string, words long").repartition(3)
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    model = lm.train(frame, ~fold, least_trigram=least)
    plain = Plain([t for i, t in rows if not held_out(i)], least)
    assert (model.tokens, model.words) == (plain.total, plain.words)
    found = lm.score(frame, model).select("doc_id", "text", "n_tokens", "lm.*").collect()
    assert len(found) == len(rows)
    for r in found:
        want = plain.score(r.text)
        assert tuple(r[3:5]) == want[:2] and r[2] == 1
        assert r.base_score == pytest.approx(want[2], rel=1e-9) and r.score == pytest.approx(want[3], rel=1e-9)


def test_every_context_adds_up_to_one(spark):
    texts = prose(2, 120)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.train(frame, F.lit(True))
    words = sorted({w for t in texts for w in tokens(t)[:-1]})
    rng = random.Random(4)
    for start in ["", "neverseen the", "the neverseen", *(" ".join(rng.choices(words, k=2)) for _ in range(20))]:
        # Each known word, any unknown one, and the end of the text after the same beginning.
        held = [start.encode()] + [f"{start} {w}".encode() for w in [*words, "unknownword"]]
        found = lm.Tokens(held, model)
        p = lm.probabilities(model, found)
        after = len(tokens(start)) - 1
        assert sum(p[found.first + after]) == pytest.approx(1, abs=1e-9), start


def test_better_than_words_alone_on_texts_held_out(spark):
    rows = list(enumerate(prose(3, 600)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.train(frame, F.col("doc_id") % 5 != 0)
    sums = lm.score(frame, model).filter("doc_id % 5 = 0").agg(F.sum("lm.n_tokens"), F.sum("lm.base_score"), F.sum("lm.score")).first()
    assert sums[2] > sums[1] * 0.8  # log10 probabilities are negative
    assert 10 ** (-sums[2] / sums[0]) < 30


def test_empty_tables(spark, no_docs):
    model = lm.train(no_docs, F.lit(True))
    assert (model.tokens, model.words) == (0, 0) and lm.score(no_docs, model).count() == 0
    (row,) = lm.score(spark.createDataFrame([("any words",)], "text string"), model).select("lm.*").collect()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (3, 0, 0.0, 0.0)


def test_very_long_text(spark):
    text = " ".join(prose(5, 4000)) + " " + "x" * 300_000
    frame = spark.createDataFrame([(1, text), (2, None), (3, "the cat")], "doc_id long, text string")
    model = lm.train(frame, F.lit(True))
    plain = Plain([text, None, "the cat"], lm.LEAST_TRIGRAM)
    for r in lm.score(frame, model).select("text", "lm.*").collect():
        assert r.score == pytest.approx(plain.score(r.text)[3], rel=1e-9)


def test_folder_must_be_mounted():
    assert lm.mounted("file:///shared/x") == "/shared/x" and lm.mounted("/shared/x") == "/shared/x"
    with pytest.raises(ValueError):
        lm.mounted("store://bucket/x")
