from __future__ import annotations

import re
from collections import Counter

from gaugeline.llm import quality_rules
from tests.conftest import plan_of


def measures(text: str) -> tuple:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


def test_measures_match_brute_force(docs, by_id):
    found = quality_rules.judge(docs, out="size")  # replaces the clashing column
    rows = found.select("doc_id", "size.*").collect()
    assert len(rows) == len(by_id)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == measures(by_id[r.doc_id]), by_id[r.doc_id][:80]
        assert not (r.base_failed and r.kept)
        assert r.kept == (not r.failed_rules)


def test_no_rows_and_clean_prose(spark, no_docs):
    assert quality_rules.judge(no_docs).count() == 0
    clean = "The cat sat on the mat and looked at the birds that were singing in the old garden."
    junk = "ca*** mat%%% bird### tree$$$ sing&&& old*** roof%%% barn### door$$$ wall&&& lamp***"
    kept = quality_rules.judge(spark.createDataFrame([(clean,), (junk,)], "text string")).select("quality.kept").collect()
    assert [r.kept for r in kept] == [True, False]


def test_one_projection_without_user_functions_or_shuffle(spark, sf_dir):
    text = plan_of(quality_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_languages_without_stop_words(spark):
    polish = "Stary ogród za domem był pełen jabłoni, których gałęzie uginały się pod ciężarem dojrzałych owoców każdej jesieni."
    langs = ["pl", "PL-pl", "en", "de_AT", None, "", "tr"]
    frame = spark.createDataFrame([(x, polish) for x in langs], "lang string, text string")
    rows = {r.lang: r for r in quality_rules.judge(frame).select("lang", "quality.*").collect()}
    assert {x for x, r in rows.items() if r.kept} == {"pl", "PL-pl", "tr"}
    assert all(r.failed_rules == ["stop_word_share"] for r in rows.values() if not r.kept)
    assert rows["pl"].n_stop_words is None and rows["en"].n_stop_words == 0
