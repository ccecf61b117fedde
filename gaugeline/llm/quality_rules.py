"""Quality rules: one threshold table compiled into one projection, without user functions.

Every measure is a Spark expression over the whole text, so a document is judged in the task that
read it and nothing is shuffled.  A null text counts as empty: it has no words and fails the base
rule.  Repeated rows and ties need no care, as a row is judged by itself; all input columns are
kept, and an input column with the name of the result column is replaced.

The stop words are those of four languages together.  Where a column of languages names another one,
stop words are not counted and their rule passes; a null language counts as one of the four.

Repeated five-word windows are found by their 64-bit hashes: a window counts as repeated if another
window of the same text has its hash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD_BREAK, let, text_or_empty

WINDOW_WORDS = 5
SYMBOLS = r"[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Trailing marks that a word loses before it is looked up among the stop words.
CLOSING_MARKS = ".,;:"
#: Languages that ``STOP_WORDS`` holds, by the first part of a language tag.
STOP_WORD_LANGUAGES = ("en", "de", "fr", "es")
#: Common words of the corpus languages (fixed values).
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which you were"
    " der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach"
    " le la les de des et en un une du que est pour qui dans sur pas au par plus se ne ce avec sont il elle"
    " el los las del y que se por con para una su al lo como más o pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if ``over`` (divided by ``per``) lies between the bounds, both included.

    None is no bound; a ratio to nothing passes.
    """

    name: str
    over: str
    per: str | None = None
    low: float | None = None
    high: float | None = None

    def failed(self, measures: Column) -> Column:
        value = measures[self.over].cast("double")
        if self.per is not None:
            value = value / F.nullif(measures[self.per].cast("double"), F.lit(0.0))
        bounds = [value < F.lit(self.low)] * (self.low is not None) + [value > F.lit(self.high)] * (self.high is not None)
        return F.coalesce(reduce(lambda a, b: a | b, bounds), F.lit(False))


BASE_RULES = (
    Rule("words", "n_words", low=10),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.2),
)
#: Length, symbol, stop-word and line ratios; a text without words has no ratio and fails by the base rules.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.25),
    Rule("stop_word_share", "n_stop_words", "n_words", low=0.02),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", high=0.5),
)


def _repeat_words(hashes: Column) -> Column:
    """Words in windows that occur more than once, from the hashes of all words."""
    starts = F.sequence(F.lit(0), F.size(hashes) - F.lit(WINDOW_WORDS))
    window = lambda i: F.xxhash64(*[F.get(hashes, i + F.lit(k)) for k in range(WINDOW_WORDS)])

    def among(windows: Column) -> Column:
        by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(by_hash, covered))

    def covered(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
        repeated = F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))
        # Each repeated window adds its words beyond the previous repeated window.
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["i"])),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW_WORDS).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW_WORDS), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    return F.when(F.size(hashes) <= WINDOW_WORDS, F.lit(0).cast("long")).otherwise(let(F.transform(starts, window), among))


def quality(text: Column, rules: tuple[Rule, ...] = RULES, lang: Column | None = None) -> Column:
    """A struct of all measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    tag = F.lit(None).cast("string") if lang is None else F.lower(F.regexp_extract(lang.cast("string"), r"^\s*([^-_\s]*)", 1))
    listed = F.coalesce(tag.isin(*STOP_WORD_LANGUAGES, ""), F.lit(True))
    stop = sorted(set(STOP_WORDS))
    parts = F.struct(
        F.filter(F.split(text, WORD_BREAK), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(HAS_WORD)).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("symbols"),
    )

    def measures(p: Column) -> Column:
        words, lines = p["words"], p["lines"]
        counts = {
            "n_words": F.size(words),
            "word_chars": F.char_length(F.array_join(words, "")),
            "n_symbols": p["symbols"],
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_stop_words": F.when(listed, F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(CLOSING_MARKS))).isin(stop)))),
            "n_repeat_words": let(F.transform(words, lambda w: F.xxhash64(w)), _repeat_words),
        }
        return F.struct(*(c.cast("long").alias(n) for n, c in counts.items()))

    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words"]

    def judged(m: Column) -> Column:
        base = reduce(lambda a, b: a | b, [r.failed(m) for r in BASE_RULES])
        failed = F.array_compact(F.array(*[F.when(r.failed(m), F.lit(r.name)) for r in (*BASE_RULES, *rules)]))
        verdict = [base.alias("base_failed"), failed.alias("failed_rules"), (F.size(failed) == 0).alias("kept")]
        return F.struct(*(m[n].alias(n) for n in names), *verdict)

    return let(let(parts, measures), judged)


def judge(docs: DataFrame, text: str = "text", out: str = "quality", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """Adds the struct of ``quality``; without a column ``lang`` all rows may have stop words."""
    language = F.col(f"`{lang}`") if lang in docs.columns else None
    return docs.withColumn(out, quality(text_or_empty(f"`{text}`"), rules, language))
