"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line, and every paragraph of several lines, of a whole text is a sparse vector of its words;
a notice belongs to the template with the highest cosine of at least ``MIN_COSINE``.  So is every
window of a template's length in them, if it holds a word that tells the template from others'
notices, so that words beside a notice do not hide it.  Inverse document frequencies count every
document of the corpus, for all words of the segments compared.  Most lines cannot reach the cosine: templates' commonest words together carry
too little of any template, so a line needs one of the other words (a prefix filter that loses
nothing), and a text without any is not cut into lines at all.

Whole licence texts and whole standard headers are templates too: a file is compared with them as a
whole if it has no more words, else by every window of as many words, and one with a cosine of at
least ``MIN_LONG_COSINE`` goes before any notice, so licences with a common opening are told apart.
A title speaks only as a line or paragraph that holds all its words.

A document's own licence is that of its best notice.  A licence file (by name) also speaks for its
directory and all below.  Documents without a notice inherit from the nearest ancestor directory
that has a licence file: distinct directories are joined with their ancestors' licences, and
documents with their directory, so a directory that holds a third of all rows is one row of the
search.

A null text counts as empty; a null path has no directory and inherits nothing.  Ties go to the
template first by name; of several licence files in a directory the first by path speaks.  Repeated
rows stay; an empty table gives an empty result; columns other than those named are dropped.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import text_or_empty
from gaugeline.sources.workspace import broadcast_if_small, stage_table

MIN_COSINE = 0.6
LICENSE_FILE = r"(?i)^(license|licence|copying|notice)([.-].*)?$"
WORDS = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")
#: Whole texts and headers share most of their words with those of other licences.
MIN_LONG_COSINE = 0.8
#: Counts of words that a task holds before it hands them on.
MOST_COUNTS = 200_000
#: Short notices of public licences, and first sentences that no other licence has (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved. No part may be reproduced without written permission."),
)

TITLES = (
    ("AGPL-3.0", "GNU Affero General Public License Version 3"),
    ("Apache-2.0", "Apache License"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("MIT", "MIT License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)


def _gnu_headers() -> list[tuple[str, str]]:
    """The standard headers of the GNU licences, whole and their first paragraphs only."""
    found = []
    for name, work, title, version, mark in (
        ("AGPL-3.0", "program", "GNU Affero General Public License", "3", ":"),
        ("GPL-2.0", "program", "GNU General Public License", "2", ";"),
        ("GPL-3.0", "program", "GNU General Public License", "3", ":"),
        ("LGPL-2.1", "library", "GNU Lesser General Public License", "2.1", ";"),
        ("LGPL-3.0", "program", "GNU Lesser General Public License", "3", ":"),
    ):
        first = (
            f"This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the {title} as published by"
            f" the Free Software Foundation{',' if mark == ':' else ';'} either version {version} of the License, or (at your option) any later version."
        )
        rest = (
            f" This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
            f" MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details. You should have received a copy of the"
            f" {title} along with this {work}. If not, see <https://www.gnu.org/licenses/>."
        )
        found += [(name, first), (name, first + rest)]
    return found


def long_templates() -> tuple[tuple[str, str], ...]:
    """Whole licence texts, beside this module, and whole headers."""
    texts = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    apache = (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may'
        " obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express'
        " or implied. See the License for the specific language governing permissions and limitations under the License."
    )
    mozilla = (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this"
        " file, You can obtain one at http://mozilla.org/MPL/2.0/."
    )
    return (*((t.stem, t.read_text()) for t in texts), *_gnu_headers(), ("Apache-2.0", apache), ("MPL-2.0", mozilla))


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def segments(text: str) -> list[str]:
    """Lines with text, and paragraphs of several lines."""
    out = []
    for paragraph in re.split(r"\n[ \t\r]*\n", text):
        lines = [line for line in paragraph.split("\n") if line.strip()]
        out += lines
        if len(lines) > 1:
            out.append(" ".join(lines))
    return out


class Matcher:
    """Templates as unit vectors under the corpus's document frequencies."""

    def __init__(self, templates: tuple[tuple[str, str], ...], documents: int, frequency: dict[str, int], min_cosine: float, titles=()):
        self.min_cosine = min_cosine
        self.rarest = math.log(1 + documents) + 1
        self.idf = {w: math.log((1 + documents) / (1 + n)) + 1 for w, n in frequency.items()}
        self.names = [name for name, _ in (*templates, *titles)]
        self.vectors = [self._unit(Counter(words_of(text))) for _, text in (*templates, *titles)]
        self.first_title = len(templates)
        self.documents = documents
        #: Weights of the words of the text at hand that no template has.
        self.other: dict[str, float] = {}
        self.lengths = [sum(Counter(words_of(text)).values()) for _, text in templates]
        self.telling = [self._telling(i, templates) for i in range(len(templates))]
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for i, vector in enumerate(self.vectors):
            for word, weight in vector.items():
                self.postings.setdefault(word, []).append((i, weight))

    @staticmethod
    def _telling(i: int, templates) -> frozenset[str]:
        """Words of a template that no other licence's has; if there are none, its words with digits."""
        name, text = templates[i]
        words = set(words_of(text))
        own = words.difference(*(words_of(t) for n, t in templates if n != name))
        return frozenset(own or {w for w in words if re.search("[0-9]", w)} or words)

    def weight(self, word: str) -> float:
        known = self.idf.get(word)
        return self.other.get(word, self.rarest) if known is None else known

    def learn(self, frequency: dict[str, int]) -> None:
        """Documents with each further word of the next text."""
        self.other = {w: math.log((1 + self.documents) / (1 + n)) + 1 for w, n in frequency.items()}

    def _unit(self, counts: Counter) -> dict[str, float]:
        weights = {w: n * self.weight(w) for w, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        return {w: x / norm for w, x in weights.items()}

    @cached_property
    def needed(self) -> frozenset[str]:
        """Words of which a matching segment has one: the others carry less than the cosine of any template."""
        carried = [0.0] * len(self.vectors)
        needed = {w for v in self.vectors[: self.first_title] for w in v}
        for word in sorted(self.postings, key=lambda w: (self.idf.get(w, self.rarest), w)):
            notices = [(i, x) for i, x in self.postings[word] if i < self.first_title]
            if all(carried[i] + x * x < self.min_cosine**2 * 0.999 for i, x in notices):
                needed.discard(word)
                for i, x in notices:
                    carried[i] += x * x
        # A title needs all its words, so the rarest will do.
        return frozenset(needed.union(max(v, key=lambda w: (self.idf.get(w, self.rarest), w)) for v in self.vectors[self.first_title :]))

    def best(self, text: str) -> tuple[str | None, float | None]:
        """The licence of the best notice in the text, and its cosine."""
        if self.needed.isdisjoint(words_of(text)):
            return None, None
        found: tuple[float, str] | None = None
        for segment in segments(text):
            words = words_of(segment)
            counts = Counter(words)
            if self.needed.isdisjoint(counts):
                continue
            cosine = [0.0] * len(self.vectors)
            for word, weight in self._unit(counts).items():
                for i, x in self.postings.get(word, ()):
                    cosine[i] += weight * x
            for i, (name, c) in enumerate(zip(self.names, cosine, strict=True)):
                c = round(c, 9)
                if i >= self.first_title and not counts.keys() >= self.vectors[i].keys():
                    continue
                if c >= self.min_cosine and (found is None or (-c, name) < (-found[0], found[1])):
                    found = (c, name)
            for c, name in self._window_matches(words):
                if found is None or (-c, name) < (-found[0], found[1]):
                    found = (c, name)
        return (found[1], found[0]) if found else (None, None)

    def compared(self, text: str) -> set[str]:
        """Words of the segments that are compared with templates."""
        if self.needed.isdisjoint(words_of(text)):
            return set()
        return {w for s in segments(text) for words in [words_of(s)] if not self.needed.isdisjoint(words) for w in words}

    def _carried(self, words: list[str]) -> list[float]:
        """The shares of the templates that words carry: the squares of the highest cosines they allow."""
        carried = [0.0] * len(self.vectors)
        for word in set(words):
            for i, x in self.postings.get(word, ()):
                carried[i] += x * x
        return carried

    def _window_matches(self, words: list[str]) -> list[tuple[float, str]]:
        """Of each template that windows shorter than the segment fit, the best cosine."""
        out = []
        for i, share in enumerate(self._carried(words)[: self.first_title]):
            if share < self.min_cosine**2 * 0.999 or len(words) <= self.lengths[i] or self.telling[i].isdisjoint(words):
                continue
            c = round(self._best_window(words, i, self.telling[i]), 9)
            if c >= self.min_cosine:
                out.append((c, self.names[i]))
        return out

    def _best_window(self, words: list[str], i: int, telling: frozenset[str] | None = None) -> float:
        """The highest cosine of windows, with products and squares kept while the window moves."""
        vector, length = self.vectors[i], self.lengths[i]
        counts: Counter = Counter()
        product = square = best = 0.0
        told = 0
        for place, word in enumerate(words):
            weight = self.weight(word)
            square += (2 * counts[word] + 1) * weight * weight
            product += weight * vector.get(word, 0.0)
            counts[word] += 1
            told += telling is None or word in telling
            if place >= length:
                left = words[place - length]
                weight = self.weight(left)
                square -= (2 * counts[left] - 1) * weight * weight
                product -= weight * vector.get(left, 0.0)
                counts[left] -= 1
                told -= telling is None or left in telling
            if told and (place >= length - 1 or place == len(words) - 1) and product > best * math.sqrt(square):
                best = product / math.sqrt(square)
        return best


class LongMatcher(Matcher):
    """Long templates, found as whole texts or as windows of their length."""

    def best(self, text: str) -> tuple[str | None, float | None]:
        words = words_of(text)
        if self.needed.isdisjoint(words):
            return None, None
        found = [
            (-c, self.names[i])
            for i, share in enumerate(self._carried(words))
            if share >= self.min_cosine**2 * 0.999 and (c := round(self._best_window(words, i), 9)) >= self.min_cosine
        ]
        return (min(found)[1], -min(found)[0]) if found else (None, None)

    def compared(self, text: str) -> set[str]:
        words = words_of(text)
        if self.needed.isdisjoint(words) or max(self._carried(words)) < self.min_cosine**2 * 0.999:
            return set()
        return set(words)


def document_frequencies(docs: DataFrame, vocabulary: frozenset[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """Documents, and documents with each word of a vocabulary, over the whole corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                counts.update(vocabulary.intersection(words_of(body)))
                counts[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    found = docs.select(text_or_empty(f"`{text}`")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"]: r["n"] for r in found.collect()}  # a row per word of the vocabulary
    return counts.pop("", 0), counts


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): documents with each word, over all words of the corpus."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                counts.update(set(words_of(body)))
                if len(counts) > MOST_COUNTS:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return docs.select(text_or_empty(f"`{text}`")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def own_licenses(docs: DataFrame, doc_id: str, path: str, text: str, min_cosine: float = MIN_COSINE, templates=TEMPLATES) -> DataFrame:
    """(doc_id, path, own_license, cosine)."""
    long = long_templates()
    vocabulary = frozenset(w for _, t in (*templates, *TITLES, *long) for w in words_of(t))
    documents, frequency = document_frequencies(docs, vocabulary, text)
    frequency = {w: frequency.get(w, 0) for w in vocabulary}
    notices = Matcher(templates, documents, frequency, min_cosine, TITLES)
    wholes = LongMatcher(long, documents, frequency, MIN_LONG_COSINE)
    # Found once, before tasks get their copies.
    _ = notices.needed, wholes.needed

    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{path}`").cast("string").alias("path"), text_or_empty(f"`{text}`").alias("text")
    )
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts to compare, with their words that no template has; null for others."""
        for batch in batches:
            bodies, words = batch.column("text").to_pylist(), []
            for i, body in enumerate(bodies):
                found = notices.compared(body) | wholes.compared(body)
                words.append(sorted(found - vocabulary) if found else None)
                bodies[i] = body if found else None
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("path"), pa.array(bodies, pa.string()), pa.array(words, pa.list_(pa.string()))],
                ["doc_id", "path", "text", "words"],
            )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, cosines = [], []
            for body, words, counts in zip(*(batch.column(c).to_pylist() for c in ("text", "seen", "n")), strict=True):
                further = dict(zip(words or (), counts or (), strict=True))
                notices.learn(further)
                wholes.learn(further)
                name, cosine = wholes.best(body)
                if name is None:
                    name, cosine = notices.best(body)
                names.append(name)
                cosines.append(cosine)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("path"), pa.array(names, pa.string()), pa.array(cosines, pa.float64())],
                ["doc_id", "path", "own_license", "cosine"],
            )

    chosen = narrow.mapInArrow(choose, f"doc_id {id_type}, path string, text string, words array<string>")
    held = stage_table(chosen.withColumn("row", F.monotonically_increasing_id()), "license_texts")
    asked = held.filter("text IS NOT NULL").select("row", F.explode("words").alias("word"))
    seen = stage_table(word_counts(docs, text).join(asked.select("word").distinct(), "word", "left_semi"), "license_words")
    weighed = asked.join(broadcast_if_small(seen), "word").groupBy("row").agg(F.collect_list(F.struct("word", "n")).alias("found"))
    joined = held.filter("text IS NOT NULL").join(weighed, "row", "left")
    inputs = joined.select("doc_id", "path", "text", F.col("found.word").alias("seen"), F.col("found.n").alias("n"))
    scored = inputs.mapInArrow(score, f"doc_id {id_type}, path string, own_license string, cosine double")
    rest = held.filter("text IS NULL").select("doc_id", "path", F.lit(None).cast("string").alias("own_license"), F.lit(None).cast("double").alias("cosine"))
    return scored.union(rest)


def directory(path: str | Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def inherit(found: DataFrame) -> DataFrame:
    """Adds ``license`` and ``license_from`` (own, directory, none) to own licences with paths."""
    placed = found.withColumn("_dir", F.when(F.col("path").contains("/"), directory("path")).when(F.col("path").isNotNull(), ""))
    files = (
        placed.filter(F.col("own_license").isNotNull() & F.element_at(F.split("path", "/"), -1).rlike(LICENSE_FILE))
        .groupBy(F.col("_dir").alias("_up"))
        .agg(F.min_by("own_license", F.struct("path", "own_license")).alias("_inherited"))
    )
    directories = placed.select("_dir").filter("_dir IS NOT NULL").distinct()
    parts = F.split("_dir", "/")
    depths = F.when(F.col("_dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))
    ancestors = directories.select("_dir", F.explode(depths).alias("_depth")).withColumn("_up", F.array_join(F.slice(parts, F.lit(1), F.col("_depth")), "/"))
    nearest = ancestors.join(files, "_up").groupBy("_dir").agg(F.max_by("_inherited", "_depth").alias("_inherited"))
    joined = placed.join(broadcast_if_small(nearest), "_dir", "left")
    return joined.select(
        *found.columns,
        F.coalesce("own_license", "_inherited").alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").when(F.col("_inherited").isNotNull(), "directory").otherwise("none").alias("license_from"),
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", path: str = "path", text: str = "text", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(doc_id, path, own_license, cosine, license, license_from) of every row."""
    return inherit(stage_table(own_licenses(docs, doc_id, path, text, min_cosine), "licenses"))
