"""Secret scans: fixed patterns, and random-looking strings by character Markov models.

Everything is DataFrame expressions.  A match's place comes from marking all matches of a pattern
and splitting the text at the marks; the lengths of the pieces add up to positions in code points.

The method's own spans are long runs of token characters that no base span touches.  Two
first-order character models, of random strings and of ordinary identifiers, are trained from
labelled samples; a run is a secret if the mean log-likelihood ratio of its character pairs is above
a threshold.  The models are two tables of character pairs, so they have one size for any corpus.
Samples hold the whole alphabet of the runs: the corpus's own, and fixed ones, as a corpus may hold
few dates, paths, rulers or keys.  UUIDs and runs of one repeated character are never secrets of
this kind.

A null text counts as empty and has no spans.  Documents are scanned in the task that read them, so
repeated rows and skew need no care; input columns are kept, and one with the name of the result is
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import let, text_or_empty

#: Patterns and least lengths of the base kinds, in order (fixed values).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE_CHARS = 8
#: Shorter runs fail their kind, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CANDIDATE_CHARS = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE_CHARS
#: Ordinary identifiers and words, as samples of that label.
ORDINARY = r"[A-Za-z][A-Za-z_]{3,}"
#: Runs of token characters as ordinary samples; those long enough to be candidates only in an ordinary
#: shape (words, numbers and words with numbers between marks, or marks alone), as others may be secrets.
RUN = r"[A-Za-z0-9+/_=-]{4,}"
PIECE = r"(?:[A-Z]?[a-z]+(?:[A-Z][a-z]{2,})*[0-9]*|[A-Z]+[0-9]*|[0-9]+(?:[a-zA-Z]{1,2}[0-9]*)?)"
ORDINARY_SHAPE = rf"^[+/_=-]*(?:{PIECE}(?:[+/_=-]+{PIECE})*[+/_=-]*)?$"
REPEATED = r"^(.)\1*$"
UUID = r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
#: Fixed samples of each label.
FIXED_SAMPLES = 8_000
FIXED_WORDS = (
    "access admin alpha api app archive assets auth backup base beta bin build cache client cloud code common config content core "
    "count data date default demo dev dist docs document download error event example export file final folder group home image "
    "import index info input item job key lang lib list local log main manager master message model module name network node "
    "number object order output package page parent path process product project public query release report request response "
    "result root sample schema script section server service session share site source src stage start state storage system "
    "table task template test text time tmp token type update upload user usr util value var version video view web worker"
).split()
#: Documents whose strings train the models, those with the least hashes of their ids.
TRAINING_DOCS = 20_000
THRESHOLD = 0.5
#: Weight of a character's own share beside the pairs seen.
PRIOR_PAIRS = 8
#: Marks around matches; texts that hold them have them replaced by another control character.
MARK, STAND_IN = "\u0001", "\u0002"
#: Pieces whose lengths are added up together.
STEP = 64


def _before(lengths: Column) -> Column:
    """The sums before each element, in steps so that many matches stay cheap."""
    steps = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STEP).cast("int"))
    add = lambda a, x: a + x
    sums = F.transform(steps, lambda s: F.aggregate(F.slice(lengths, s * STEP + 1, F.lit(STEP)), F.lit(0), add))
    bases = F.transform(steps, lambda s: F.aggregate(F.slice(sums, F.lit(1), s), F.lit(0), add))
    within = lambda i: F.aggregate(F.slice(lengths, i - i % STEP + 1, i % STEP), F.lit(0), add)
    return F.transform(lengths, lambda _, i: F.get(bases, F.floor(i / STEP).cast("int")) + within(i))


SPANS = "array<struct<start:int,kind:int,stop:int,text:string>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches as (start, kind, stop, text)."""
    marked = F.split(F.regexp_replace(F.translate(text, MARK, STAND_IN), pattern, f"{MARK}$0{MARK}"), MARK)

    def spans(pieces: Column) -> Column:
        lengths = F.transform(pieces, F.char_length)
        row = lambda p, s: F.struct(s.alias("start"), F.lit(kind).alias("kind"), (s + F.char_length(p)).alias("stop"), p.alias("text"))
        rows = let(lengths, lambda n: F.zip_with(pieces, _before(n), row))
        return F.filter(rows, lambda _, i: i % 2 == 1)

    return F.when(text.rlike(pattern), let(marked, spans)).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    long_value = lambda m: F.char_length(F.regexp_extract(m["text"], ASSIGN, 1)) >= ASSIGN_VALUE_CHARS
    return F.array_sort(F.concat(F.filter(_matches(text, ASSIGN, 0), long_value), _matches(text, ACCESS, 1), _matches(text, HEX, 2)))


@dataclass(frozen=True)
class PairModel:
    """Log-likelihood ratios (random over ordinary) of all character pairs, row by row."""

    ratios: tuple[float, ...]

    def mean_ratio(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>")
        place = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1))) - 1
        step = lambda a, i: a + F.coalesce(F.get(table, place(i) * len(ALPHABET) + place(i + 1)), F.lit(0.0))
        pairs = F.char_length(token) - 1
        return F.aggregate(F.sequence(F.lit(1), F.greatest(pairs, F.lit(1))), F.lit(0.0), step) / F.greatest(pairs, F.lit(1))


def train(samples: DataFrame) -> PairModel:
    """From labelled strings (token, label): 1 random, 0 ordinary.

    Characters outside the alphabet are left out; a model without samples is uniform.  At most two numbers per pair of characters reach the driver.
    """
    clean = F.regexp_replace("token", "[^A-Za-z0-9+/_=-]", "")
    strings = samples.filter("label IN (0, 1)").select(clean.alias("token"), "label").filter(F.char_length("token") > 1).distinct()
    pairs = strings.select(
        "label", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("token") - 1), lambda i: F.substring(F.col("token"), i, F.lit(2)))).alias("pair")
    )
    counts = {(r["label"], r["pair"]): r["count"] for r in pairs.groupBy("label", "pair").count().collect()}
    return PairModel(tuple(pair_ratios(counts)))


def pair_ratios(counts: dict[tuple[int, str], int]) -> list[float]:
    """Log ratio of P(second | first) under both labels; rare firsts lean on the characters' own shares."""
    shares = []
    for label in (0, 1):
        seen = [1 + sum(counts.get((label, a + b), 0) for a in ALPHABET) for b in ALPHABET]
        shares.append([n / sum(seen) for n in seen])
    ratios = []
    for a in ALPHABET:
        logs = []
        for label, share in enumerate(shares):
            row = [counts.get((label, a + b), 0) for b in ALPHABET]
            logs.append([math.log((n + PRIOR_PAIRS * s) / (sum(row) + PRIOR_PAIRS)) for n, s in zip(row, share, strict=True)])
        ratios += [round(r - o, 6) for o, r in zip(*logs, strict=True)]
    return ratios


def corpus_samples(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_docs: int = TRAINING_DOCS) -> DataFrame:
    """Labelled strings of at most ``most_docs`` documents: values of base spans, and ordinary words."""
    chosen = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    # At most ``most_docs`` ids.
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text")).join(F.broadcast(chosen), "doc_id", "left_semi")
    value = lambda m: F.when(m["kind"] == 0, F.regexp_extract(m["text"], ASSIGN, 1)).otherwise(m["text"])
    random = F.transform(base_spans(F.col("text")), value)
    words = F.regexp_extract_all("text", F.lit(ORDINARY), 0)
    return rows.select(F.explode(random).alias("token"), F.lit(1).alias("label")).union(
        rows.select(F.explode(F.array_distinct(words)).alias("token"), F.lit(0).alias("label"))
    ).distinct()


def ordinary_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_docs: int = TRAINING_DOCS) -> DataFrame:
    """Runs of the candidates' whole alphabet outside base spans, labelled 0, of the same documents as ``corpus_samples``."""
    chosen = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    # At most ``most_docs`` ids.
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text")).join(F.broadcast(chosen), "doc_id", "left_semi")
    outside = let(base_spans(F.col("text")), lambda spans: redacted(F.col("text"), spans, " "))
    runs = rows.select(F.explode(F.array_distinct(F.regexp_extract_all(outside, F.lit(RUN), 0))).alias("token"))
    short = F.char_length("token") < CANDIDATE_CHARS
    usual = (short | F.col("token").rlike(ORDINARY_SHAPE)) & ~F.col("token").rlike(REPEATED)
    return runs.filter(usual).select("token", F.lit(0).alias("label")).distinct()


def fixed_strings() -> list[tuple[str, int]]:
    """Strings of both labels, the same in every run: identifiers, paths, dates, numbers and rulers; keys in usual encodings."""
    rng = random.Random(7)
    word = lambda: rng.choice((str.lower, str.lower, str.lower, str.title, str.upper))(rng.choice(FIXED_WORDS))
    digits = lambda least, most: "".join(rng.choices("0123456789", k=rng.randint(least, most)))
    piece = lambda: rng.choice((word, word, word, lambda: word() + digits(1, 4), lambda: digits(1, 4)))()

    def name() -> str:
        mark = rng.choice("-_/+=-_/")
        return mark.join(piece() for _ in range(rng.randint(2, 7)))

    def date() -> str:
        mark = rng.choice(("-", "/", "_", ""))
        day = mark.join((f"{rng.randint(1970, 2069)}", f"{rng.randint(1, 12):02d}", f"{rng.randint(1, 28):02d}"))
        hour = rng.choice(("-", "_", "")).join(f"{rng.randrange(60):02d}" for _ in range(3))
        return rng.choice((day, f"{day}T{hour}", f"{day}T{hour}Z", f"{day}_{hour}-{word()}", f"{word()}-{day}", f"{day}/{name()}"))

    def number() -> str:
        up = "01234567890123456789"
        return rng.choice((digits(8, 40), up[rng.randint(0, 9) :] + up, "-".join(digits(1, 6) for _ in range(rng.randint(2, 8)))))

    def ruler() -> str:
        edge, fill = rng.choice("+-=_/"), rng.choice("-=_+/")
        return edge + edge.join(fill * rng.randint(1, 16) for _ in range(rng.randint(2, 8))) + edge

    def camel() -> str:
        return "".join(rng.choice(FIXED_WORDS).title() for _ in range(rng.randint(2, 5))) + rng.choice(("", digits(1, 4)))

    alphabets = (ALPHABET[:62], ALPHABET[:62], ALPHABET[:64], ALPHABET[:62] + "_-", "0123456789ABCDEF", ALPHABET[26:52] + "234567")
    usual = [rng.choice((name, name, date, number, ruler, camel))() for _ in range(FIXED_SAMPLES)]
    keys = ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(20, 44))) for _ in range(FIXED_SAMPLES)]
    return [(t, 0) for t in usual] + [(t, 1) for t in keys]


def training_samples(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most_docs: int = TRAINING_DOCS) -> DataFrame:
    """Labelled strings over the whole alphabet: the corpus's values, words and runs, and the fixed strings."""
    both = corpus_samples(docs, doc_id, text, most_docs).union(ordinary_runs(docs, doc_id, text, most_docs))
    strings = fixed_strings()
    for label in (0, 1):
        listed = F.split(F.lit(" ".join(t for t, of in strings if of == label)), " ")
        both = both.union(docs.sparkSession.range(1).select(F.explode(listed).alias("token"), F.lit(label).alias("label")))
    return both.distinct()


def scan(docs: DataFrame, model: PairModel, text: str = "text", out: str = "secrets", threshold: float = THRESHOLD) -> DataFrame:
    """Adds all spans, sorted by start and kind: (start, kind, stop, text); kinds as in ``KINDS``."""
    body = text_or_empty(f"`{text}`")

    def joined(found: Column) -> Column:
        base, runs = found["base"], found["runs"]
        apart = lambda m: ~F.exists(base, lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"]))
        usual = lambda m: m["text"].rlike(REPEATED) | m["text"].rlike(UUID)
        extra = F.filter(runs, lambda m: apart(m) & ~usual(m) & (model.mean_ratio(m["text"]) > threshold))
        return F.when(F.size(runs) == 0, base).otherwise(F.array_sort(F.concat(base, extra)))

    found = F.struct(base_spans(body).alias("base"), _matches(body, CANDIDATE, 3).alias("runs"))
    return docs.withColumn(out, let(found, joined))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["stop"])), ",")


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """The text with every span replaced; overlapping spans count as one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        added = F.when((s["start"] >= acc["at"]), F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), added.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    return let(spans, lambda s: F.when(F.size(s) == 0, text).otherwise(F.aggregate(s, start, step, rest)))
