"""Language-model scores: an interpolated modified Kneser-Ney trigram model.

Spark counts words, numbers them by their place among the sorted word hashes, counts trigrams (each task
sums its own first), and derives the continuation counts of pairs and words from the distinct trigrams
and pairs.  Each level is stored as sorted key arrays, one file per part and array, in the shared folder;
scoring tasks map these files into memory and search them, so a worker holds only the pages it touches.

For a word w after u v, with counts c at the top and continuation counts (numbers of different words in
front) below, D1 to D3 the discounts of a count of one, two, and three or more, and V training words:

    p(w | u v) = max(c(uvw) - D, 0) / c(uv) + left(uv) p(w | v),   p(w | v) = p2 likewise, then p(w),
    p(w) = max(c(w) - D, 0) / c + left / (V + 1)

Two marks stand before each text, one end token after it.  ``left`` is the mass the discounts leave, so
all levels add up to one.  Trigrams counted less often than ``least_trigram`` are not stored: their whole
mass goes to the pairs (they still count in c(uv), the discounts and the pairs' continuation counts).
Where the counts of counts allow no discounts (tiny corpora), those of ``PLAIN_DISCOUNTS`` hold.

Null texts are empty and score their end token.  A null id does not keep a row out of training unless the
caller's condition does.  Repeated rows count as often as they occur.  An empty table, or one without
training rows, gives the uniform model.  Texts are taken whole, of any length.  Extra columns pass through
``score``; only the named result column is replaced.

The folder must be mounted where executors run (a path, or ``file:``): other stores cannot be mapped.
Files are written under a name of their own and renamed, so a repeated task leaves the same file.  Words
are told apart by 64-bit hashes, trigrams by a 64-bit hash of exact numbers.  A part's memory is bounded by
its tokens and the number of words that follow one word.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from gaugeline.llm import word_arrays
from gaugeline.llm.common import partitions_of
from gaugeline.sources.workspace import new_path, release_tables, stage_table

#: Text that a task counts or scores at once.
BUFFER_BYTES = 8 << 20
#: Tokens of a part of the trigrams, words of a part of the vocabulary.
PART_TOKENS, PART_WORDS = 2 << 20, 4 << 20
LEAST_TRIGRAM = 2
PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)
END_HASH = np.uint64(0x2545F4914F6CDD1D)
_BREAK = word_arrays.byte_set(" \x09\x0a\x0b\x0c\x0d")


@dataclass(frozen=True)
class Model:
    """Where the arrays are and what else a scorer needs; small whatever the corpus."""

    folder: str
    words: int
    tokens: int
    word_bits: int
    word_offsets: tuple[int, ...]
    parts: int
    least_trigram: int
    #: By level from 1: discounts of counts of 0, 1, 2, 3 and more.
    discounts: tuple[tuple[float, ...], ...]
    #: Pairs of which a word is the second, and words by discount class.
    unigrams: tuple[int, ...]

    @property
    def size(self) -> int:
        """Numbers in use: the words, the mark before a text, and any unknown word."""
        return self.words + 2


# ---- files


def mounted(path: str) -> str:
    if path.startswith("file:"):
        return "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: the model's folder must be mounted where executors run")
    return path


def _save(folder: str, name: str, part: int, arrays: dict[str, np.ndarray]) -> None:
    """Numbers take as few bytes as the part's largest needs; keys keep all 64 bits."""
    os.makedirs(folder, exist_ok=True)
    for array, values in arrays.items():
        if array != "keys":
            values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
        own = f"{folder}/{uuid.uuid4().hex}"
        with open(own, "wb") as file:
            np.save(file, values)
        os.replace(own, f"{folder}/{name}-{part}.{array}.npy")


_mapped: dict[tuple[str, str, int, str], np.ndarray] = {}


def _open(folder: str, name: str, part: int, array: str) -> np.ndarray:
    key = (folder, name, part, array)
    if key not in _mapped:
        if any(held[0] != folder for held in _mapped):
            _mapped.clear()
        path = f"{folder}/{name}-{part}.{array}.npy"
        found = np.load(path, mmap_mode="r") if os.path.getsize(path) > 128 else np.load(path)
        _mapped[key] = found
    return _mapped[key]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``wanted`` (sorted, for the pages' sake) is among the sorted keys, and whether."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _parted(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the rows part by part, in their order, and where each part begins."""
    small = part.astype(np.uint16) if parts < 1 << 16 else part
    return np.argsort(small, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def _look_up(folder: str, name: str, parts: int, part: np.ndarray, keys: np.ndarray, arrays: tuple[str, ...]) -> list[np.ndarray]:
    """Values of sorted keys by part; zeros where a key is not stored."""
    out = [np.zeros(len(keys), np.int64) for _ in arrays]
    by, cuts = _parted(part, parts)
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        own = by[cuts[p] : cuts[p + 1]]
        at, there = _find(_open(folder, name, p, "keys"), keys[own])
        for values, array in zip(out, arrays, strict=True):
            values[own[there]] = _open(folder, name, p, array)[at[there]]
    return out


# ---- packed runs: what tasks send to the parts


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, the first ascending, as differences with like bytes side by side."""
    whole = [np.diff(columns[0], prepend=0), *columns[1:]]
    raw = b"".join(np.ascontiguousarray(c, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for c in whole)
    return len(columns[0]).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    size = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], size * 8 * columns, codec="zstd"), np.uint8).reshape(columns, 8, size)
    out = [np.ascontiguousarray(raw[i].T).reshape(-1).view(np.int64) for i in range(columns)]
    out[0] = np.cumsum(out[0])
    return out


def _by_part(part: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    by, cuts = _parted(part, parts)
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        own = by[cuts[p] : cuts[p + 1]]
        yield p, _pack(*(c[own] for c in columns))


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    return (word_arrays.mix(key.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def trigram_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return word_arrays.join_hash(word_arrays.mix(context.astype(np.uint64)), word.astype(np.uint64))


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, a place of each, and the sums of their counts."""
    by = np.argsort(keys)
    held = keys[by]
    at = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(by) else by
    return held[at], by[at], np.add.reduceat(counts[by], at) if len(at) else counts


# ---- tokens


class Tokens:
    """Word numbers of some texts and the two numbers before each word.

    ``local`` counts the buffer's own words, in the order of the numbers: ``numbers[local]`` is the
    number of each word; the last local number is the mark that stands before a text.
    """

    def __init__(self, texts: list[bytes | None], model: Model):
        data, places = word_arrays.joined(texts, b" ")
        starts, _, hashes = word_arrays.words(data, _BREAK)
        of = np.searchsorted(places, starts, "right") - 1
        sizes = np.bincount(of, minlength=len(texts)) + 1
        every = np.full(len(starts) + len(texts), END_HASH)
        every[np.arange(len(starts)) + of] = hashes
        distinct, self.local = np.unique(every, return_inverse=True)
        found, known = _word_numbers(model, distinct)
        self.known = known
        self.numbers = np.append(np.where(known, found, model.words + 1), model.words)
        self.sizes, self.first = sizes, np.cumsum(sizes) - sizes
        self.text = np.repeat(np.arange(len(texts)), sizes)

    def before(self, x: np.ndarray) -> np.ndarray:
        """What stands one place before, the mark at the beginning of a text."""
        out = np.concatenate([[len(self.numbers) - 1], x[:-1]])
        out[self.first] = len(self.numbers) - 1
        return out


def _word_part(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _word_numbers(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    number, found = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    part = _word_part(hashes, model.word_bits)
    for p in np.unique(part).tolist():
        own = np.flatnonzero(part == p)
        at, there = _find(_open(model.folder, "words", p, "keys"), hashes[own])
        number[own], found[own] = at + model.word_offsets[p], there
    return number, found


def _word_counts(model: Model, numbers: np.ndarray) -> np.ndarray:
    """Training counts of word numbers; 0 for numbers of no word."""
    counts = np.zeros(len(numbers), np.int64)
    part = np.searchsorted(np.array(model.word_offsets), numbers, "right") - 1
    part[numbers >= model.words] = -1
    for p in np.unique(part[part >= 0]).tolist():
        own = np.flatnonzero(part == p)
        counts[own] = _open(model.folder, "words", p, "counts")[numbers[own] - model.word_offsets[p]]
    return counts


def _texts(table: pa.Table, name: str) -> list[bytes | None]:
    return table.column(name).cast(pa.binary()).to_pylist()


# ---- training


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in word_arrays.buffers(batches, "text", BUFFER_BYTES):
        data, _ = word_arrays.joined(_texts(table, "text"), b" ")
        found = word_arrays.words(data, _BREAK)[2]
        hashes, counts = np.unique(np.concatenate([found, np.full(table.num_rows, END_HASH)]), return_counts=True)
        yield pa.RecordBatch.from_pydict({"hash": hashes.view(np.int64), "n": counts.astype(np.int64)})


def _save_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        hashes, counts = table.column("hash").to_numpy().view(np.uint64), table.column("n").to_numpy()
        by = np.argsort(hashes)
        by = by[counts[by] > 0]  # a row without a count stands in every part
        part = table.column("part")[0].as_py()
        _save(folder, "words", part, {"keys": hashes[by], "counts": counts[by]})
        return pa.table({"part": pa.array([part], pa.int32()), "words": pa.array([len(by)], pa.int64()), "tokens": pa.array([int(counts.sum())], pa.int64())})

    return run


def _count_trigrams(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in word_arrays.buffers(batches, "text", BUFFER_BYTES):
            tokens = Tokens(_texts(table, "text"), model)
            size, w = len(tokens.numbers), tokens.local
            v = tokens.before(w)
            u = tokens.before(v)
            if size >= 1 << 21:  # three local numbers no longer fit one key
                pairs, pair = np.unique(u * size + v, return_inverse=True)
                keys, counts = np.unique(pair * size + w, return_counts=True)
                first, last = pairs[keys // size], keys % size
            else:
                keys, counts = np.unique((u * size + v) * size + w, return_counts=True)
                first, last = keys // size, keys % size
            context = tokens.numbers[first // size] * model.size + tokens.numbers[first % size]
            yield _payloads(_by_part(part_of(context, model.parts), model.parts, context, tokens.numbers[last], counts))

    return run


def _payloads(rows: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    found = list(rows)
    return pa.RecordBatch.from_pydict({"part": pa.array([p for p, _ in found], pa.int32()), "payload": pa.array([d for _, d in found], pa.binary())})


LEVEL_FIELDS = "level int, part int, payload binary, n1 long, n2 long, n3 long, n4 long, classes array<long>, total long"


def _classes(counts: np.ndarray) -> list[int]:
    """Types with a count of one, of two, and of three and more."""
    return [int((counts == 1).sum()), int((counts == 2).sum()), int((counts >= 3).sum())]


def _level_rows(level: int, sent: Iterator[tuple[int, bytes]], counts: np.ndarray) -> pa.Table:
    rows = [{"level": 0, "part": p, "payload": data} for p, data in sent]
    often = {f"n{i}": int((counts == i).sum()) for i in range(1, 5)}
    rows.append({"level": level, "part": -1, **often, "classes": _classes(counts), "total": int(counts.sum())})
    whole = pa.int64()
    schema = pa.schema(
        [("level", pa.int32()), ("part", pa.int32()), ("payload", pa.binary()), *((f"n{i}", whole) for i in range(1, 5)), ("classes", pa.list_(whole)), ("total", whole)]
    )
    return pa.Table.from_pylist(rows, schema=schema)


def _gathered(table: pa.Table, columns: int) -> tuple[list[np.ndarray], np.ndarray]:
    runs = [_unpack(data, columns) for data in table.column("payload").to_pylist() if data]
    whole = [np.concatenate([r[i] for r in runs]) if runs else np.zeros(0, np.int64) for i in range(columns)]
    return whole[:-1], whole[-1]


def _context_arrays(context: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Of each context, in ascending order, the sum of its counts and its words by discount class."""
    by = np.argsort(context)
    context, counts = context[by], counts[by]
    at = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(by) else by
    keys = context[at]
    sums = lambda x: np.add.reduceat(x, at) if len(at) else np.zeros(0, np.int64)
    classes = [sums((counts == n).astype(np.int64)) for n in (1, 2)] + [sums((counts >= 3).astype(np.int64))]
    return {"keys": keys.astype(np.uint64), "sums": sums(counts), **{f"class{i + 1}": c.astype(np.uint32) for i, c in enumerate(classes)}}


def _merge_trigrams(model: Model):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        (context, word), counts = _gathered(table, 3)
        keys, at, counts = _sums(trigram_key(context, word), counts)
        context, word = context[at], word[at]
        contexts = _context_arrays(context, counts)
        stored = counts >= model.least_trigram
        with_stored = np.isin(contexts["keys"].astype(np.int64), context[stored])
        _save(model.folder, "contexts3", part, {k: v[with_stored] for k, v in contexts.items()})
        _save(model.folder, "grams3", part, {"keys": keys[stored], "counts": counts[stored]})
        pairs, fronts = np.unique(context % model.size * model.size + word, return_counts=True)
        return _level_rows(3, _by_part(part_of(pairs // model.size, model.parts), model.parts, pairs, fronts), counts)

    return run


def _merge_pairs(model: Model):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        (pairs,), counts = _gathered(table, 2)
        pairs, _, counts = _sums(pairs, counts)
        _save(model.folder, "contexts2", part, _context_arrays(pairs // model.size, counts))
        _save(model.folder, "grams2", part, {"keys": pairs.astype(np.uint64), "counts": counts})
        word, fronts = np.unique(pairs % model.size, return_counts=True)
        return _level_rows(2, _by_part(part_of(word, model.parts), model.parts, word, fronts), counts)

    return run


def _merge_words(model: Model):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        (word,), counts = _gathered(table, 2)
        word, _, counts = _sums(word, counts)
        _save(model.folder, "grams1", part, {"keys": word.astype(np.uint64), "counts": counts})
        return _level_rows(1, iter(()), counts)

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float, float]:
    """Discounts of counts of 0, 1, 2, and 3 or more, from how many types occur once to four times."""
    plain = (0.0, *PLAIN_DISCOUNTS)
    if not min(n1, n2, n3, n4):
        return plain
    y = n1 / (n1 + 2 * n2)
    found = (0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return found if all(0 < d <= i for i, d in enumerate(found) if i) else plain


def train(docs: DataFrame, is_training: Column, text: str = "text", least_trigram: int = LEAST_TRIGRAM) -> Model:
    """Counts the rows that fulfil ``is_training`` and stores the model in the shared folder."""
    if not 1 <= least_trigram <= 3:
        raise ValueError("least_trigram is 1, 2 or 3")
    spark = docs.sparkSession
    folder = mounted(new_path(spark, "language-model"))
    rows = docs.filter(is_training).select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    counted = stage_table(rows.mapInArrow(_count_words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "word-counts")
    distinct = counted.count()
    bits = max(0, (-(-distinct // PART_WORDS) - 1).bit_length())
    part = (F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0)).cast("int")
    empty = spark.range(1 << bits).select(F.lit(0).cast("long").alias("hash"), F.lit(0).cast("long").alias("n"), F.col("id").cast("int").alias("part"))
    saved = counted.withColumn("part", part).unionByName(empty).groupBy("part").applyInArrow(_save_words(folder), "part int, words long, tokens long")
    sizes = sorted(tuple(r) for r in stage_table(saved, "word-parts").collect())
    offsets = [0]
    for _, words, _ in sizes:
        offsets.append(offsets[-1] + words)
    tokens = sum(r[2] for r in sizes)
    parts = max(1, -(-tokens // PART_TOKENS), min(partitions_of(spark), tokens // 100_000))
    model = Model(folder, offsets[-1], tokens, bits, tuple(offsets[:-1]), parts, least_trigram, (), ())
    # A row for each part, so that each has its files: a missing file is then an error, not a part without words.
    each_part = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(None).cast("binary").alias("payload"))
    sums = [F.sum(n).alias(n) for n in ("n1", "n2", "n3", "n4", "total")] + [F.sum(F.col("classes")[i]).alias(f"class{i + 1}") for i in range(3)]
    sent = rows.mapInArrow(_count_trigrams(model), "part int, payload binary")
    found: dict[int, Row] = {}
    before: list[str] = []
    for level, merge in ((3, _merge_trigrams), (2, _merge_pairs), (1, _merge_words)):
        staged: list[str] = []
        parted = sent.select("part", "payload").unionByName(each_part).groupBy("part").applyInArrow(merge(model), LEVEL_FIELDS)
        counted = stage_table(parted, f"level-{level}", staged)
        found[level] = counted.filter(F.col("level") == level).agg(*sums).first()
        sent = counted.filter("level = 0")
        release_tables(spark, before)
        before = staged
    release_tables(spark, before)
    of = lambda r: tuple(int(r[f"n{i}"] or 0) for i in range(1, 5))
    unigrams = tuple(int(found[1][n] or 0) for n in ("total", "class1", "class2", "class3"))
    return Model(folder, model.words, tokens, bits, model.word_offsets, parts, least_trigram, tuple(discounts(*of(found[i])) for i in (1, 2, 3)), unigrams)


# ---- scoring


def _discounted(counts: np.ndarray, discount: tuple[float, ...]) -> np.ndarray:
    return np.maximum(counts - np.array(discount)[np.minimum(counts, 3)], 0)


def _mixed(counts: np.ndarray, context: list[np.ndarray], discount: tuple[float, ...], least: int, lower: np.ndarray) -> np.ndarray:
    """One level's probabilities: the discounted share and what is left for the lower level."""
    total, *classes = context
    left = np.zeros(len(total), np.float64)
    for i, n in enumerate(classes, 1):
        left += n * (discount[i] if i >= least else i)  # of counts that are not stored nothing is kept
    safe = np.maximum(total, 1)
    return np.where(total > 0, _discounted(counts, discount) / safe + left / safe * lower, lower)


CONTEXT = ("sums", "class1", "class2", "class3")


def probabilities(model: Model, tokens: Tokens) -> np.ndarray:
    """p(w | u v) of every token."""

    def stored(name: str, keys: np.ndarray, part_key: np.ndarray, arrays: tuple[str, ...]) -> list[np.ndarray]:
        return _look_up(model.folder, name, model.parts, part_of(part_key, model.parts), keys.astype(np.uint64), arrays)

    numbers, w = tokens.numbers, tokens.local
    size = len(numbers)
    total, *classes = model.unigrams
    left = sum(n * model.discounts[0][i] for i, n in enumerate(classes, 1)) / total if total else 1.0
    (fronts,) = stored("grams1", numbers, numbers, ("counts",))
    p1 = _discounted(fronts, model.discounts[0]) / max(total, 1) + left / (model.words + 1)

    # A pair is the last two words of a context as well: the context of a word is the pair before it.
    pairs, pair = np.unique(tokens.before(w) * size + w, return_inverse=True)
    v, own = numbers[pairs // size], numbers[pairs % size]
    keys = v * model.size + own
    (counts,) = stored("grams2", keys, v, ("counts",))
    context = [x[pairs // size] for x in stored("contexts2", numbers, numbers, CONTEXT)]
    p2 = _mixed(counts, context, model.discounts[1], 1, p1[pairs % size])

    beginning = len(pairs)
    context_of = np.concatenate([[beginning], pair[:-1]])
    context_of[tokens.first] = beginning
    keys = np.append(keys, model.words * model.size + model.words)
    context = stored("contexts3", keys, keys, CONTEXT)
    out = p2[pair]
    # Only where a context has stored trigrams is there more to know.
    more = np.flatnonzero(context[0][context_of] > 0)
    grams, gram = np.unique(context_of[more] * size + w[more], return_inverse=True)
    at = grams // size
    (counts,) = stored("grams3", trigram_key(keys[at], numbers[grams % size]), keys[at], ("counts",))
    found = context_of[more]
    out[more] = _mixed(counts[gram], [x[found] for x in context], model.discounts[2], model.least_trigram, out[more])
    return out


RESULT = StructType(
    [StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("base_score", DoubleType()), StructField("score", DoubleType())]
)


def _score(model: Model, text: str, out: str, columns: list[str]):
    kind = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in word_arrays.buffers(batches, text, BUFFER_BYTES):
            tokens = Tokens(_texts(table, text), model)
            counts = _word_counts(model, tokens.numbers)
            base = np.log10((counts + 1) / (model.tokens + model.words + 1))[tokens.local]
            score = np.log10(probabilities(model, tokens))
            sums = lambda x: np.bincount(tokens.text, x, minlength=table.num_rows)  # noqa: B023, E731
            known = sums((counts > 0)[tokens.local].astype(np.float64)).astype(np.int64)
            result = pa.StructArray.from_arrays([pa.array(tokens.sizes.astype(np.int64)), pa.array(known), pa.array(sums(base)), pa.array(sums(score))], fields=list(kind))
            yield from table.select(columns).append_column(out, result).combine_chunks().to_batches()

    return run


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "lm") -> DataFrame:
    """Adds ``out``: the tokens of each text, how many are known, and the base and the model's log10 probability."""
    kept = docs.drop(out)
    schema = StructType([*kept.schema.fields, StructField(out, RESULT)])
    return kept.mapInArrow(_score(model, text, out, kept.columns), schema)


def perplexity(log10: Column, tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -log10 / tokens)


def uniform_log10(model: Model) -> float:
    """What a word scores without any model."""
    return -math.log10(model.words + 1)
