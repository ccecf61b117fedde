"""Phrase collocation mining by SON partitioning.

The documents fall into shards.  Each shard is mined completely, level by level (words, pairs, and
so on: a phrase is only looked for where both its parts one word shorter are frequent), at a support
lowered in proportion: the global support times the shard's share of all text bytes of the language.
A phrase that reaches the global support reaches the lowered one in at least one shard, so the union
of what the shards return misses none.  Shards return counts as well: where these, and one less than the
lowered support for every shard that did not return the phrase, stay below the global support, the phrase
cannot reach it and leaves the union.  A second pass counts all phrases of that union in all
documents, exactly.

Shards are what a task reads, merged without a shuffle into as few as keep the lowered support at
``LEAST_LOCAL`` or more, and cut where a shard holds half more than ``SHARD_BYTES`` of text; so a task's
memory is bounded.  With so much text that the lowered support would fall below ``LEAST_MINED``, shards
would return nearly every phrase: then the union is found level by level over all shards instead
(``_by_levels``).  The union reaches the counting pass as a Bloom filter of at most ``FILTER_BITS``.  A
false positive of the filter is counted like any phrase and falls to the global support, as a filter
answers the same everywhere.

Within a task words are told apart by 64-bit hashes; across tasks phrases are compared as text.

A null text is empty, a null language is ``und``, an empty table gives an empty result.  Repeated
rows count as often as they occur, whatever their ids.  Texts of any length are taken whole.  Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm import word_arrays
from gaugeline.llm.common import partitions_of
from gaugeline.sources.workspace import broadcast_if_small, stage_table

PIECE_BREAKS = ".,;:!?\x0a\x0b\x0c\x0d"
WORD_BREAKS = " \t"
NO_LANGUAGE = "und"
#: Text of a shard, of which it may exceed by half, and what is turned into word numbers at once.
SHARD_BYTES, ADD_BYTES = 64 << 20, 4 << 20
LEAST_LOCAL = 6
#: Below this lowered support phrases are mined level by level, in shards of so much text.
LEAST_MINED = 3
LEVEL_BYTES = 16 << 20
#: Places whose phrases are told apart at once, and rows of a batch that goes out.
PLACES, ROWS_OUT = 1 << 20, 1 << 16
#: Bits of the largest filter (32 MB) and of it for each phrase; probes of each phrase.
FILTER_BITS, BITS_EACH, PROBES = 1 << 28, 16, 4
#: A filter is built in this many parts.
FILTER_PARTS = 64
EXACT = "decimal(38,0)"

_PIECE = word_arrays.byte_set(PIECE_BREAKS)
_BREAK = word_arrays.byte_set(PIECE_BREAKS + WORD_BREAKS)
#: From (words, counts, hashes) of the phrases met to those to keep.
Keep = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


class Words:
    """Numbered words of the texts of one language, a zero between pieces; texts come bit by bit."""

    def __init__(self, lang: str):
        self.total = 0
        self.seed = np.array([hash_of(lang)], np.uint64)
        self.number: dict[int, int] = {}
        self.names: list[bytes] = [b""]
        self.runs: list[np.ndarray] = []

    def add(self, texts: list[bytes]) -> None:
        data, _ = word_arrays.joined(texts)
        starts, ends, hashes = word_arrays.words(data, _BREAK)
        distinct, first, local = np.unique(hashes, return_index=True, return_inverse=True)
        own = np.empty(len(distinct), np.int32)
        for i, (h, at) in enumerate(zip(distinct.tolist(), first.tolist(), strict=True)):
            found = self.number.get(h)
            if found is None:
                found = self.number[h] = len(self.names)
                self.names.append(word_arrays.lower(data[starts[at] : ends[at]]))
            own[i] = found
        piece = np.searchsorted(np.flatnonzero(_PIECE[np.frombuffer(data, np.uint8)]), starts)
        opens = np.diff(piece, prepend=-1) > 0
        run = np.zeros(len(starts) + int(opens.sum()) + 1, np.int32)
        run[np.arange(len(starts)) + np.cumsum(opens)] = own[local]
        self.total += len(starts)
        self.runs.append(run)

    def levels(self, most_words: int, keep: Keep) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(words, counts, hashes, place of the phrase without its last word, last word) of kept phrases.

        The phrases of one length come in parts that follow each other, so that only their hashes are held.
        """
        run = np.concatenate([*self.runs, np.zeros(1, np.int32)])
        self.runs = [run]
        size = len(self.names)
        words = word_arrays.join_hash(self.seed, np.fromiter(self.number, np.uint64, size - 1))
        words = np.concatenate([np.zeros(1, np.uint64), words])
        counts = np.bincount(run, minlength=size)
        counts[0] = 0
        kept = np.flatnonzero((counts > 0) & keep(1, counts, words))
        place = np.full(size, -1, np.int32)
        place[kept] = np.arange(len(kept))
        hashes = words[kept]
        yield 1, counts[kept], hashes, kept, kept
        at = place[run]
        for length in range(2, most_words + 1):
            begins = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0)).astype(np.int32)
            begins = begins[begins < len(run) - length + 1]
            following = np.full(len(run) if length < most_words else 0, -1, np.int32)
            found: list[np.ndarray] = []
            total = 0
            # Phrases by their beginning, a few million places at once.
            parts = max(1, -(-len(begins) // PLACES))
            for part in range(parts):
                own = begins[at[begins] % parts == part] if parts > 1 else begins
                key = at[own].astype(np.int64) * size + run[own + (length - 1)]
                distinct, number, counts = np.unique(key, return_inverse=True, return_counts=True)
                before, last = distinct // size, distinct % size
                joined = word_arrays.join_hash(hashes[before], words[last])
                kept = np.flatnonzero(keep(length, counts, joined))
                yield length, counts[kept], joined[kept], before[kept], last[kept]
                if length < most_words:
                    place = np.full(len(distinct), -1, np.int32)
                    place[kept] = np.arange(total, total + len(kept))
                    following[own] = place[number]
                    found.append(joined[kept])
                total += len(kept)
            if not total or length == most_words:
                return
            hashes = np.concatenate(found)
            at = following


def hash_of(lang: str) -> int:
    return word_arrays.xxhash.xxh64_intdigest(lang.encode("utf-8"))


class Shard:
    """The words of a shard by language, with the bytes of its texts."""

    def __init__(self) -> None:
        self.words: dict[str, Words] = {}
        self.bytes: dict[str, int] = {}
        self.whole: dict[str, int] = {}

    def add(self, table: pa.Table) -> None:
        for lang in table.column("lang").unique().to_pylist():
            rows = table.filter(pa.compute.equal(table.column("lang"), lang))
            texts = rows.column("text").cast(pa.binary()).to_pylist()
            self.words.setdefault(lang, Words(lang)).add(texts)
            self.bytes[lang] = self.bytes.get(lang, 0) + sum(map(len, texts))
            if "lang_bytes" in rows.column_names:
                self.whole[lang] = int(rows.column("lang_bytes")[0].as_py())


def _shards(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[Shard]:
    """What a task reads as one shard, or as several if it reads more than ``most_bytes``."""
    shard = Shard()
    for table in word_arrays.buffers(batches, "text", min(ADD_BYTES, most_bytes)):
        shard.add(table)
        if sum(shard.bytes.values()) >= most_bytes:
            yield shard
            shard = Shard()
    if shard.words:
        yield shard


def _mine(support: int, most_words: int, most_bytes: int):
    schema = pa.schema([("lang", pa.string()), ("hash", pa.int64()), ("excess", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, most_bytes):
            for lang, words in shard.words.items():
                local = max(1, -(-support * shard.bytes[lang] // max(1, shard.whole[lang])))
                # What a phrase may have here unreturned, on the language's own row.
                yield pa.RecordBatch.from_pydict({"lang": [lang], "hash": [None], "excess": [local - 1]}, schema=schema)
                for _, counts, hashes, _, _ in words.levels(most_words, lambda length, counts, hashes: counts >= local):  # noqa: B023
                    columns = [pa.repeat(lang, len(hashes)), pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64) - (local - 1))]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _mine_levels(lengths: tuple[int, ...], most_bytes: int, held):
    """Counts of the phrases of ``lengths`` words whose shorter parts are in the filters of the levels before."""
    schema = pa.schema([("hash", pa.int64()), ("n", pa.int64())])

    def keep(length: int, counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        return np.ones(len(hashes), bool) if length >= lengths[0] else in_filter(held[length].value, hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, most_bytes):
            while shard.words:
                _, words = shard.words.popitem()
                for length, counts, hashes, _, _ in words.levels(lengths[-1], keep):
                    for at in range(0, len(hashes) if length >= lengths[0] else 0, ROWS_OUT):
                        some = slice(at, at + ROWS_OUT)
                        columns = [pa.array(hashes[some].view(np.int64)), pa.array(counts[some].astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _passes(most_words: int) -> list[tuple[int, ...]]:
    """Lengths that are counted together: words with pairs, triples, then two lengths at a time."""
    passes = [(1, 2), (3,), *((n, n + 1) for n in range(4, most_words + 1, 2))]
    return [tuple(n for n in lengths if n <= most_words) for lengths in passes if lengths[0] <= most_words]


def _by_levels(rows: DataFrame, support: int, most_words: int, shards: int, most_bytes: int) -> DataFrame:
    """Hashes of all phrases that reach the support, from counts over all shards at each level.

    A phrase is only counted where both its parts one word shorter reach the support in the whole table, or
    are of the same pass.  Nothing rests on a shard's own counts, so shards may be as small as memory wants.
    """
    spark = rows.sparkSession
    union, held = None, {}
    for lengths in _passes(most_words):
        found = rows.coalesce(shards).mapInArrow(_mine_levels(lengths, most_bytes, held), "hash long, n long")
        # A task's rows hardly repeat, so they meet by hash without being summed up before.
        often = found.repartition("hash").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= support).select("hash")
        often = stage_table(often, "often")
        union = often if union is None else union.unionByName(often)
        if lengths[-1] < most_words:
            filter_held = spark.sparkContext.broadcast(bloom_filter(often, _filter_bits(often.count())))
            held = held | dict.fromkeys(lengths, filter_held)
    return union


def _filter_bits(members: int) -> int:
    wanted, bits = min(FILTER_BITS, BITS_EACH * max(1, members)), FILTER_PARTS * 8
    while bits < wanted:
        bits *= 2
    return bits


def _bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Probes of each hash within the part of the filter that its last bits name."""
    part_bits = np.uint64(bits // FILTER_PARTS)
    own = hashes % np.uint64(FILTER_PARTS)
    first, step = word_arrays.mix(hashes), word_arrays.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return np.stack([own * part_bits + (first + np.uint64(i) * step) % part_bits for i in range(PROBES)])


def bloom_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of all hashes, its parts set on executors; ``bits`` bound what reaches the driver."""
    part_bits = bits // FILTER_PARTS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            places = np.sort(_bit_places(batch.column("hash").to_numpy().view(np.uint64), bits).ravel()).astype(np.int64)
            for part in np.unique(places // part_bits).tolist():
                own = places[np.searchsorted(places, part * part_bits) : np.searchsorted(places, (part + 1) * part_bits)]
                held = parts.setdefault(part, np.zeros(part_bits, bool))
                held[own - part * part_bits] = True
        for part, held in parts.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(held).tobytes()], pa.binary())})

    part = F.pmod("hash", F.lit(FILTER_PARTS))
    rows = hashes.repartition(FILTER_PARTS, part).mapInArrow(build, "part int, bits binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.toLocalIterator():
        out[r["part"] * part_bits // 8 : (r["part"] + 1) * part_bits // 8] |= np.frombuffer(r["bits"], np.uint8)
    return out


def in_filter(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for places in _bit_places(hashes, len(held) * 8):
        found &= (held[places >> np.uint64(3)] >> (np.uint8(7) - (places & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1
    return found


def _count(most_words: int, most_bytes: int, held):
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, most_bytes):
            while shard.words:
                lang, words = shard.words.popitem()
                # The language's words, all of them, travel as a phrase without words.
                yield pa.RecordBatch.from_pydict({"lang": [lang], "words": [0], "phrase": [""], "n": [words.total]}, schema=schema)
                level, text, shorter = 1, [], []
                for length, counts, _, before, last in words.levels(most_words, lambda length, counts, hashes: in_filter(held.value, hashes)):
                    if length > level:
                        level, text, shorter = length, [], text
                    own = [words.names[w] for w in last.tolist()]
                    part = own if length == 1 else [shorter[b] + b" " + w for b, w in zip(before.tolist(), own, strict=True)]
                    if length < most_words:
                        text += part
                    for at in range(0, len(part), ROWS_OUT):
                        some = part[at : at + ROWS_OUT]
                        columns = [pa.repeat(lang, len(some)), pa.repeat(pa.scalar(length, pa.int32()), len(some)), pa.array(some, pa.binary()).cast(pa.string())]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[at : at + ROWS_OUT].astype(np.int64))], schema=schema)

    return run


def _by_shards(rows: DataFrame, totals: DataFrame, support: int, most_words: int, shards: int, most_bytes: int) -> DataFrame:
    """Hashes of the phrases that may reach the support, from what each shard returns at its lowered one."""
    dealt = rows.join(broadcast_if_small(totals), "lang").coalesce(shards)
    mined = dealt.mapInArrow(_mine(support, most_words, most_bytes), "lang string, hash long, excess long")
    returned = stage_table(mined.groupBy("lang", "hash").agg(F.sum("excess").alias("excess")), "locally-frequent")
    unreturned = returned.filter("hash IS NULL").select("lang", F.col("excess").alias("elsewhere"))
    possible = returned.filter("hash IS NOT NULL").join(broadcast_if_small(unreturned), "lang")
    return stage_table(possible.filter(F.col("excess") + F.col("elsewhere") >= support).select("hash"), "candidates")


def frequent_phrases(
    docs: DataFrame, support: int, most_words: int = 5, text: str = "text", lang: str = "lang", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(lang, words, phrase, n): every phrase of up to ``most_words`` words that occurs ``support`` times.

    A row with ``words`` 0 holds the number of all word occurrences of each language.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    totals = stage_table(rows.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long")).alias("lang_bytes")), "language-bytes")
    whole = totals.agg(F.sum("lang_bytes")).first()[0] or 0
    full = -(-whole // shard_bytes)
    if full > 1 and support < LEAST_MINED * full:
        shard_bytes = min(shard_bytes, LEVEL_BYTES)
        shards, most_bytes = -(-whole // shard_bytes), shard_bytes * 3 // 2
        union = _by_levels(rows, support, most_words, shards, most_bytes)
    else:
        shards, most_bytes = max(1, support // LEAST_LOCAL, full), shard_bytes * 3 // 2
        union = _by_shards(rows, totals, support, most_words, shards, most_bytes)
    held = spark.sparkContext.broadcast(bloom_filter(union, _filter_bits(union.count())))
    counted = rows.coalesce(shards).mapInArrow(_count(most_words, most_bytes, held), "lang string, words int, phrase string, n long")
    summed = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return stage_table(summed.filter((F.col("words") == 0) | (F.col("n") >= support)), "frequent-phrases")


def collocations(frequent: DataFrame, top: int, factor: int = 1000, least_words: int = 2) -> DataFrame:
    """The ``top`` best phrases of each language: (lang, rank, phrase, a, l, r, n, score), all numbers long.

    Every cut of a phrase into two parts scores floor(``factor`` * a * n / (l * r)) in whole numbers; the
    least score over its cuts counts (ties: the shortest first part).  A phrase inside a longer frequent
    one that occurs as often is dropped: if there is one, there is one that is a single word longer.
    """
    parts = F.split("phrase", " ")
    alone = frequent.filter(F.col("words") > 0).select("lang", "words", "phrase", F.col("n").alias("a"))
    longer = alone.filter(F.col("words") > least_words)
    inner = longer.select(
        "lang",
        "a",
        F.explode(
            F.array(F.array_join(F.slice(parts, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(parts, F.lit(2), F.col("words") - 1), " "))
        ).alias("phrase"),
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("inside"))
    kept = (
        alone.filter(F.col("words") >= least_words)
        .join(covered, ["lang", "phrase"], "left")
        .filter(F.col("inside").isNull() | (F.col("inside") < F.col("a")))
        .drop("inside")
    )
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    counts = alone.select("lang", "phrase", "a")
    counted = cut.join(counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"]).join(
        counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]
    )
    sizes = frequent.filter(F.col("words") == 0).select("lang", F.col("n"))
    scored = counted.join(broadcast_if_small(sizes), "lang").withColumn(
        "score", F.expr(f"(cast({factor} as {EXACT}) * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    )
    least = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    least = least.select("lang", "phrase", "a", "n", F.col("cut.score").alias("score"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold a large share of all phrases: each salt keeps its first rows before they meet.
    salted = least.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(partitions_of(frequent.sparkSession))))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
