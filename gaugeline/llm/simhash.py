"""SimHash near-dedup: 64-bit fingerprints and a binary trie self-join within a Hamming budget.

Equal fingerprints collapse first, so a group of copies of any size is one row.  If two fingerprints
differ in at most k bits, then of k + p blocks of the 64 bits at least p are equal: the pairs of
every choice of p blocks meet in the bucket of those blocks, and in each bucket a binary trie over
the fingerprints is joined with itself.  Node pairs go down together, differing bits add up, and a
pair of nodes over the budget is dropped.  p follows the number of fingerprints so that buckets of
unrelated fingerprints stay small; the result does not depend on it.  A bucket that is large all the
same (many near copies) is dealt into parts, each pair of parts a task of its own.

A task returns a spanning forest of the links it finds, not all pairs.  Components come from
alternating star steps over staged tables, so no links are gathered and lost executors cost a
re-read.

A null text counts as empty; texts without a word have fingerprint zero and link like any other.
Null document ids take part but name no component, unless all ids of a component are null.
Repeated rows get a row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import partitions_of, text_or_empty
from gaugeline.sources.workspace import broadcast_if_small, stage_table

BITS = 64
HASH_SEED = 42
#: Fingerprints of one bucket in a task's trie; larger buckets are dealt into pairs of parts.
BUCKET_PART = 2_048
#: Buckets of unrelated fingerprints hold about this many at most.
BUCKET_MEAN = 64
#: Rows that a task's tries hold together, and node pairs expanded at once.
CHUNK_ROWS = 32_768
LEAF_PAIRS = 64
LINKS_HELD = 1 << 20


def fingerprint(text: str, words_per_shingle: int) -> int:
    """Bit by bit the majority of the hashes of all word shingles, repeats included."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    last = min(words_per_shingle, len(words)) - 1
    digest = xxhash.xxh64_digest
    ones, total = np.zeros(BITS, np.int64), len(words) - last
    step = 1 << 16
    for at in range(0, total, step):
        stop = min(total, at + step)
        hashes = b"".join(
            [digest(body[s:e], HASH_SEED) for s, e in zip(starts[at:stop], ends[at + last : stop + last].tolist(), strict=True)]
        )
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words_per_shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t, words_per_shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.int64())], ["doc_id", "fingerprint"])

    return narrow.mapInArrow(run, f"doc_id {id_type}, fingerprint long")


def block_masks(blocks: int) -> list[int]:
    """The 64 bits cut into blocks of nearly equal width, as masks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]


def bucket_masks(max_bits: int, count: int) -> list[int]:
    """Masks of which each pair within ``max_bits`` agrees on at least one."""
    equal = 1
    while equal < 4 and count > BUCKET_MEAN << (BITS * equal // (max_bits + equal)):
        equal += 1
    return [sum(chosen) for chosen in combinations(block_masks(max_bits + equal), equal)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Forest:
    """Least labels of linked places, with links folded in as they come."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            a, b = self.label[left], self.label[right]
            different = a != b
            left, right, a, b = left[different], right[different], a[different], b[different]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(self.label, up := self.label[self.label]):
                self.label = up


def trie_links(marks: np.ndarray, first: np.ndarray, last: np.ndarray, max_bits: int) -> np.ndarray:
    """Least place linked to each place; ``marks`` sorted within each range [first, last)."""
    forest = Forest(len(marks))
    ones = [None] * BITS
    # Pairs of trie nodes, each a range of places, with the bits that already differ.
    a0, a1 = first.astype(np.int64), last.astype(np.int64)
    b0, b1 = a0.copy(), a1.copy()
    spent = np.zeros(len(a0), np.int64)
    for bit in range(BITS - 1, -1, -1):
        small = (a1 - a0) * (b1 - b0) <= LEAF_PAIRS
        _leaf_links(marks, a0[small], a1[small], b0[small], b1[small], max_bits, forest)
        a0, a1, b0, b1, spent = (x[~small] for x in (a0, a1, b0, b1, spent))
        if not len(a0):
            break
        ones = np.concatenate([[0], np.cumsum((marks >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        own = (a0 == b0) & (a1 == b1)
        pairs = (
            (a0, am, b0, bm, spent, None),
            (am, a1, bm, b1, spent, None),
            (a0, am, bm, b1, spent + 1, None),
            (am, a1, b0, bm, spent + 1, ~own),
        )
        grown = []
        for x0, x1, y0, y1, cost, when in pairs:
            live = (x1 > x0) & (y1 > y0) & (cost <= max_bits)
            if when is not None:
                live &= when
            grown.append(tuple(v[live] for v in (x0, x1, y0, y1, cost)))
        a0, a1, b0, b1, spent = (np.concatenate(v) for v in zip(*grown, strict=True))
    # After the last bit a node holds one fingerprint: all pairs left are within the budget.
    _leaf_links(marks, a0, a1, b0, b1, max_bits, forest)
    return forest.label


def _leaf_links(marks, a0, a1, b0, b1, max_bits: int, forest: Forest) -> None:
    """Compares the fingerprints of small node pairs, some at a time."""
    count = (a1 - a0) * (b1 - b0)
    ends = np.cumsum(count)
    start = 0
    while start < len(count):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + LINKS_HELD)))
        size = count[start:stop]
        node = np.repeat(np.arange(start, stop), size)
        within = np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size)
        width = (b1 - b0)[node]
        left, right = a0[node] + within // width, b0[node] + within % width
        once = left < right if np.array_equal(a0[start:stop], b0[start:stop]) else left != right
        left, right = left[once], right[once]
        near = np.bitwise_count(marks[left] ^ marks[right]) <= max_bits
        forest.add(left[near], right[near])
        start = stop


def _links_of_task(max_bits: int):
    def chunk_links(bucket: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((marks, bucket))
        bucket, marks = bucket[order], marks[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        last = np.append(first[1:], len(bucket))
        label = trie_links(marks, first, last, max_bits)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(marks[label[linked]].view(np.int64)), pa.array(marks[linked].view(np.int64))], ["left", "right"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_bucket, held_marks = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            held_bucket = np.concatenate([held_bucket, batch.column("bucket").to_numpy()])
            held_marks = np.concatenate([held_marks, batch.column("fingerprint").to_numpy().view(np.uint64)])
            if len(held_bucket) >= CHUNK_ROWS:  # rows come sorted by bucket: all but the last bucket are whole
                cut = int(np.searchsorted(held_bucket, held_bucket[-1]))
                if cut:
                    yield chunk_links(held_bucket[:cut], held_marks[:cut])
                    held_bucket, held_marks = held_bucket[cut:], held_marks[cut:]
        if len(held_bucket):
            yield chunk_links(held_bucket, held_marks)

    return run


def fingerprint_links(marks: DataFrame, max_bits: int) -> DataFrame:
    """Links (left, right) that span every component; ``marks`` has distinct fingerprints."""
    masks = bucket_masks(max_bits, marks.count())
    tasks = partitions_of(marks.sparkSession)
    keyed = marks.select(
        "fingerprint",
        F.explode(
            F.array(
                *[F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)]
            )
        ).alias("bucket"),
    )
    sizes = keyed.groupBy("bucket").count()
    parts = F.ceil(F.col("count") / BUCKET_PART).cast("int")
    large = broadcast_if_small(sizes.filter(F.col("count") > BUCKET_PART).select("bucket", parts.alias("parts")))
    dealt = (
        keyed.join(large, "bucket", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fingerprint",
            F.when(F.col("parts") == 1, F.col("bucket"))
            .otherwise(F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")))
            .alias("bucket"),
        )
    )
    return (
        dealt.repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_links_of_task(max_bits), "left long, right long")
        .distinct()
    )


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component): the least node reachable, for nodes with a link; by alternating star steps."""
    edges = links.select(F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v"))
    edges = stage_table(edges.filter("u > v").distinct(), "stars")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = stage_table(large, "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = stage_table(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
    raise RuntimeError("components did not settle")


def near_duplicates(
    docs: DataFrame, words_per_shingle: int, max_bits: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint as long, component_id) of every row."""
    rows = stage_table(fingerprints(docs, words_per_shingle, doc_id, text), "fingerprints")
    marks = stage_table(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "marks")
    links = stage_table(fingerprint_links(marks.select("fingerprint"), max_bits), "links")
    found = components(links)
    # A fingerprint without a link is its own component.
    named = marks.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = named.join(least, "component").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_mark(mark: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(mark), 16, "0"))
