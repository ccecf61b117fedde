"""Sharding: minimax contiguous partition of ordered atomic groups.

Groups are documents of equal text, ordered by a 63-bit hash of the text; a group is never divided
(two texts of equal hash form one group).  The smallest feasible capacity is found by binary search
with a greedy check.  A group larger than the capacity forms a shard of its own, so one huge group
does not leave the other shards uneven.

The ordered sizes are never gathered: the driver sees sums of at most ``MOST_BLOCKS`` key ranges.
Greedy checks over those sums bound the capacity from both sides and so bound where each cut can
lie; only ranges at possible cuts are divided again, until every range there is one group.

A null text counts as no bytes and shares the group of empty texts.  Repeated rows are rows like any
other; an empty table gives an empty result; further columns are dropped.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate, zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import rank_within, text_or_empty
from gaugeline.sources.workspace import stage_table

ROW_OVERHEAD_BYTES = 8
KEY_BITS = 63
FIRST_BITS = 16
MOST_BLOCKS = 1 << FIRST_BITS
#: A range with more than this part of an even shard is divided before cuts are looked for.
COARSE_PART = 64


class Blocks:
    """Sums of contiguous key ranges in key order: (first key, width in bits, size, groups)."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        self.rows = sorted(rows)
        self.ends = list(accumulate((r[2] for r in self.rows), initial=0))
        self.single = [r[3] == 1 or r[1] == 0 for r in self.rows]
        self.total = self.ends[-1]

    def greedy(self, capacity: int, shards: int, divisible: bool) -> list[int] | None:
        """The places of the cuts in the running size, or None if the capacity is too small.

        A range of several groups is taken whole, or, if ``divisible``, may be cut anywhere; the
        true greedy cuts lie between the two.
        """
        at, cuts = 0, []
        while at < self.total:
            if len(cuts) == shards:
                return None
            i = bisect_right(self.ends, at) - 1
            j = bisect_right(self.ends, at + capacity) - 1
            reach = self.ends[j]
            if j < len(self.rows) and divisible and not self.single[j]:
                reach = at + capacity
            elif j == i:
                if not self.single[i]:
                    return None
                reach = self.ends[i + 1]
            cuts.append(reach)
            at = reach
        return cuts

    def least(self, shards: int, divisible: bool) -> int:
        """The smallest feasible capacity, by binary search."""
        low, high = 1, max(1, self.total)
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, shards, divisible) is None:
                low = mid + 1
            else:
                high = mid
        return low

    def to_divide(self, shards: int) -> list[int]:
        """Ranges of several groups that matter: overly large ones, or those where a cut may lie."""
        coarse = max(1, self.total // (shards * COARSE_PART))
        large = [i for i, r in enumerate(self.rows) if not self.single[i] and r[2] > coarse]
        if large:
            return large
        # The true capacity lies between the two, so each of its cuts does as well.
        earliest = self.greedy(self.least(shards, True), 2 * shards + 2, False) or []
        latest = self.greedy(self.least(shards, False), shards, True) or []
        found = set()
        for low, high in zip_longest(earliest, latest, fillvalue=self.total):
            low, high = min(low, high), max(low, high)
            i, j = max(0, bisect_right(self.ends, low) - 1), min(len(self.rows), bisect_left(self.ends, high) + 1)
            found.update(k for k in range(i, j) if not self.single[k])
        return sorted(found)

    def cut_keys(self, shards: int) -> list[int]:
        """The first key of every shard but the first."""
        cuts = self.greedy(self.least(shards, False), shards, False) or []
        return [self.rows[bisect_left(self.ends, c)][0] for c in cuts if c < self.total]


def text_key(text: Column) -> Column:
    """A non-negative 63-bit key that is equal for equal texts."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS)


def _sums(groups: DataFrame, parts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Sums of the sub-ranges of each part (first key, width in bits, width of a sub-range)."""
    spark = groups.sparkSession
    cell = KEY_BITS - FIRST_BITS
    wanted = spark.createDataFrame(
        [(first >> cell, first, 1 << width, sub) for first, width, sub in parts], "cell long, first long, width long, sub int"
    )
    found = (
        groups.withColumn("cell", F.shiftright("key", cell))
        .join(F.broadcast(wanted), "cell")  # at most MOST_BLOCKS rows
        .filter((F.col("key") >= F.col("first")) & (F.col("key") - F.col("first") < F.col("width")))
        .withColumn("start", F.expr("first + shiftleft(shiftright(key - first, sub), sub)"))
        .groupBy("start", "sub")
        .agg(F.sum("size").alias("size"), F.count("*").alias("groups"))
    )
    return [(r["start"], r["sub"], r["size"], r["groups"]) for r in found.collect()]


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """First keys of the shards after the first; ``groups`` has one row per key (key, size)."""
    cell = KEY_BITS - FIRST_BITS
    rows = [
        (r["cell"] << cell, cell, r["size"], r["groups"])
        for r in groups.groupBy(F.shiftright("key", cell).alias("cell"))
        .agg(F.sum("size").alias("size"), F.count("*").alias("groups"))
        .collect()  # at most MOST_BLOCKS rows
    ]
    while True:
        blocks = Blocks(rows)
        chosen = blocks.to_divide(shards)
        if not chosen:
            return blocks.cut_keys(shards)
        bits = max(1, (MOST_BLOCKS // len(chosen)).bit_length() - 1)
        parts = [(blocks.rows[i][0], blocks.rows[i][1], max(0, blocks.rows[i][1] - bits)) for i in chosen]
        skipped = set(chosen)
        rows = [r for i, r in enumerate(blocks.rows) if i not in skipped] + _sums(groups, parts)


def shard_documents(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its size, text checksum, shard and gapless slot in the shard."""
    body = text_or_empty(f"`{text}`")
    sized = stage_table(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            (F.octet_length(body) + F.lit(ROW_OVERHEAD_BYTES)).cast("long").alias("size"),
            F.crc32(body).cast("long").alias("text_crc32"),
            text_key(body).alias("key"),
        ),
        "sized",
    )
    groups = stage_table(sized.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    cuts = minimax_cuts(groups, shards)
    shard = sum((F.when(F.col("key") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    placed = sized.withColumn("shard", shard.cast("int"))
    return rank_within(placed, "shard", [F.col("key"), F.col("doc_id"), F.col("size"), F.col("text_crc32")], "slot")
