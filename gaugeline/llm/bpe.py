"""Byte-level BPE encoding and decoding over a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte ranges.  For every rank that some neighbouring pair has, a
bucket holds the positions of those pairs; a three-level bitmap over the ranks tells which buckets
hold any.  Find-first-set down the levels gives the lowest rank, the leftmost position of its bucket
is merged, the two new neighbouring pairs are queued, and entries whose pair has changed since are
skipped when they come up.  Each merge costs the same whatever the length, so pre-tokens of many
thousand bytes need no quadratic scan.

Texts are cut by the vocabulary's pattern; a worker remembers the ids of pieces it has met.  A null
text counts as empty and has no ids.  Documents are encoded in the task that read them, so repeated
rows, skew and further columns need no care; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import text_or_empty
from gaugeline.llm.pieces import LONGEST_REMEMBERED, REMEMBERED, PieceEncoder

WORD = 6  # a bitmap word covers 2 ** WORD entries of the level below
LOW = (1 << WORD) - 1


class RankQueue:
    """Positions in buckets by rank; the lowest rank first, and in it the leftmost position."""

    def __init__(self, ranks: int):
        self.words = [0] * ((ranks >> WORD) + 1)
        self.groups = [0] * ((ranks >> 2 * WORD) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word, group = rank >> WORD, rank >> 2 * WORD
        self.words[word] |= 1 << (rank & LOW)
        self.groups[group] |= 1 << (word & LOW)
        self.top |= 1 << group

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        group = (self.top & -self.top).bit_length() - 1
        bits = self.groups[group]
        word = group << WORD | (bits & -bits).bit_length() - 1
        bits = self.words[word]
        rank = word << WORD | (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.words[word] &= ~(1 << (rank & LOW))
            if not self.words[word]:
                self.groups[group] &= ~(1 << (word & LOW))
                if not self.groups[group]:
                    self.top &= ~(1 << group)
        return rank, position


class ByteBpe:
    """A vocabulary of byte strings whose ranks are their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.byte_ids = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.whole = min(self.byte_ids) >= 0
        # The rank of the token that two neighbouring tokens make, by their ids.
        self.pair_rank = {
            (left, right): rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        }
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as file:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, file) if t}, pattern)

    def merge(self, token: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(token)
        if whole is not None:
            return [whole]
        ids = [self.byte_ids[b] for b in token]
        if not self.whole and min(ids) < 0:
            raise ValueError(f"the vocabulary lacks a byte of {token[:40]!r}")
        pair_rank, queue = self.pair_rank.get, self.queue
        for position, pair in enumerate(pairwise(ids)):
            rank = pair_rank(pair)
            if rank is not None:
                queue.push(rank, position)
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        while (entry := queue.pop()) is not None:
            rank, left = entry
            right = after[left]
            # Stale: the left part is gone, or one of the two has grown since.
            if ids[left] < 0 or right >= size or pair_rank((ids[left], ids[right])) != rank:
                continue
            ids[left], ids[right] = rank, -1
            after[left] = behind = after[right]
            if behind < size:
                before[behind] = left
                new = pair_rank((rank, ids[behind]))
                if new is not None:
                    queue.push(new, left)
            front = before[left]
            if front >= 0:
                new = pair_rank((ids[front], rank))
                if new is not None:
                    queue.push(new, front)
        return [i for i in ids if i >= 0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def byte_encoder(path: str, pattern: str) -> tuple[ByteBpe, PieceEncoder]:
    """One per worker process."""
    bpe = ByteBpe.load(path, pattern)
    split = bpe.pattern.findall
    parts: dict[str, bytes] = {}

    def part_ids(part: str) -> bytes:
        known = parts.get(part)
        if known is None:
            known = np.array(bpe.merge(part.encode("utf-8")), "<u4").tobytes()
            if len(part) <= LONGEST_REMEMBERED:
                parts[part] = known
        return known

    def encode_pieces(pieces: list[str]) -> list[bytes]:
        if len(parts) > REMEMBERED // 5:
            parts.clear()
        return [b"".join(map(part_ids, split(p))) for p in pieces]

    return bpe, PieceEncoder(True, False, encode_pieces)


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = True
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]); ids as little-endian 32-bit integers."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = byte_encoder(vocabulary, pattern)
        for batch in batches:
            counts, hashes, decoded, kept = [], [], [], []
            for ids in encoder.encode(batch.column("text").cast(pa.binary()).to_pylist()):
                counts.append(len(ids) // 4)
                hashes.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if keep_ids:
                    kept.append(ids)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * keep_ids, names)

    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return narrow.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, text) of documents with ids; bytes that are no UTF-8 become replacement marks."""
    narrow = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = byte_encoder(vocabulary, pattern)
        for batch in batches:
            texts = [bpe.decode(i).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return narrow.mapInArrow(run, f"doc_id {id_type}, text string")
