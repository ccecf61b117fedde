"""Best-fit packing of token pieces into sequences of bounded length.

Documents longer than a sequence are cut into full pieces, the first piece taking the remainder.
Packing is bulk-synchronous best-fit.  Pieces are range-sorted by length over the cluster, and a
piece's rank is its place among the pieces of its length.  Lengths and gaps lie between 1 and the
capacity, so both sorted sides are runs (length, pieces) and (gap, sequences): a superstep takes
all pieces of the longest length left, sweeps the runs of gaps upwards from that length, and matches
rank by rank; gaps are updated and the next superstep follows.  The sweep sees only the number of
pieces of each length (at most ``capacity`` numbers).  Its outcome, a list of rank ranges with their
sequences, is joined to the ranked pieces on the cluster.

A null text counts as empty (its piece is the end id alone); ties in length are ordered by document
and piece; repeated rows are packed as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import rank_within, text_or_empty
from gaugeline.llm.pieces import tokenizer_encoder
from gaugeline.sources.workspace import broadcast_if_small, stage_table

ID_BYTES = 4


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece of every document."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("text"))
    id_type = narrow.schema["doc_id"].dataType
    end = end_id.to_bytes(ID_BYTES, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_encoder(tokenizer, gaps=True)  # as the default pre-tokenizer of byte-level vocabularies cuts
        for batch in batches:
            rows: list[tuple] = []
            places = []
            for place, ids in enumerate(encoder.encode(batch.column("text").cast(pa.binary()).to_pylist())):
                ids += end
                tokens = len(ids) // ID_BYTES
                cuts = [0, *range(tokens - capacity * ((tokens - 1) // capacity), tokens + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = ids[start * ID_BYTES : stop * ID_BYTES]
                    places.append(place)
                    rows.append((piece, start, stop - start, zlib.crc32(part), part if keep_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            arrays = [
                batch.column("doc_id").take(pa.array(places, pa.int64())),
                pa.array(columns[0], pa.int32()),
                *(pa.array(columns[i], pa.int64()) for i in (1, 2, 3)),
                *([pa.array(columns[4], pa.binary())] if keep_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    schema = f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return narrow.mapInArrow(run, schema + ", ids binary" * keep_ids)


def sweep(pieces_by_length: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Supersteps of best-fit over runs: (length, first rank, end rank, first sequence, offset)."""
    plan = []
    gaps: list[int] = []  # sizes with sequences, sorted
    runs: dict[int, list[tuple[int, int]]] = {}  # of each gap size: (first sequence, sequences)
    sequences = 0

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((first, count))

    for length in sorted(pieces_by_length, reverse=True):
        rank, total = 0, pieces_by_length[length]
        while rank < total:
            i = bisect_left(gaps, length)
            if i < len(gaps):
                gap = gaps[i]
                first, count = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[i]
            else:  # no gap is long enough: new sequences, as many as are filled with this length
                gap, first = capacity, sequences
                count = -(-(total - rank) // (capacity // length))
                sequences += count
            taken = min(count, total - rank)
            plan.append((length, rank, rank + taken, first, capacity - gap))
            leave(gap - length, first, taken)
            leave(gap, first + taken, count - taken)
            rank += taken
    return plan


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with doc_id, piece, start and length."""
    spark = pieces.sparkSession
    placed = rank_within(pieces, "length", [F.col("doc_id"), F.col("piece"), F.col("start")], "_rank")
    counts = {r["length"]: r["count"] for r in placed.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.createDataFrame(sweep(counts, capacity), "length long, _low long, _high long, _sequence long, offset long")
    joined = placed.join(broadcast_if_small(plan), "length").filter("_rank >= _low AND _rank < _high")
    return joined.withColumn("sequence_id", F.expr("_sequence + _rank - _low")).drop("_rank", "_low", "_high", "_sequence")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, **columns) -> DataFrame:
    return pack(stage_table(token_pieces(docs, tokenizer, end_id, capacity, **columns), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences (sequence_id, length, ids) of packed pieces that kept their ids."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.expr("aggregate(sort_array(collect_list(struct(offset, ids))), X'', (a, x) -> concat(a, x.ids))").alias("ids"),
    )
