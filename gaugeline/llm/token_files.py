"""Token-id files: tokenized documents in the order of their ids, coded in checksummed blocks.

Documents are range-partitioned and sorted by id; each task tokenizes and gathers whole documents
into parts of about ``PART_IDS`` ids.  A file row holds one part: where it belongs, its document ids
and lengths, and the ids coded by ``id_coder`` in independent blocks.  Spark writes and reads the
files, so they may lie in any store.

A null text counts as empty and holds the end id alone.  Null document ids come first; rows with
equal ids follow each other by text hash; an empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import id_coder
from gaugeline.llm.common import partitions_of, text_or_empty
from gaugeline.llm.pieces import tokenizer_encoder
from gaugeline.sources.workspace import new_path

PART_IDS = 8 << 20
FILE_SCHEMA = "part long, number long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, payload binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_or_empty(f"`{text}`").alias("text"))
    ordered = narrow.repartitionByRange(partitions_of(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_encoder(tokenizer, gaps=False)  # the vocabulary drops white space
        task, number = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[bytes] = []
        size = 0

        def part() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            values = [task, number, len(ids), doc_ids, [len(h) // 4 for h in held], id_coder.encode(ids)]
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
            names = ["part", "number", "n_ids", "doc_ids", "lengths", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").cast(pa.binary()).to_pylist()), strict=True):
                doc_ids.append(doc)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= PART_IDS:
                    yield part()
                    number, doc_ids, held, size = number + 1, [], [], 0
        if held:
            yield part()

    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # One row per some million ids reaches the driver.
    parts = sorted((r["part"], r["number"], r["n_ids"]) for r in files.select("part", "number", "n_ids").collect())
    starts, at = [], 0
    for part, number, n_ids in parts:
        starts.append((part, number, at))
        at += n_ids
    placed = files.join(F.broadcast(spark.createDataFrame(starts, "part long, number long, start long")), ["part", "number"])
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_coder.decode(row["payload"])
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                bodies = [b.tobytes() for b in np.split(ids, ends[:-1])]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start"] + ends - lengths),
                    pa.array(lengths),
                    pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(bodies, pa.binary())] * keep_ids, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    return placed.select("doc_ids", "lengths", "start", "payload").mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, keep_ids: bool = True) -> DataFrame:
    """Writes the files below the shared folder and reads them back."""
    path = new_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_documents(docs.sparkSession, path, keep_ids)
