"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Candidates are dealt into blocks.  In a block every component is a list sorted by value; a query
reads the list of each component from the end that its own sign makes best.  After each reading
depth a candidate's score is bounded: what was read counts exactly, what was not lies between the
worst value of its list and the last value read.  A query stops once few candidates can still reach
its k-th lower bound; only those are scored in full.  Lists read to the end give exact scores, so
the result does not depend on the depths.  The k best of all blocks are then ranked per query.

Queries are a stated set; they meet the candidates block by block, and a task holds one block of
each.  Null vectors, vectors with a null or non-finite component and rows without an id take no
part.  Vectors of different lengths are not compared.  Ties go to the smaller id; repeated rows are
candidates as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.sources.workspace import stage_table

CANDIDATE_BLOCK, QUERY_BLOCK = 8_192, 1_024
#: Parts of the lists read before the next check of the bounds.
DEPTHS = (1 / 8, 1 / 3, 1)
#: A query stops early with at most this many candidates left for each result.
LEFT_PER_RESULT = 8
#: Above this bound scores leave the whole numbers that doubles hold.
EXACT = float(1 << 53)


def whole_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, vector of whole numbers, dim) of the rows that take part."""
    values = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        df.filter(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{vector}`").isNotNull())
        .filter(usable)
        .select(
            F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
            F.transform(values, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("vector"),
            F.size(f"`{vector}`").alias("dim"),
        )
    )


def block_best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query place, candidate place, score) of at least the k best candidates of every query."""
    number = np.float64 if (np.abs(queries).sum(axis=1).max(initial=0) * float(np.abs(vectors).max(initial=0))) < EXACT else object
    q, x = queries.astype(number), vectors.astype(number)
    count = len(x)
    by_value = np.argsort(vectors, axis=0, kind="stable")
    sorted_values = np.take_along_axis(x, by_value, axis=0)
    rank = np.empty_like(by_value)
    np.put_along_axis(rank, by_value, np.broadcast_to(np.arange(count)[:, None], by_value.shape), axis=0)
    # A query reads from the top where it is positive and from the bottom where it is negative.
    signed = np.hstack([np.maximum(q, 0), np.minimum(q, 0)])
    open_queries = np.arange(len(q))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for part in DEPTHS:
        if not len(open_queries):
            break
        depth = min(count, max(1, int(count * part)))
        top, bottom = rank >= count - depth, rank < depth
        high = np.hstack([np.where(top, x, sorted_values[count - depth]), np.where(bottom, x, sorted_values[depth - 1])])
        low = np.hstack([np.where(top, x, sorted_values[0]), np.where(bottom, x, sorted_values[-1])])
        mine = signed[open_queries]
        lower = mine @ low.T
        upper = lower if depth == count else mine @ high.T
        own = query_ids[open_queries][:, None] == ids[None, :]
        lower = np.where(own, -np.inf, lower)
        least = np.partition(lower, count - k, axis=1)[:, count - k] if count > k else np.full(len(mine), -np.inf)
        able = (upper >= least[:, None]) & ~own
        few = np.ones(len(mine), bool) if depth == count else able.sum(axis=1) <= LEFT_PER_RESULT * k
        place, candidate = np.nonzero(able & few[:, None])
        place = open_queries[place]
        # Whoever is left gets the full score.
        score = np.array([(q[p] * x[c]).sum() for p, c in zip(place, candidate, strict=True)]) if number is object else np.einsum("ij,ij->i", q[place], x[candidate])
        found.append((place, candidate, score))
        open_queries = open_queries[~few]
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _best_of_blocks(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(table: pa.Table) -> np.ndarray:
        flat = table.column("vector").combine_chunks().flatten().to_numpy()
        return flat.reshape(table.num_rows, -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        query_ids, ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        place, candidate, score = block_best(matrix(left), query_ids, matrix(right), ids, k)
        query, vec, score = query_ids[place], ids[candidate], score.astype(np.int64)
        # The k best of each query row in this block; ties to the smaller id.
        by = np.lexsort((vec, -score, place))
        place = place[by]
        nth = np.arange(len(by)) - np.searchsorted(place, place)
        by = by[nth < k]
        return pa.Table.from_arrays([pa.array(query[by]), pa.array(vec[by]), pa.array(score[by])], schema=schema)

    return run


def top_k(df: DataFrame, is_query: Column, k: int, scale: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on ``vec_id``."""
    rows = stage_table(whole_vectors(df, vec_id, vector, scale), "vectors")
    queries = rows.filter(is_query).distinct()
    candidate_blocks = max(1, -(-rows.count() // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def dealt(side: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int")
        return side.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = dealt(queries, "query_block", query_blocks, "block", candidate_blocks)
    right = dealt(rows, "block", candidate_blocks, "query_block", query_blocks)
    keys = ["query_block", "block", "dim"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best_of_blocks(k), "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(place).cast("int"))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
