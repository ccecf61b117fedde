"""Binned training rows in chunks, and what the trees that grow on them add up."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle

# Send these functions to executors inside the closures, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS, SLICE_ROWS = 1 << 18, 1 << 15
CHUNK_DDL = "part int, chunk int, label binary, bins binary, score binary"
SUMS_DDL = "tree int, part int, chunk int, sums binary"
#: Share of the 65,536 draws that weigh 0, 1, 2 and so on: Poisson(1), as rows drawn with replacement.
_CDF = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)]))


def bootstrap_weights() -> np.ndarray:
    return np.searchsorted(_CDF, (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


def candidate_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between distinct values: all, or those next to equal shares of the rows."""
    distinct, counts = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < bins:
        return middle
    filled = np.cumsum(counts)
    wanted = np.arange(1, bins) * (filled[-1] / bins)
    after = np.searchsorted(filled, wanted)
    before = np.maximum(after - 1, 0)
    nearest = np.where(np.abs(filled[before] - wanted) < np.abs(filled[np.minimum(after, len(filled) - 1)] - wanted), before, after)
    return middle[np.unique(np.minimum(nearest, len(middle) - 1))]


def pack(cuts: list[np.ndarray]) -> Callable:
    """Chunks of a partition: labels and bins (features by rows) as bytes; a row is left of a cut up to its value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            label, bins = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
            columns = {"part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int32())}
            return pa.RecordBatch.from_pydict(columns | {"label": [label.tobytes()], "bins": [bins.tobytes()], "score": pa.array([b""], pa.binary())})

        for batch in batches:
            if any(batch.column(name).null_count for name in ("label", "x")):
                raise ValueError("a training row has no label or no features")
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            held.append((batch.column("label").to_numpy().astype(np.uint8), np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)]).astype(np.uint8)))
            rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                yield out()
                chunk, held, rows = chunk + 1, [], 0
        if held:
            yield out()

    return run


def every_nth(n: int) -> Callable:
    """One row of ``n`` in each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = 0
        for batch in batches:
            yield batch.take(pa.array(np.arange(-rows % n, batch.num_rows, n)))
            rows += batch.num_rows

    return run


def rescored(trees: list) -> Callable:
    """The chunks with the scores that the trees bring them to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("score")
            scores = [boosted(label, bins, score, trees).tobytes() for _, _, label, bins, score in unpack(iter([batch]))]
            yield batch.set_column(at, "score", pa.array(scores, pa.binary()))

    return run


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for r in range(batch.num_rows):
            label, bins, score = (np.frombuffer(batch.column(n)[r].as_buffer(), t) for n, t in (("label", np.uint8), ("bins", np.uint8), ("score", np.float64)))
            yield batch.column("part")[r].as_py(), batch.column("chunk")[r].as_py(), label, bins, score


def walk(bins: np.ndarray, rows: int, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Node of each row after ``levels`` steps from the root, in a complete tree; a leaf sends its rows left."""
    node = np.zeros(len(at), np.intp)
    for level in range(levels):
        if level:
            place = feature[node]
            place *= rows
            place += at
            right = bins[place] > cut[node]
        else:
            right = bins[feature[0] * rows + at] > cut[0]
        node += node
        node += right
        node += 1
    return node


def scores_after(bins: np.ndarray, score: np.ndarray, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """Scores with the weighted values of further trees added."""
    out, rows = score.copy(), len(score)
    for start in range(0, rows, SLICE_ROWS):
        at = np.arange(start, min(start + SLICE_ROWS, rows))
        for feature, cut, value, weight in trees:
            depth = (len(feature) + 1).bit_length() - 1
            out[start : start + SLICE_ROWS] += weight * value[walk(bins, rows, at, feature, cut, depth) - len(feature)]
    return out


def boosted(label: np.ndarray, bins: np.ndarray, score: np.ndarray, trees: list) -> np.ndarray:
    return scores_after(bins, score if len(score) else np.zeros(len(label)), trees)


def residuals(label: np.ndarray, score: np.ndarray | None) -> np.ndarray:
    """What the next tree is fitted to: signs at first, then the negative gradient of the logistic loss."""
    sign = 2.0 * label - 1
    return sign if score is None else 4 * sign / (1 + np.exp(2 * sign * score))


def level_sums(held, seed: int | None, bins_each: int) -> Callable:
    """Weights and weighted targets by tree, node, feature and bin, of the level that ``held`` broadcasts.

    ``held`` has the level, the feature and cut of all nodes above, the number of each node of the level
    (-1: a leaf, or below one), and for each number the features to look at; for boosting also the trees
    since the scores were stored.
    """
    draws = None if seed is None else bootstrap_weights()

    def out(tree: int, part: int, chunk: int, found: np.ndarray) -> pa.RecordBatch:
        names = {name: pa.array([v], pa.int32()) for name, v in (("tree", tree), ("part", part), ("chunk", chunk))}
        return pa.RecordBatch.from_pydict(names | {"sums": pa.array([found.tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, features, cuts, numbers, looked_at, trees = held.value
        first = (1 << level) - 1
        sums: dict[int, np.ndarray] = {}
        part = chunk = 0
        for part, chunk, label, bins, score in unpack(batches):
            rows = len(label)
            target = None if seed is not None else residuals(label, boosted(label, bins, score, trees) if trees or len(score) else None)
            for tree, (feature, cut, number, look) in enumerate(zip(features, cuts, numbers, looked_at, strict=True)):
                nodes, width = look.shape
                if not nodes:
                    continue
                size = nodes * width * bins_each
                weight = None if seed is None else draws[np.random.Generator(np.random.SFC64([seed, tree, part, chunk])).integers(0, 65_536, rows, np.uint16)]
                found = np.zeros((size, 2), np.float64 if seed is None else np.uint32)
                # As many rows at once as fit a processor's cache, unless there are more sums than rows.
                step = max(SLICE_ROWS, 2 * size)
                for start in range(0, rows, step):
                    at = np.arange(start, min(start + step, rows)) if weight is None else np.flatnonzero(weight[start : start + step]) + start
                    own = number[walk(bins, rows, at, feature, cut, level) - first]
                    if nodes < len(number):
                        inside = own >= 0
                        at, own = at[inside], own[inside]
                    if weight is None:
                        values, base = target[at], own * (width * bins_each)
                        for j in range(width):
                            key = base + bins[look[0, j] * rows + at]
                            key += j * bins_each
                            found[:, 0] += np.bincount(key, None, size)
                            found[:, 1] += np.bincount(key, values, size)
                    else:
                        weights, side, base = weight[at].astype(np.float64), label[at], own * (width * bins_each)
                        both = np.zeros(2 * size)
                        for j in range(width):
                            key = look[:, j][own]
                            key *= rows
                            key += at
                            key = base + bins[key]
                            key += j * bins_each
                            key += key
                            key += side
                            both += np.bincount(key, weights, 2 * size)
                        both = both.reshape(-1, 2)
                        found[:, 0] += both.sum(1).astype(np.uint32)
                        found[:, 1] += both[:, 1].astype(np.uint32)
                if seed is None:
                    # By chunk, as sums of fractions depend on their order: it must not follow the tasks.
                    yield out(tree, part, chunk, found)
                elif tree in sums:
                    sums[tree] += found
                else:
                    sums[tree] = found
        for tree in sorted(sums):
            yield out(tree, part, chunk, sums.pop(tree))

    return run


def best_splits(widths: int, bins_each: int, kind: str) -> Callable:
    """The best split of each node from all sums of its tree: place of the feature, cut, gain, and sums of both sides.

    For weights n and targets s, gini and variance both fall by the growth of the sum of s * s / n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for tree, sums in zip(batch.column("tree").to_pylist(), batch.column("sums"), strict=True):
                found = np.frombuffer(sums.as_buffer(), kind)
                if tree in total:
                    total[tree] += found
                else:
                    total[tree] = found.astype(np.float64)
        for tree, found in total.items():
            left = found.reshape(-1, widths, bins_each, 2).cumsum(axis=2)
            whole = left[:, :1, -1:, :]
            right = left[:, :, -1:, :] - left
            part = lambda x: np.divide(x[..., 1] ** 2, x[..., 0], out=np.zeros(x.shape[:-1]), where=x[..., 0] > 0)
            gain = part(left) + part(right) - part(whole)
            gain = np.where((left[..., 0] > 0) & (right[..., 0] > 0), gain, -np.inf).reshape(len(left), -1)
            best = gain.argmax(axis=1)
            every = np.arange(len(best))
            sides = left.reshape(len(best), -1, 2)[every, best]
            out = np.column_stack([best // bins_each, best % bins_each, gain[every, best], whole.reshape(-1, 2), sides])
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "splits": [out.tobytes()]})

    return run
