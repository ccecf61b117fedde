"""Hard-negative mining: windows of inner products searched in cover trees.

A candidate x gets one more component, sqrt(M^2 - |x|^2) with M the largest norm of its block, so that
all candidates lie on a sphere of radius M and the inner product with an anchor q (whose further
component is 0) is |q| M cos(angle).  Blocks of candidates that lie near one pivot hold a cover tree
each: the children of a node are a net of its rows, taken farthest first, and every node knows the
largest angle from its centre to a row below it.  An angle t between anchor and centre and a radius p
then bound every product below the node by |q| M cos(t - p) and |q| M cos(t + p).

A search goes best first: of each anchor's open nodes those with the highest bounds are opened next.
A node is skipped if it lies outside every window of its anchor, or under the worst of the results that
already fill a window.  Rows of leaves are verified by their exact integer product.

The first search finds each anchor's positives (same label, no lower end), the second the negatives
(other labels) in the windows that these positives set.  Every block returns its best few rows of each
window, so what meets across blocks is anchors x blocks x results, whatever the number of candidates.

Rows with a null id, label or vector, or any null or non-finite component take no part.  Vectors of
different lengths are not compared.  Ties go to the smaller id.  A row never meets rows of its own id.
Repeated anchor rows with one id, label and vector are one anchor; anchors of one id that differ in
label or vector are mined separately.  Repeated candidates count as often as they occur.  An empty
table gives an empty result; extra columns are not read.  Products beyond 63 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.sources.workspace import broadcast_if_small, stage_table

#: Rows of a block on average; one tree each.
BLOCK = 8_192
#: Most pivots, whatever the number of rows; further blocks share a pivot.
PIVOTS = 512
ANCHOR_GROUP = 4_096
LEAF, FANOUT, LEAST_CELL = 32, 64, 16
#: Open nodes of each anchor that are opened together, and (anchor, row) pairs held at once.
STEP, PAIRS = 64, 1 << 18
#: Whole numbers up to here are exact as doubles; up to there as 64-bit integers.
EXACT, WHOLE = float(1 << 53), float(1 << 62)
NO_LOW, NO_HIGH = -(1 << 63), (1 << 63) - 1
#: Angles below the first count as none; the second widens all bounds against rounding.
SAME, SLACK = 2e-7, 1e-6


def usable_rows(df: DataFrame, scale: int, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, vector of whole numbers, dim) of the rows that take part."""
    own = F.col(f"`{vector}`")
    values = F.transform(own, lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.filter(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & own.isNotNull()).filter(finite).select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.transform(values, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("vector"),
        F.size(own).alias("dim"),
    )


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


# ---- trees


def unit_rows(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """Directions of the rows with their further component, and the radius of their sphere."""
    x = vectors.astype(np.float64)
    squares = np.einsum("ij,ij->i", x, x)
    radius = float(np.sqrt(squares.max(initial=0)))
    rest = np.sqrt(np.maximum(radius * radius - squares, 0))
    if radius == 0:
        return np.hstack([x, np.ones((len(x), 1))]), 0.0
    return np.hstack([x, rest[:, None]]) / radius, radius


def angle(cosine: np.ndarray) -> np.ndarray:
    """Angles; what rounding makes of equal directions is zero."""
    t = np.arccos(np.clip(cosine, -1.0, 1.0))
    return np.where(t < SAME, 0.0, t)


def build_tree(vectors: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of a cover tree, level by level.

    ``order``: rows, those below a node next to each other; of each node: its ``centre`` (a row),
    ``spread`` (largest angle to a row below it), rows ``begin`` to ``end`` of the order, and children
    ``first`` to ``last`` (none: a leaf); ``pooled`` leaves hold what was too little for a cell.
    """
    units, radius = unit_rows(vectors)
    order = np.arange(len(vectors))
    centre, spread, begin, end, first, last = [0], [float(angle(units @ units[0]).max())], [0], [len(vectors)], [0], [0]
    pooled = [False]
    node = 0
    while node < len(centre):
        size = end[node] - begin[node]
        if size > LEAF and spread[node] > 0 and not pooled[node]:
            rows = order[begin[node] : end[node]]
            own = units[rows]
            near = angle(own @ units[centre[node]])
            whole = near.copy()
            net, to = [centre[node]], np.zeros(size, np.int64)
            # Farthest first: the next centre is the row least covered so far.
            for _ in range(1, min(FANOUT, -(-size // LEAF)) + 1):
                farthest = int(near.argmax())
                if near[farthest] <= 0:
                    break
                distance = angle(own @ own[farthest])
                closer = distance < near
                to[closer] = len(net)
                near[closer] = distance[closer]
                net.append(int(rows[farthest]))
            # The rows of small cells make one leaf around the node's own centre.
            small = np.bincount(to, minlength=len(net)) < LEAST_CELL
            reach = np.where(small[to], whole, near)
            to = np.where(small[to], len(net), to)
            by = np.argsort(to, kind="stable")
            order[begin[node] : end[node]] = rows[by]
            counts = np.bincount(to, minlength=len(net) + 1)
            first[node] = len(centre)
            at = begin[node]
            for child, count in enumerate(counts.tolist()):
                if count:
                    below = reach[by[at - begin[node] : at - begin[node] + count]]
                    centre.append([*net, centre[node]][child])
                    spread.append(float(below.max()))
                    begin.append(at)
                    end.append(at + count)
                    first.append(0)
                    last.append(0)
                    pooled.append(child == len(net))
                    at += count
            last[node] = len(centre)
        node += 1
    return {
        "order": order,
        "radius": np.array([radius]),
        "centre": np.array(centre),
        "spread": np.array(spread),
        "pooled": np.array(pooled),
        **{k: np.array(v) for k, v in (("begin", begin), ("end", end), ("first", first), ("last", last))},
    }


# ---- search


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of all ranges, and of which range each is."""
    sizes = ends - starts
    of = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of], of


def number_kind(most: float) -> type:
    """The numbers that hold products of up to ``most`` exactly."""
    return np.float64 if most < EXACT else np.int64 if most < WHOLE else object


def search(
    tree: dict[str, np.ndarray],
    vectors: np.ndarray,
    ids: np.ndarray,
    labels: np.ndarray,
    queries: np.ndarray,
    query_ids: np.ndarray,
    query_labels: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    same_label: bool,
    k: int,
    seen: dict[str, int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, window, row, score): the ``k`` best rows of each of the anchors' windows, low to high.

    ``low`` and ``high`` hold a row for each anchor; a window whose low is above its high is empty.
    ``seen`` is given the number of (anchor, row) pairs that were verified.
    """
    units, radius = unit_rows(vectors)
    norms = np.sqrt(np.einsum("ij,ij->i", *[queries.astype(np.float64)] * 2))
    directions = queries.astype(np.float64) / np.where(norms > 0, norms, 1)[:, None]
    most = float(np.abs(queries).astype(np.float64).sum(axis=1).max(initial=0)) * float(np.abs(vectors).max(initial=0))
    # Rows below a node lie next to each other.
    kind = number_kind(most)
    wanted, laid = queries.astype(kind), vectors[tree["order"]].astype(kind)
    windows = low.shape[1]
    floor = low.copy()
    held = [np.zeros(0, np.int64)] * 4
    verified = 0

    def bounds(anchors: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centres = units[tree["centre"][nodes]]
        t = angle(np.einsum("ij,ij->i", directions[anchors], centres[:, :-1]))
        p = tree["spread"][nodes] + SLACK
        length = norms[anchors] * radius
        room = 1 + 1e-9 * length
        return length * np.cos(np.minimum(np.pi, t + p)) - room, length * np.cos(np.maximum(0, t - p)) + room

    def useful(anchors: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return ((upper[:, None] >= floor[anchors]) & (lower[:, None] <= high[anchors]) & (low[anchors] <= high[anchors])).any(axis=1)

    def verify(anchors: np.ndarray, nodes: np.ndarray) -> None:
        nonlocal held, verified
        pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        least, largest = floor.min(axis=1), high.max(axis=1)
        by = np.argsort(nodes, kind="stable")
        for own in np.split(by, np.flatnonzero(np.diff(nodes[by])) + 1):
            node, some = nodes[own[0]], anchors[own]
            rows = slice(tree["begin"][node], tree["end"][node])
            score = wanted[some] @ laid[rows].T
            verified += score.size
            # Most rows lie outside all windows of an anchor.
            i, j = np.nonzero((score >= least[some][:, None]) & (score <= largest[some][:, None]))
            pairs.append((some[i], tree["order"][rows][j], score[i, j]))
        anchor, row, score = (np.concatenate(x) for x in zip(*pairs, strict=True))
        fit = (labels[row] == query_labels[anchor]) == same_label
        fit &= ids[row] != query_ids[anchor]
        anchor, row, score = anchor[fit], row[fit], score[fit].astype(np.int64)
        found = [held]
        for w in range(windows):
            inside = (score >= floor[anchor, w]) & (score <= high[anchor, w])
            found.append([anchor[inside], np.full(int(inside.sum()), w), row[inside], score[inside]])
        merged = [np.concatenate(x) for x in zip(*found, strict=True)]
        by = np.lexsort((ids[merged[2]], -merged[3], merged[1], merged[0]))
        group = (merged[0] * windows + merged[1])[by]
        nth = np.arange(len(by)) - np.searchsorted(group, group)
        kth = by[nth == k - 1]
        floor[merged[0][kth], merged[1][kth]] = np.maximum(floor[merged[0][kth], merged[1][kth]], merged[3][kth])
        held = [x[by[nth < k]] for x in merged]

    anchors = np.arange(len(queries))
    nodes = np.zeros(len(queries), np.int64)
    lower, upper = bounds(anchors, nodes)
    while True:
        open_ = useful(anchors, lower, upper)
        anchors, nodes, lower, upper = anchors[open_], nodes[open_], lower[open_], upper[open_]
        if not len(anchors):
            break
        by = np.lexsort((-upper, anchors))
        nth = np.arange(len(by)) - np.searchsorted(anchors[by], anchors[by])
        now, later = by[nth < STEP], by[nth >= STEP]
        leaf = tree["first"][nodes[now]] == tree["last"][nodes[now]]
        # Pairs of one step stay within the memory bound.
        sizes = np.cumsum((tree["end"] - tree["begin"])[nodes[now[leaf]]])
        for part in np.split(now[leaf], np.flatnonzero(np.diff(sizes // PAIRS)) + 1):
            if len(part):
                verify(anchors[part], nodes[part])
        inner = now[~leaf]
        kids, of = _ranges(tree["first"][nodes[inner]], tree["last"][nodes[inner]])
        owner = anchors[inner][of]
        new = [bounds(owner[at : at + PAIRS], kids[at : at + PAIRS]) for at in range(0, len(kids), PAIRS)]
        anchors = np.concatenate([anchors[later], owner])
        nodes = np.concatenate([nodes[later], kids])
        lower = np.concatenate([lower[later], *(n[0] for n in new)])
        upper = np.concatenate([upper[later], *(n[1] for n in new)])
    if seen is not None:
        seen["verified"] = seen.get("verified", 0) + verified
    return tuple(held)


# ---- distribution


def _to_pivot(pivots: dict[int, np.ndarray]):
    """Adds the pivot whose direction is nearest, of those of the row's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            nearest = np.zeros(batch.num_rows, np.int32)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                rows = _matrix(batch.column("vector").take(pa.array(own)), dim).astype(np.float64)
                if dim in pivots and dim:
                    nearest[own] = (rows @ pivots[dim].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], names=[*batch.schema.names, "pivot"])

    return run


def _pack(table: pa.Table) -> pa.Table:
    """One row that holds a block's rows and its tree."""
    dim = table.column("dim")[0].as_py()
    by = np.lexsort((table.column("label").to_numpy(), table.column("vec_id").to_numpy()))
    table = table.take(pa.array(by))
    vectors = _matrix(table.column("vector"), dim)
    tree = build_tree(vectors)
    arrays = {"vectors": vectors, "ids": table.column("vec_id").to_numpy(), "labels": table.column("label").to_numpy(), **tree}
    packed = [pa.array([np.ascontiguousarray(arrays[name], kind).tobytes()], pa.binary()) for name, kind in PACKED]
    return pa.table([pa.array([dim], pa.int32()), table.column("block").slice(0, 1), *packed], names=["dim", "block", *(n for n, _ in PACKED)])


PACKED = (
    ("vectors", np.int64),
    ("ids", np.int64),
    ("labels", np.int64),
    ("order", np.int64),
    ("radius", np.float64),
    ("centre", np.int64),
    ("spread", np.float64),
    ("begin", np.int64),
    ("end", np.int64),
    ("first", np.int64),
    ("last", np.int64),
)
TREE_SCHEMA = "dim int, block long, " + ", ".join(f"{n} binary" for n, _ in PACKED)


def cover_trees(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(dim, block, packed tree) of staged ``usable_rows``; blocks hold about ``block`` rows near one pivot."""
    spark = rows.sparkSession
    total = rows.count()
    wanted = min(PIVOTS, -(-total // block))
    drawn = rows.select("vector", "dim", F.xxhash64("vector").alias("draw")).distinct().orderBy("draw").limit(wanted).collect()
    pivots: dict[int, list] = {}
    for r in drawn:
        direction = np.array(r["vector"], np.float64)
        pivots.setdefault(r["dim"], []).append(direction / max(np.linalg.norm(direction), 1.0))
    held = {dim: np.stack(of_dim) for dim, of_dim in pivots.items()}
    schema = rows.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    placed = rows.mapInArrow(_to_pivot(held), schema + ", pivot int")
    placed = stage_table(placed, "pivots")
    sizes = placed.groupBy("dim", "pivot").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / block))
    numbered = placed.join(broadcast_if_small(sizes.drop("n")), ["dim", "pivot"])
    # A pivot with many rows, copies perhaps, is dealt into as many blocks as it needs.
    part = F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts"))
    numbered = numbered.withColumn("block", F.xxhash64("dim", "pivot", part))
    return stage_table(numbered.drop("pivot", "parts").groupBy("dim", "block").applyInArrow(_pack, TREE_SCHEMA), "cover-trees")


def _searched(same_label: bool, k: int):
    names = ["anchor", "window", "vec_id", "score"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        dim = left.column("dim")[0].as_py()
        tree = {name: np.frombuffer(right.column(name)[0].as_py(), kind) for name, kind in PACKED}
        queries = _matrix(left.column("vector"), dim)
        low, high = ([list(x) for x in left.column(n).to_pylist()] for n in ("low", "high"))
        windows = max(map(len, low))
        pad = lambda rows, fill: np.array([r + [fill] * (windows - len(r)) for r in rows], np.int64)
        anchor, window, row, score = search(
            tree,
            tree["vectors"].reshape(len(tree["ids"]), dim),
            tree["ids"],
            tree["labels"],
            queries,
            left.column("vec_id").to_numpy(),
            left.column("label").to_numpy(),
            pad(low, NO_HIGH),
            pad(high, NO_LOW),
            same_label,
            k,
        )
        return pa.Table.from_arrays([pa.array(x) for x in (left.column("anchor").to_numpy()[anchor], window, tree["ids"][row], score)], schema=schema)

    return run


def _best(anchors: DataFrame, trees: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(anchor, window, rank, vec_id, score) over all blocks; ``anchors`` bring arrays of lows and highs."""
    groups = max(1, -(-anchors.count() // ANCHOR_GROUP))
    # The anchors are the stated set of queries: they go to every block, in groups, candidates stay in theirs.
    places = trees.select(F.col("dim").alias("dim"), F.col("block").alias("block"))
    left = anchors.withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(groups))).join(broadcast_if_small(places), "dim")
    right = trees.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    keys = ["dim", "block", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searched(same_label, k), "anchor long, window long, vec_id long, score long")
    place = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int, negatives: int, low_percent: int, high_percent: int = 100, block: int = BLOCK
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``usable_rows``.

    Of each anchor and each of its ``positives`` best rows of the same label: the ``negatives`` best rows
    of other labels whose score is ``low_percent`` to ``high_percent`` of the positive's.
    """
    held = stage_table(rows, "vectors")
    trees = cover_trees(held, block)
    distinct = held.filter(is_anchor).distinct()
    anchors = stage_table(distinct.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    whole = anchors.withColumns({"low": F.array(F.lit(NO_LOW)), "high": F.array(F.lit(NO_HIGH))})
    matched = stage_table(_best(whole, trees, True, positives), "positives")
    window = matched.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positive"))
    # Whole numbers: low is rounded up, high down.
    low = F.transform("positive", lambda p: _scaled(p["score"], low_percent, up=True))
    high = F.transform("positive", lambda p: _scaled(p["score"], high_percent, up=False))
    windows = anchors.join(window, "anchor").withColumns({"low": low, "high": high})
    found = _best(windows.drop("positive"), trees, False, negatives)
    named = anchors.join(window, "anchor").select("anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("positive").alias("window", "positive"))
    return found.join(named.withColumn("window", F.col("window").cast("long")), ["anchor", "window"]).select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def _scaled(score: Column, percent: int, up: bool) -> Column:
    """percent / 100 of a score in whole numbers, rounded up or down; exact for scores of 63 bits."""
    product = score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(5,0)")
    exact = (product / F.lit(100).cast("decimal(3,0)")).cast("decimal(30,2)")
    return (F.ceil(exact) if up else F.floor(exact)).cast("long")
