"""Suffix-array dedup: removes what an earlier document already holds, byte by byte.

A byte goes if a string of ``MATCH`` bytes around it also starts in a document with a smaller id.
Sorting every suffix of the corpus would move ``MATCH`` bytes for each byte, so the suffix array is
sparse.  Every window of MATCH bytes has an anchor, the leftmost least hash of the grams in it;
equal windows have equal anchors.  Neighbouring windows with one anchor form a run, and texts hold
one run for about sixteen bytes.

1. Documents are gathered into compressed buffers.  A buffer's distinct runs (hashes of the anchor
   and of the run) go to parts by anchor (one for each PART_BYTES of text; a task holds one part at
   a time), which answer for each run: nothing like it elsewhere; an earlier document has the whole
   run; or other runs of this anchor exist in other documents.
2. Only runs of the last kind, the edges of repeated passages, send their bytes.  Within an anchor
   the suffixes at all windows are sorted, ties by document.  As matches count from MATCH bytes on,
   suffixes are compared that far, each with the least document of its stretch of equal
   neighbours.  Arrays of longest previous factors are not built.
3. The matches go back to the buffers, which give each document its spans and what remains.

An anchor with many different runs (the edge of a passage in a large part of all documents) would
fill one task: its windows are sent apart, each to the task of its own hash.  A buffer sends equal
runs once, with its least document, so copies of any number cost a row per buffer.  Runs are matched
by 48-bit hashes of anchor and run together; edges are matched by their bytes.

A null text counts as empty.  Rows with equal ids are one place in the order and never remove each
other; null ids come after all others.  Texts under MATCH bytes keep everything; an empty table
gives an empty result; further columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import partitions_of, text_or_empty
from gaugeline.sources.workspace import stage_table

MATCH = 50
GRAM = 20
WINDOW_GRAMS = MATCH - GRAM + 1
BUFFER_BYTES = 1 << 20
BUFFER_DOCS = 60_000
#: Bytes whose grams and runs are found at a time; some thirty arrays of eight bytes for each are alive.
CHUNK_BYTES = 1 << 18
#: More different runs of an anchor than this in a buffer, or in all, are sent window by window.
LOCAL_RUNS, ALL_RUNS = 64, 2_000
#: Runs whose suffixes a task sorts together.
SORT_RUNS = 20_000
#: Text whose runs one part of step 1 holds; a task works through any number of parts.
PART_BYTES = 64 << 20
PLAIN, APART, MARK = 0, 1, 2
UNIQUE, COVERED, EDGE, EDGE_APART = 0, 1, 2, 3
NO_ID = np.iinfo(np.int64).max
ENTRY_BYTES = 21
U = np.uint64
_RNG = np.random.default_rng(50)
_GRAM_OF_BYTE, _RUN_OF_BYTE = (_RNG.integers(1, 1 << 64, 256, dtype=U) for _ in range(2))
_GRAM_FACTOR, _RUN_FACTOR = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_LOW48 = U((1 << 48) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(29))


def _power(factor: int, exponent: int) -> np.uint64:
    return U(pow(factor, exponent, 1 << 64))


def _powers(factor: int, count: int) -> np.ndarray:
    out = np.full(count, U(factor), U)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """The runs of a buffer: ``start`` of the first window, ``windows``, hashes, all in text order."""

    def __init__(self, body: np.ndarray, ends: np.ndarray):
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        parts = [self._chunk(body, starts, ends, at) for at in range(0, max(0, len(body) - MATCH + 1), CHUNK_BYTES)]
        empty = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U), np.empty(0, U))
        self.start, self.windows, self.anchor, self.run = (np.concatenate(p) for p in zip(empty, *parts, strict=True))
        self.doc = np.searchsorted(ends, self.start, "right")

    @staticmethod
    def _chunk(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
        part = body[at : at + CHUNK_BYTES + MATCH - 1]
        n = len(part) - MATCH + 1
        inside = np.zeros(n + 1, np.int32)
        long = ends - starts >= MATCH
        np.add.at(inside, np.clip(starts[long] - at, 0, n), 1)
        np.add.at(inside, np.clip(ends[long] - MATCH + 1 - at, 0, n), -1)
        valid = np.cumsum(inside[:-1]) > 0
        one = _GRAM_OF_BYTE[part]
        grams = {1: one}
        size = 1
        while size < 16:
            h = grams[size]
            grams[2 * size] = h[:-size] * _power(_GRAM_FACTOR, size) + h[size:]
            size *= 2
        gram = _mixed(grams[16][: len(part) - GRAM + 1] * _power(_GRAM_FACTOR, 4) + grams[4][16:])
        del grams, one
        # The leftmost least gram of each window, over stretches of doubling length.
        least, where = gram, np.arange(len(gram), dtype=np.int32)
        span = 1
        while span < WINDOW_GRAMS:
            step = min(span, WINDOW_GRAMS - span)
            left, right = least[:-step], least[step:]
            first = left <= right
            least, where = np.where(first, left, right), np.where(first, where[:-step], where[step:])
            span += step
        new = np.ones(n, bool)
        new[1:] = (where[1:] != where[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], n)
        use = valid[first]
        first, last = first[use].astype(np.int64), last[use].astype(np.int64)
        place = where[first].astype(np.int64)
        power = _powers(_RUN_FACTOR, len(part))
        total = np.concatenate([np.zeros(1, U), np.cumsum(_RUN_OF_BYTE[part] * power, dtype=U)])
        back = _powers(pow(_RUN_FACTOR, -1, 1 << 64), len(part))
        end = last + MATCH - 1
        run = (total[end] - total[first]) * back[first] + (place - first).astype(U) * U(0x9FB21C651E98DF25) + (last - first).astype(U)
        return first + at, last - first, gram[place], _mixed(run ^ _mixed(gram[place]))


class Entries:
    """The distinct runs of a buffer as they are sent, with the task of each."""

    def __init__(self, runs: Runs, order_of_doc: np.ndarray, parts: int):
        anchor, run = runs.anchor & _LOW48, runs.run & _LOW48
        order = order_of_doc[runs.doc]
        by = np.lexsort((order, run, anchor))
        a, r = anchor[by], run[by]
        first = np.ones(len(by), bool)
        first[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
        entry = np.cumsum(first) - 1
        self.of_run = np.empty(len(by), np.int64)
        self.of_run[by] = entry
        lead = by[first]  # the run of the least document
        self.repeats = order > order[lead][self.of_run]
        a, r = anchor[lead], run[lead]
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, np.int64)
        count = np.diff(np.append(starts, len(a)))
        many = np.repeat(count > LOCAL_RUNS, count)
        kind = np.where(many, APART, PLAIN).astype(np.uint8)
        marks = starts[count > LOCAL_RUNS]
        self.count = len(a)
        self.anchor = np.concatenate([a, a[marks]])
        self.run = np.concatenate([r, r[marks]])
        self.kind = np.concatenate([kind, np.full(len(marks), MARK, np.uint8)])
        self.order = np.concatenate([order[lead], order[lead][marks]])
        part = (np.where(self.kind == APART, self.run, self.anchor) % U(parts)).astype(np.int64)
        self.by_part = np.argsort(part, kind="stable")
        self.cuts = np.searchsorted(part[self.by_part], np.arange(parts + 1))

    def packed(self, part: int) -> bytes:
        at = self.by_part[self.cuts[part] : self.cuts[part + 1]]
        out = np.empty((len(at), ENTRY_BYTES), np.uint8)
        out[:, :6] = self.anchor[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        out[:, 6:12] = self.run[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        out[:, 12:20] = self.order[at].astype("<i8").view(np.uint8).reshape(-1, 8)
        out[:, 20] = self.kind[at]
        return out.tobytes()


def _unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    rows = np.frombuffer(blob, np.uint8).reshape(-1, ENTRY_BYTES)
    wide = np.zeros((2, len(rows), 8), np.uint8)
    wide[0, :, :6], wide[1, :, :6] = rows[:, :6], rows[:, 6:12]
    anchor, run = wide.view("<u8").reshape(2, -1)
    return anchor, run, np.ascontiguousarray(rows[:, 12:20]).view("<i8").ravel(), rows[:, 20]


def answers(anchor: np.ndarray, run: np.ndarray, order: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """What step 1 says to each entry of a task."""
    by = np.lexsort((order, run, anchor))
    a, r, o, k = anchor[by], run[by], order[by], kind[by]
    if not len(by):
        return np.empty(0, np.uint8)
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    real = k != MARK
    new_run = new_anchor | np.concatenate([[True], r[1:] != r[:-1]])
    group, same = np.cumsum(new_anchor) - 1, np.cumsum(new_run) - 1
    least = np.full(same[-1] + 1, NO_ID)
    np.minimum.at(least, same[real], o[real])
    at = np.flatnonzero(new_anchor)
    different = np.add.reduceat(new_run.astype(np.int64), at)
    docs = np.maximum.reduceat(o, at) > np.minimum.reduceat(o, at)
    marked = np.maximum.reduceat(np.where(k == MARK, 1, 0), at) > 0
    apart = (marked | (different > ALL_RUNS))[group] | (k == APART)
    shared = ((different > 1) & docs | marked)[group] | (k == APART)
    code = np.where(shared, np.where(apart, EDGE_APART, EDGE), UNIQUE)
    code = np.where(real & (o > least[same]), COVERED, code).astype(np.uint8)
    out = np.empty(len(by), np.uint8)
    out[by] = code
    return out


def repeated_windows(key: np.ndarray, order: np.ndarray, windows: np.ndarray, body: np.ndarray, body_at: np.ndarray) -> np.ndarray:
    """Step 2: for every window of the runs, one after another, whether an earlier document has it.

    A sparse suffix array: the places of all windows sorted by key, MATCH bytes and document.
    """
    run = np.repeat(np.arange(len(windows)), windows)
    within = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
    wide = np.zeros((len(run), -(-MATCH // 8) * 8), np.uint8)
    wide[:, :MATCH] = np.lib.stride_tricks.sliding_window_view(body, MATCH)[body_at[run] + within]
    words = wide.view(">u8").astype(U)
    by = np.lexsort((order[run], *words.T[::-1], key[run]))
    # Equal neighbours share MATCH bytes; the stretch starts with its least document.
    words, k, o = words[by], key[run][by], order[run][by]
    new = np.ones(len(by), bool)
    new[1:] = (k[1:] != k[:-1]) | (words[1:] != words[:-1]).any(axis=1)
    previous = o[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.empty(len(by), bool)
    out[by] = previous < o
    return out


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sorted rows (doc, start, end) with overlapping and touching spans joined."""
    if not len(doc):
        return np.empty((0, 3), np.int64)
    by = np.lexsort((end, start, doc))
    doc, start, end = doc[by], start[by], end[by]
    room = int(end.max()) + 1
    reach = np.maximum.accumulate(doc * room + end)
    new = np.concatenate([[True], doc[1:] * room + start[1:] > reach[:-1]])
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return np.stack([doc[at], start[at], reach[last] - doc[last] * room], axis=1)


def _compressed(body: bytes) -> bytes:
    return pa.compress(body, codec="zstd", asbytes=True)


def _buffers(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            ids = np.array([NO_ID if i is None else i for i, _ in held], np.int64)
            missing = np.array([i is None for i, _ in held], np.uint8)
            ends = np.cumsum([len(b) for _, b in held]).astype(np.int64)
            body = b"".join(b for _, b in held)
            values = [(task << 32) + number, ids.tobytes(), missing.tobytes(), ends.tobytes(), len(body), _compressed(body)]
            return pa.RecordBatch.from_pylist([dict(zip(BUFFER_SCHEMA.names, values, strict=True))], BUFFER_SCHEMA)

        for batch in batches:
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if held and (size + len(body) > BUFFER_BYTES or len(held) == BUFFER_DOCS):
                    yield flush()
                    number, held, size = number + 1, [], 0
                held.append((doc, body))
                size += len(body)
        if held:
            yield flush()

    schema = "buffer long, ids binary, missing binary, ends binary, size long, body binary"
    return docs.mapInArrow(run, schema)


BUFFER_SCHEMA = pa.schema(
    [
        ("buffer", pa.int64()),
        ("ids", pa.binary()),
        ("missing", pa.binary()),
        ("ends", pa.binary()),
        ("size", pa.int64()),
        ("body", pa.binary()),
    ]
)


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, missing = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["missing"], np.uint8)
    body = pa.decompress(row["body"], decompressed_size=row["size"], codec="zstd", asbytes=True) if row["size"] else b""
    return ids, missing, np.frombuffer(row["ends"], np.int64), np.frombuffer(body, np.uint8)


def _questions(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, _, ends, body = _opened(row)
                entries = Entries(Runs(body, ends), ids, parts)
                used = np.flatnonzero(np.diff(entries.cuts)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int32()),
                        pa.array([row["buffer"]] * len(used), pa.int64()),
                        pa.array([entries.packed(p) for p in used], pa.binary()),
                    ],
                    ["part", "buffer", "entries"],
                )

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part; one part at a time."""
    held: list[dict] = []

    def flush() -> pa.RecordBatch:
        opened = [_unpacked(r["entries"]) for r in held]
        code = answers(*(np.concatenate(x) for x in zip(*opened, strict=True)))
        ends = np.cumsum([len(o[0]) for o in opened])
        codes = [c.tobytes() for c in np.split(code, ends[:-1])]
        return pa.RecordBatch.from_arrays(
            [pa.array([r["buffer"] for r in held], pa.int64()), pa.array([r["part"] for r in held], pa.int32()), pa.array(codes, pa.binary())],
            ["buffer", "part", "codes"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["part"] != row["part"]:
                yield flush()
                held = []
            held.append(row)
    if held:
        yield flush()


FOUND_SCHEMA = pa.schema(
    [
        ("buffer", pa.int64()),
        ("key", pa.int64()),
        ("order", pa.int64()),
        ("doc", pa.int64()),
        ("start", pa.int64()),
        ("windows", pa.int64()),
        ("bytes", pa.binary()),
        ("spans", pa.binary()),
    ]
)


def _windows_apart(runs: Runs, chosen: np.ndarray, raw: bytes, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Single windows of the chosen runs: places and keys of those to send, places of those found here.

    Of equal windows in the buffer only those of the least document are sent.
    """
    size = runs.windows[chosen]
    place = np.repeat(runs.start[chosen], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    order = ids[np.searchsorted(ends, place, "right")].tolist()
    window = [raw[s : s + MATCH] for s in place.tolist()]
    least: dict[bytes, int] = {}
    for w, o in zip(window, order, strict=True):
        least[w] = min(o, least.get(w, o))
    sent = np.fromiter((least[w] == o for w, o in zip(window, order, strict=True)), bool, len(window))
    digests = [hashlib.blake2b(w, digest_size=8).digest() for w, s in zip(window, sent.tolist(), strict=True) if s]
    # Keys of windows and of anchors (48 bits) stay apart.
    key = np.frombuffer(b"".join(digests), np.int64) | np.int64(-(1 << 62))
    return place[sent], key, place[~sent]


def _edges(parts: int):
    """Spans that step 1 found whole, and the bytes of edges, for the buffers of a group."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        codes = dict(zip(right.column("part").to_pylist(), right.column("codes").to_pylist(), strict=True))
        for row in left.to_pylist():
            ids, _, ends, body = _opened(row)
            runs = Runs(body, ends)
            entries = Entries(runs, ids, parts)
            code = np.zeros(len(entries.anchor), np.uint8)
            for part, blob in codes.items():
                code[entries.by_part[entries.cuts[part] : entries.cuts[part + 1]]] = np.frombuffer(blob, np.uint8)
            of_run = np.where(entries.repeats, COVERED, code[: entries.count][entries.of_run])
            raw, doc_start = body.tobytes(), np.concatenate([[0], ends[:-1]])
            edge = np.flatnonzero(of_run == EDGE)
            single, key_apart, again = _windows_apart(runs, np.flatnonzero(of_run == EDGE_APART), raw, ids, ends)
            whole = np.flatnonzero(of_run == COVERED)
            start = np.concatenate([runs.start[whole], again])
            length = np.concatenate([runs.windows[whole], np.ones(len(again), np.int64)]) + MATCH - 1
            doc = np.searchsorted(ends, start, "right")
            spans = _spans(doc, start - doc_start[doc], start - doc_start[doc] + length)
            at = np.concatenate([runs.start[edge], single])
            windows = np.concatenate([runs.windows[edge], np.ones(len(single), np.int64)])
            key = np.concatenate([(runs.anchor[edge] & _LOW48).astype(np.int64), key_apart])
            doc = np.searchsorted(ends, at, "right")
            none = pa.nulls(len(at), pa.binary())
            columns = [
                pa.array(np.full(len(at), row["buffer"])),
                pa.array(key),
                pa.array(ids[doc]),
                pa.array(doc.astype(np.int64)),
                pa.array(at - doc_start[doc]),
                pa.array(windows),
                pa.array([raw[s : s + m + MATCH - 1] for s, m in zip(at.tolist(), windows.tolist(), strict=True)], pa.binary()),
                none,
            ]
            tables.append(pa.Table.from_arrays(columns, schema=FOUND_SCHEMA))
            if len(spans):
                tables.append(pa.Table.from_pylist([{"buffer": row["buffer"], "spans": spans.tobytes()}], FOUND_SCHEMA))
        return pa.concat_tables(tables) if tables else FOUND_SCHEMA.empty_table()

    return run


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 over rows sorted by key, some whole keys at a time."""
    held: list[pa.RecordBatch] = []

    def found(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        key, order, windows, buffer, doc, start = (
            rows.column(c).to_numpy() for c in ("key", "order", "windows", "buffer", "doc", "start")
        )
        blobs = rows.column("bytes").to_pylist()
        body_at = np.cumsum([0] + [len(b) for b in blobs[:-1]])
        repeated = repeated_windows(key, order, windows, np.frombuffer(b"".join(blobs), np.uint8), body_at)
        run = np.repeat(np.arange(len(windows)), windows)
        within = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
        run, within = run[repeated], within[repeated]
        out_buffer, out_spans = [], []
        by = np.argsort(buffer[run], kind="stable")
        run, within = run[by], within[by]
        cuts = np.flatnonzero(np.diff(buffer[run])) + 1
        for r, w in zip(np.split(run, cuts), np.split(within, cuts), strict=True):
            if len(r):
                out_buffer.append(buffer[r[0]])
                out_spans.append(_spans(doc[r], start[r] + w, start[r] + w + MATCH).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out_buffer, pa.int64()), pa.array(out_spans, pa.binary())], ["buffer", "spans"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= SORT_RUNS:
            rows = pa.Table.from_batches(held)
            keys = rows.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield found(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
    if held:
        yield found(pa.Table.from_batches(held))


def _remaining(keep_bytes: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"]
    types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.string()]
    schema = pa.schema(list(zip(names, types, strict=True))[: 7 if keep_bytes else 5])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.frombuffer(b, np.int64).reshape(-1, 3) for b in right.column("spans").to_pylist()]
        spans = _spans(*np.concatenate([np.empty((0, 3), np.int64), *found]).T)
        rows = []
        for row in left.to_pylist():
            ids, missing, ends, body = _opened(row)
            raw, start = body.tobytes(), 0
            cuts = np.searchsorted(spans[:, 0], np.arange(len(ids) + 1))
            for i, end in enumerate(ends.tolist()):
                own = spans[cuts[i] : cuts[i + 1], 1:].tolist()
                kept, at = [], start
                for low, high in own:
                    kept.append(raw[at : start + low])
                    at = start + high
                kept.append(raw[at:end])
                rest = b"".join(kept)
                values = [None if missing[i] else int(ids[i]), end - start, end - start - len(rest), len(own), hashlib.sha256(rest).hexdigest()]
                rows.append(values + ([rest, rest.decode("utf-8", "ignore")] if keep_bytes else []))
                start = end
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema) if rows else schema.empty_table()

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept, kept_text]) of every row.

    ``kept_text`` leaves out characters of which only some bytes were removed.
    Buffers and edges are staged as they are read more than once, answers so that the shuffle of the
    questions can go before the edges come.
    """
    tasks = partitions_of(docs.sparkSession)
    narrow = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_or_empty(f"`{text}`").cast("binary").alias("body")
    )
    buffers = stage_table(_buffers(narrow), "buffers")
    parts = max(tasks, -(-(buffers.agg(F.sum("size")).first()[0] or 0) // PART_BYTES))
    asked = buffers.mapInArrow(_questions(parts), "part int, buffer long, entries binary")
    told = asked.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_answered, "buffer long, part int, codes binary")
    told = stage_table(told, "answers")
    schema = "buffer long, key long, order long, doc long, start long, windows long, bytes binary, spans binary"
    found = buffers.groupBy("buffer").cogroup(told.groupBy("buffer")).applyInArrow(_edges(parts), schema)
    found = stage_table(found, "edges")
    edges = found.filter("bytes IS NOT NULL").drop("spans").repartition(tasks, "key").sortWithinPartitions("key")
    spans = found.filter("spans IS NOT NULL").select("buffer", "spans").union(edges.mapInArrow(_matched, "buffer long, spans binary"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, kept_text string" * keep_bytes
    return buffers.groupBy("buffer").cogroup(spans.groupBy("buffer")).applyInArrow(_remaining(keep_bytes), out)
