"""Words of many texts as arrays: places and 64-bit hashes, without a Python object per word.

A word's hash is a polynomial in its bytes (folded: A-Z count as a-z), taken from running sums over the
text and then mixed.  Two different words share a hash with a probability of about 2^-64.  Words
longer than ``LONG_WORD`` bytes, where such polynomials have known weak spots, get XXH64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
import xxhash

#: Bytes hashed at once; a slice ends between words and grows only for a longer word.
SLICE = 1 << 18
LONG_WORD = 512
#: Multiplier of the polynomial, odd so that it has an inverse, and the seed of the byte values.
BASE, BYTE_SEED = 0x9E3779B97F4A7C15, 20_240_611
MASK = (1 << 64) - 1
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(BYTE_SEED).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return values


_VALUES = _byte_values()
_FOLDED_VALUES = _VALUES[np.frombuffer(_FOLD, np.uint8)]
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_hash(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Hash of a sequence that goes on with ``then``."""
    return mix(first * np.uint64(0xD6E8FEB86659FD93) + then)


def _power(name: str, base: int, size: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < size:
        held = np.full(max(size, SLICE * 2), base & MASK, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if size <= SLICE * 2:
            _powers[name] = held
    return held[:size]


def byte_set(text: str) -> np.ndarray:
    """A yes or no for each of the 256 bytes."""
    table = np.zeros(256, bool)
    table[list(text.encode("latin-1"))] = True
    return table


def words(data: bytes, breaks: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of all words: maximal runs of bytes that are not in ``breaks``."""
    values = _FOLDED_VALUES if fold else _VALUES
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    np.logical_not(breaks[raw], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, first + SLICE, "right")))
        part = slice(at, upto)
        piece = raw[first : int(ends[upto - 1])]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * _power("up", BASE, len(piece)), out=sums[1:])
        begin, end = starts[part] - first, ends[part] - first
        own = (sums[end] - sums[begin]) * _power("down", pow(BASE, -1, 1 << 64), len(piece))[begin]
        hashes[part] = mix(own + (end - begin).astype(np.uint64))
        at = upto
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        word = data[starts[i] : ends[i]]
        hashes[i] = xxhash.xxh64_intdigest(word.translate(_FOLD) if fold else word)
    return starts, ends, hashes


def lower(data: bytes) -> bytes:
    """A-Z in lower case, everything else as it is."""
    return data.translate(_FOLD)


def buffers(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.Table]:
    """The rows of a task in tables of about ``most_bytes`` of text, each row in one of them.

    A longer text gets a table of its own with whatever came before it.
    """
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = 0
        filled = np.cumsum(sizes, dtype=np.int64)
        while at < batch.num_rows:
            before = int(filled[at - 1]) if at else 0
            stop = min(batch.num_rows, int(np.searchsorted(filled, before + most_bytes - total, "left")) + 1)
            held.append(batch.slice(at, stop - at))
            total += int(filled[stop - 1]) - before
            at = stop
            if total >= most_bytes:
                yield pa.Table.from_batches(held)
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def joined(texts: list[bytes | None], between: bytes = b"\n") -> tuple[bytes, np.ndarray]:
    """All texts in one, each followed by ``between``, and the places where they begin; null is empty."""
    own = [t or b"" for t in texts]
    sizes = np.fromiter((len(t) + len(between) for t in own), np.int64, len(own))
    return between.join([*own, b""]), np.cumsum(sizes) - sizes
