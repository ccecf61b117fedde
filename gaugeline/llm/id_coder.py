"""Adaptive context-mixing range coder for token ids, many independent blocks at a time.

Blocks are coded side by side, one id of each per step, as arrays.  A block starts with empty
models and ends with its own code words and checksum, so blocks can be decoded apart.  For each id
a block has three predictions: the id that last followed the two ids before it (order 2), the id
that last followed the one before (order 1), and the shares of id ranges so far (order 0).  Each
table entry carries a confidence, how often in a row it was right; adaptive chances, one pair for
each two confidences and for whether orders 1 and 2 agree, mix the predictions into one interval
table for the range coder.  All numbers are whole and below 2 ** 53, those of the range coder as
doubles, in which their products and floored quotients are exact, so encoder and decoder agree on
every machine.  A step costs the same few dozen array operations whatever the blocks, so it pays to
code some thousand blocks at once.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDS2"
HEADER = struct.Struct("<4sIIQ")
BLOCK_IDS = 2_048
MOST_ID_BITS = 20
ORDER1_SLOTS, ORDER2_SLOTS = 256, 512
#: Chances are out of 2 ** 15, shares of ranges in what is left to them out of 2 ** 14.
CHANCES, RANGE_SHARES = 1 << 15, 1 << 14
LEAST, MOST, RATE = 32, 31_000, 4
#: Chances at first, by confidence.
FIRST_CHANCES = (64, 4_000, 10_000, 20_000)
RANGE_STEP, REBUILD_EVERY, LEAST_RANGE_SHARE = 24, 128, 6
#: Earlier steps before which the shares of ranges are made anew.
REBUILD_EARLY = (16, 48)
#: A block's span lies between these two; code words have 16 bits.
LEAST_SPAN, ROOM, WORD = float(1 << 32), float(1 << 48), float(1 << 16)
FLUSH_WORDS = 3
#: Rows that are transposed at a time.
TURNED_ROWS = 64


def id_ranges() -> tuple[np.ndarray, np.ndarray]:
    """First ids and bits of the order-0 ranges: narrow for small ids, which are common."""
    starts, bits, at = [], [], 0
    for width, end in ((4, 1 << 9), (6, 1 << 10), (8, 1 << 12), (13, 1 << 16), (16, 1 << MOST_ID_BITS)):
        while at < end:
            starts.append(at)
            bits.append(width)
            at += 1 << width
    return np.array(starts, np.int32), np.array(bits, np.int32)


STARTS, BITS = id_ranges()
RANGES = len(STARTS)
#: By range; a hit of order 1 or 2 counts as one range more, of no bits.
HIT = np.uint8(RANGES)
RANGE_OF_ID = np.repeat(np.arange(RANGES, dtype=np.uint8), 1 << BITS)
FIRST_IDS = np.append(STARTS, np.int32(0))
PART_OF_RANGE = np.append(np.exp2(-BITS), 1.0)


def _first_chances() -> np.ndarray:
    """(order 2, order 1) for every confidence of order 1, of order 2, and agreement."""
    out = np.empty((2, 4, 4, 2), np.int16)
    for two, a in enumerate(FIRST_CHANCES):
        for one, b in enumerate(FIRST_CHANCES):
            out[0, two, one] = a, b * (MOST - a) // MOST
            out[1, two, one] = max(a, b), LEAST
    return out.reshape(-1, 2)


CONTEXTS = 32
#: What the chances go to after a miss, a hit of order 1 and one of order 2.
GOALS = np.array([(LEAST, LEAST), (LEAST, MOST), (MOST, LEAST)], np.int16)
SUREST = 3


class Models:
    """The models of all blocks; ``predict`` before each id, ``learn`` after.

    A span is divided into ranges, the id of order 1 and the id of order 2, in this order.
    """

    def __init__(self, blocks: int):
        self.blocks = blocks
        lane = np.arange(blocks)
        self.lane, self.lane1, self.lane2, self.lane_c = lane, lane * ORDER1_SLOTS, lane * ORDER2_SLOTS, lane * CONTEXTS
        self.t1 = np.zeros(blocks * ORDER1_SLOTS, np.int32)
        self.t2 = np.zeros(blocks * ORDER2_SLOTS, np.int32)
        # Two chances of 16 bits in each.
        self.chances = np.tile(_first_chances(), (blocks, 1)).view(np.int32).ravel()
        self.seen = np.full((RANGES, blocks), RANGE_STEP, np.int32)
        self.sums = np.zeros((RANGES + 2, blocks), np.int16)
        self.sums[RANGES:] = RANGE_SHARES
        self.places = np.full((REBUILD_EVERY, blocks), RANGES * blocks, np.int64)
        self.one = np.zeros(blocks, np.int64)
        self.two = np.zeros(blocks, np.int64)
        self.step = 0

    def _rebuild(self) -> None:
        if self.step:
            found = np.bincount(self.places.ravel(), minlength=RANGES * self.blocks)[: RANGES * self.blocks]
            self.seen += found.astype(np.int32).reshape(RANGES, -1) * np.int32(RANGE_STEP)
            self.places[:] = RANGES * self.blocks
        room = RANGE_SHARES - LEAST_RANGE_SHARE * RANGES
        shares = LEAST_RANGE_SHARE + self.seen * np.int32(room) // self.seen.sum(axis=0, dtype=np.int32)
        np.cumsum(shares[:-1], axis=0, out=self.sums[1:RANGES])

    def predict(self, n: int) -> None:
        if self.step % REBUILD_EVERY == 0 or self.step in REBUILD_EARLY:
            self._rebuild()
        one = self.one[:n]
        self.h1 = (one >> 5 & (ORDER1_SLOTS - 1)) + self.lane1[:n]
        self.h2 = (one + self.two[:n] >> 5 & (ORDER2_SLOTS - 1)) + self.lane2[:n]
        e1, e2 = self.t1.take(self.h1), self.t2.take(self.h2)
        self.c1, self.c2, self.s1, self.s2 = e1 >> 2, e2 >> 2, e1 & 3, e2 & 3
        context = (self.s2 << 2) + self.s1 + ((self.c1 == self.c2) * np.int32(16))
        self.at = self.lane_c[:n] + context
        self.pair = self.chances.take(self.at)
        self.f2 = (self.pair & 0x7FFF).astype(np.float64)
        self.f1 = (self.pair >> 16).astype(np.float64)

    def units(self, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What one of CHANCES and one of RANGE_SHARES are of a span."""
        unit = np.floor(span * (1 / CHANCES))
        return unit, np.floor(unit * (CHANCES - self.f1 - self.f2) * (1 / RANGE_SHARES))

    def interval(self, n: int, unit: np.ndarray, range_unit: np.ndarray, kind: np.ndarray, hit: np.ndarray, hit2: np.ndarray) -> tuple:
        """Start and size of a prediction that is right, or of a range."""
        flat, place = self.sums.ravel(), kind * self.blocks + self.lane[:n]
        self.places[self.step % REBUILD_EVERY, :n] = place
        start = flat.take(place)
        size = (flat[self.blocks :].take(place) - start) * range_unit
        second, of_one = hit2.astype(np.float64), self.f1 * unit
        size += of_one * (hit ^ hit2)
        size += self.f2 * unit * second
        return start * range_unit + of_one * second, size

    def learn(self, n: int, ids: np.ndarray, hit: np.ndarray, hit2: np.ndarray) -> None:
        self.step += 1
        wide, shown = ids.astype(np.int64), ids << 2
        self.t1[self.h1] = shown + np.minimum(self.s1 + 1, SUREST) * (self.c1 == ids)
        self.t2[self.h2] = shown + np.minimum(self.s2 + 1, SUREST) * hit2
        pair = self.pair.view(np.int16)
        goal = GOALS.view(np.int32).ravel().take(hit.view(np.uint8) + hit2.view(np.uint8)).view(np.int16)
        self.chances[self.at] = (pair + (goal - pair >> RATE)).view(np.int32)
        self.two[:n] = self.one[:n] + wide
        self.one[:n] = wide * 40_503


def _lanes(count: int, size: int) -> tuple[int, int]:
    """Blocks, and ids of the last one."""
    blocks = -(-count // size)
    return blocks, count - size * (blocks - 1) if blocks else 0


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transposed array, copied some rows at a time, which is what the CPU's cache holds."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for at in range(0, len(rows), TURNED_ROWS):
        out[:, at : at + TURNED_ROWS] = rows[at : at + TURNED_ROWS].T
    return out


def encode(ids: np.ndarray, size: int = BLOCK_IDS) -> bytes:
    """Header, words and checksum of each block, then the words."""
    if len(ids) and int(ids.max()) >> MOST_ID_BITS:
        raise ValueError(f"ids have at most {MOST_ID_BITS} bits")
    ids = np.ascontiguousarray(ids, "<u4")
    blocks, last = _lanes(len(ids), size)
    padded = np.zeros(blocks * size, np.int32)
    padded[: len(ids)] = ids
    by_block = padded.reshape(blocks, size)
    models = Models(blocks)
    low, span = np.zeros(blocks), np.full(blocks, ROOM)
    # Words of all blocks side by side, each with a carry above its 16 bits.
    words = np.zeros(((2 * size + FLUSH_WORDS + 1), blocks), np.int32)
    flat, at = words.ravel(), np.arange(blocks)
    for step in range(size if blocks > 1 else last):
        n = blocks if step < last else blocks - 1
        if not n:
            break
        if step % TURNED_ROWS == 0:
            by_step = np.ascontiguousarray(np.ascontiguousarray(by_block[:, step : step + TURNED_ROWS]).T)
        models.predict(n)
        now = by_step[step % TURNED_ROWS, :n]
        hit2 = models.c2 == now
        hit = (models.c1 == now) | hit2
        place = RANGE_OF_ID.take(now)
        kind = np.maximum(place, hit.view(np.uint8) * HIT).astype(np.int64)
        l, s, p = low[:n], span[:n], at[:n]  # noqa: E741
        start, share = models.interval(n, *models.units(s), kind, hit, hit2)
        l += start
        np.floor(share * PART_OF_RANGE.take(kind), out=s)
        l += s * ((now - FIRST_IDS.take(kind)) * ~hit)
        models.learn(n, now, hit, hit2)
        # Written anyway, and written again if the word was not complete.
        short = (s < LEAST_SPAN).astype(np.float64)
        top = np.floor(l * (1 / LEAST_SPAN))
        flat[p] = top.astype(np.int32)
        more = short * (WORD - 1) + 1
        top *= short
        l -= top * LEAST_SPAN
        l *= more
        s *= more
        p += short.astype(np.int64) * blocks
        again = np.flatnonzero(s < LEAST_SPAN)
        if len(again):
            top = np.floor(l[again] * (1 / LEAST_SPAN))
            flat[p[again]] = top.astype(np.int32)
            l[again] = (l[again] - top * LEAST_SPAN) * WORD
            s[again] *= WORD
            p[again] += blocks
    for _ in range(FLUSH_WORDS):
        top = np.floor(low * (1 / LEAST_SPAN))
        flat[at] = top.astype(np.int32)
        low = (low - top * LEAST_SPAN) * WORD
        at += blocks
    filled = at // max(blocks, 1)
    most = int(filled.max(initial=0))
    kept = np.arange(most)[None, :] < filled[:, None]
    # What lies below a block's end was written but not completed.
    words = words[:most] * _turned(kept)
    for row in range(most - 1, 0, -1):
        words[row - 1] += words[row] >> 16
    body = _turned(words.astype("<u2"))[kept]
    sums = np.array([zlib.crc32(ids[i * size : (i + 1) * size]) for i in range(blocks)], "<u4")
    return HEADER.pack(MAGIC, size, blocks, len(ids)) + filled.astype("<u4").tobytes() + sums.tobytes() + body.tobytes()


@np.errstate(over="ignore", invalid="ignore")  # in damaged blocks, which the checksums find
def decode(payload: bytes) -> np.ndarray:
    """The ids; raises ValueError if a block's checksum is wrong."""
    magic, size, blocks, count = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not an id file")
    filled = np.frombuffer(payload, "<u4", blocks, HEADER.size).astype(np.int64)
    sums = np.frombuffer(payload, "<u4", blocks, HEADER.size + 4 * blocks)
    # One word more than there are, for the look ahead of the last ids.
    words = np.append(np.frombuffer(payload, "<u2", -1, HEADER.size + 8 * blocks), np.uint16(0)).astype(np.uint16)
    at = np.cumsum(filled) - filled
    _, last = _lanes(count, size)
    by_step = np.zeros((size, blocks), np.uint32)
    models = Models(blocks)
    span, code = np.full(blocks, ROOM), np.zeros(blocks)
    for _ in range(FLUSH_WORDS):
        code = code * WORD + words[at]
        at += 1
    for step in range(size if blocks > 1 else last):
        n = blocks if step < last else blocks - 1
        if not n:
            break
        models.predict(n)
        s, c, p = span[:n], code[:n], at[:n]
        unit, range_unit = models.units(s)
        # The last range that starts at or below the code; a hit lies above all.
        most = np.minimum(c / range_unit, RANGE_SHARES).astype(np.int16)
        found = np.add.reduce((models.sums[1 : RANGES + 1, :n] <= most).view(np.uint8), axis=0, dtype=np.uint8)
        hit, kind = found == HIT, found.astype(np.int64)
        hit2 = c >= range_unit * RANGE_SHARES + models.f1 * unit
        start, share = models.interval(n, unit, range_unit, kind, hit, hit2)
        c -= start
        np.floor(share * PART_OF_RANGE.take(kind), out=s)
        offset = np.floor(c / s)
        c -= s * offset
        now = FIRST_IDS.take(kind) + offset.astype(np.int32)
        now += models.c1 * (hit ^ hit2)
        now += models.c2 * hit2
        by_step[step, :n] = now
        models.learn(n, now, hit, hit2)
        short = (s < LEAST_SPAN).astype(np.float64)
        more = short * (WORD - 1) + 1
        c *= more
        c += words.take(p, mode="clip") * short
        s *= more
        p += short.astype(np.int64)
        again = np.flatnonzero(s < LEAST_SPAN)
        if len(again):
            c[again] = c[again] * WORD + words.take(p[again], mode="clip")
            s[again] *= WORD
            p[again] += 1
    ids = _turned(by_step).ravel()[:count].astype("<u4", copy=False)
    for i in range(blocks):
        if zlib.crc32(ids[i * size : (i + 1) * size]) != sums[i]:
            raise ValueError(f"block {i} is damaged")
    return ids
