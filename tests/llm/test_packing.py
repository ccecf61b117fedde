from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeline.llm import packing, pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 64


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def test_pieces_and_packing(docs, by_id, tokenizer, no_docs):
    rows = packing.pack_documents(docs, PATH, 2, CAPACITY).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(by_id)
    for doc, parts in by_doc.items():
        ids = [*tokenizer.encode(by_id[doc], add_special_tokens=False).ids, 2]
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert sum(r.length for r in parts) == len(ids) and all(r.length == CAPACITY for r in parts[1:])
        at = 0
        for r in parts:
            part = ids[at : at + r.length]
            assert (r.start, r.ids_crc32) == (at, zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
            at += r.length
    total = 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY
        total += at
    assert len(by_sequence) <= -(-total // CAPACITY) + 2
    assert packing.pack_documents(no_docs, PATH, 2, CAPACITY).count() == 0


def test_sequences_hold_the_ids(docs):
    packed = packing.pack(packing.token_pieces(docs, PATH, 2, CAPACITY, keep_ids=True), CAPACITY)
    for r in packing.sequences(packed).collect():
        assert len(r.ids) == 4 * r.length <= 4 * CAPACITY


def test_sweep_places_every_rank_once():
    rng = random.Random(3)
    counts = {length: rng.randint(1, 50) for length in rng.sample(range(1, 129), 60)}
    plan = packing.sweep(counts, 128)
    ranks = Counter((length, r) for length, low, high, _, _ in plan for r in range(low, high))
    assert ranks == Counter((length, r) for length, n in counts.items() for r in range(n))
    filled = defaultdict(int)
    for length, low, high, first, offset in plan:
        for i in range(high - low):
            assert filled[first + i] == offset
            filled[first + i] += length
    assert max(filled.values()) <= 128
    gaps = []  # one piece at a time, longest first
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else 128) - length)
    assert len(filled) == len(gaps)


@pytest.mark.parametrize("remembered", [900_000, 40])
@pytest.mark.parametrize(("file", "gaps"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(texts, monkeypatch, file, gaps, remembered):
    monkeypatch.setattr(pieces, "REMEMBERED", remembered)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 2 << 20 if remembered > 40 else 300)
    path = public_tokenizers.path(file)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    rng = random.Random(1)
    odd = [chr(c) for c in (9, 10, 11, 12, 13, 28, 31, 32, 32, 32, 133, 160, 0x180E, 0x200B, 0x2028, 0x3000, 0x301, 0x3A3, 0xFEFF)]
    some = ["".join(rng.choices([*odd, "a", "É", "'s", "'", "9", "Σ", "ß", "!", "中"], k=rng.randint(1, 25))) for _ in range(4000)]
    cases = [t or "" for t in texts] + some
    expected = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in whole.encode_batch(cases, add_special_tokens=False)]
    encoder = pieces.tokenizer_encoder(path, gaps)
    raw = [c.encode() for c in cases]
    assert list(encoder.encode(raw)) == expected
    assert [next(encoder.encode([c])) for c in raw] == expected
    assert list(encoder.encode([])) == [] and list(encoder.encode([b"", b""])) == [b"", b""]


def test_remembered_words_take_little_memory():
    """Workers that wait keep their words: 300,000 of them in less than half a dictionary's memory."""
    import tracemalloc

    encoder = pieces.PieceEncoder(True, False, lambda found: [b"\1\0\0\0"] * len(found))
    texts = [" ".join(f"w{i}" for i in range(at, at + 30_000)).encode() for at in range(0, 300_000, 30_000)]
    tracemalloc.start()
    try:
        for text in texts:
            (ids,) = encoder.encode([text])
            assert len(ids) == 4 * 30_000
        del ids
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert held < 30e6
