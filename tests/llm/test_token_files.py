from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeline.llm import id_coder, pieces, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("count", [0, 1, 2, 63, 64, 65, 1000, 5000])
@pytest.mark.parametrize("kind", ["random", "zipf", "constant", "periodic", "largest"])
def test_round_trip(count, kind):
    rng = np.random.default_rng(count)
    ids = {
        "random": rng.integers(0, 1 << 20, count),
        "zipf": np.minimum(rng.zipf(1.3, count), 49_407),
        "constant": np.full(count, 7),
        "periodic": np.arange(count) % 5 * 999,
        "largest": np.full(count, (1 << 20) - 1) - rng.integers(0, 2, count),
    }[kind].astype(np.uint32)
    payload = id_coder.encode(ids, 64)
    assert np.array_equal(id_coder.decode(payload), ids)


def test_blocks_are_reset_checked_and_smaller():
    rng = np.random.default_rng(3)
    phrases = [rng.zipf(1.2, rng.integers(2, 9)) % 49_408 for _ in range(300)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 300, 4000)]).astype(np.uint32)
    payload = id_coder.encode(ids, 1024)
    assert len(payload) < 0.35 * ids.nbytes
    # A block's words do not depend on the other blocks.
    alone = id_coder.encode(ids[1024:2048], 1024)
    assert alone[id_coder.HEADER.size + 8 :] in payload
    broken = bytearray(payload)
    broken[-100] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        id_coder.decode(bytes(broken))
    with pytest.raises(ValueError, match="20 bits"):
        id_coder.encode(np.array([1 << 20], np.uint32))


@pytest.mark.parametrize("part", [1 << 22, 200])
def test_documents(spark, monkeypatch, docs, by_id, no_docs, part):
    monkeypatch.setattr(token_files, "PART_IDS", part)
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    rows = {r.doc_id: r for r in token_files.round_trip(docs, PATH, 1).collect()}
    at = 0
    for i in sorted(by_id):
        ids = [*whole.encode(by_id[i], add_special_tokens=False).ids, 1]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        r = rows.pop(i)
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(packed), packed)
        at += len(ids)
    assert not rows
    assert token_files.round_trip(no_docs, PATH, 1).count() == 0


def test_missing_and_repeated_ids(spark):
    frame = spark.createDataFrame([(3, "a b"), (3, "a b"), (None, None), (1, "c")], "doc_id long, text string")
    rows = token_files.round_trip(frame, PATH, 1).collect()
    assert sorted((r.start, str(r.doc_id), r.n_tokens) for r in rows) == [(0, "None", 1), (1, "1", 2), (3, "3", 3), (6, "3", 3)]


def test_small_ids_cost_few_bits():
    """Ids over all orders of magnitude, as words and their parts have, in blocks of the usual length."""
    ids = np.exp(np.random.default_rng(8).uniform(0, np.log(49_408), 200_000)).astype(np.uint32)
    payload = id_coder.encode(ids)
    assert np.array_equal(id_coder.decode(payload), ids)
    assert 8 * len(payload) < 11.75 * len(ids)


def test_carries_run_through_written_words():
    """Long runs of sure predictions with rare misses leave words of ones, which a carry turns over."""
    rng = np.random.default_rng(4)
    for seed in range(20):
        ids = np.where(rng.random(30_000) < 0.001 * (seed + 1), rng.integers(0, 1 << 20, 30_000), seed % 3).astype(np.uint32)
        assert np.array_equal(id_coder.decode(id_coder.encode(ids, 1_000)), ids)


def test_damage_anywhere_is_found():
    ids = np.random.default_rng(2).zipf(1.3, 3_000).astype(np.uint32) % 49_408
    payload = id_coder.encode(ids, 500)
    for at in range(id_coder.HEADER.size + 8 * 6 + 1, len(payload) - 8, len(payload) // 40):
        broken = bytearray(payload)
        broken[at] ^= 0x55
        with pytest.raises(ValueError, match="damaged"):
            id_coder.decode(bytes(broken))


def test_new_words_reach_the_library_in_few_calls(monkeypatch):
    rng = np.random.default_rng(6)
    words = ["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(5_000)]
    texts = [" ".join(w + ".,'s?"[i % 5 :] for i, w in enumerate(words)), "Ünïİ " * 3 + words[0].upper(), "北京 " + words[1], "x" * 500]
    pieces.tokenizer_encoder.cache_clear()
    encoder = pieces.tokenizer_encoder(PATH, gaps=False)
    calls = []
    learn = encoder.together._learn
    monkeypatch.setattr(encoder.together, "_learn", lambda parts: calls.append(len(parts)) or learn(parts))
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode([t.encode() for t in texts[:1]])]
        found += [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode([t.encode() for t in texts[1:]])]
        assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(calls) >= 5_000 and len(calls) <= 8


@pytest.mark.parametrize("met", [1, 64])
def test_units_that_share_a_place_are_told_apart(monkeypatch, met):
    monkeypatch.setattr(pieces, "MET", met)
    pieces.tokenizer_encoder.cache_clear()
    encoder = pieces.tokenizer_encoder(PATH, gaps=False)
    whole = Tokenizer.from_file(PATH)
    texts = [" ".join(np.random.default_rng(i).permutation(["the", "of", "and", "to", "word", "words", "of,", "in"] * 9)) for i in range(20)]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode([t.encode() for t in texts])]
    assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    pieces.tokenizer_encoder.cache_clear()
