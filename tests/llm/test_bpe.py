from __future__ import annotations

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from gaugeline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_documents_match_the_library(docs, by_id, library, no_docs):
    encoded = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN)
    rows = encoded.collect()
    assert len(rows) == len(by_id)
    for r in rows:
        ids = library.encode_ordinary(by_id[r.doc_id])
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert (r.ids, r.n_tokens) == (packed, len(ids))
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(by_id[r.doc_id].encode()).hexdigest()
    texts = bpe.decode_documents(encoded, PATH, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: r.text for r in texts} == by_id
    assert bpe.encode_documents(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_long_pre_tokens_and_odd_characters(library):
    own, encoder = bpe.byte_encoder(PATH, public_tokenizers.PATTERN)
    rng = random.Random(2)
    odd = [chr(c) for c in (9, 10, 11, 13, 28, 31, 32, 32, 133, 160, 0x180E, 0x2028, 0x3000, 0x301, 0xFEFF)]
    cases = ["".join(rng.choices([*odd, "a", "é", "'s", "'ll", "9", "Σ", "!", "中", "😀"], k=rng.randint(1, 30))) for _ in range(3000)]
    cases += ["".join(rng.choices("abcdet", k=20_000)), "a" * 20_001, "=" * 5_000, " " * 3_000 + "x", "été" * 3_000]
    assert list(encoder.encode([c.encode() for c in cases])) == [struct.pack(f"<{len(i)}I", *i) for i in map(library.encode_ordinary, cases)]


def test_queue_gives_the_lowest_rank_then_the_leftmost_position():
    rng = random.Random(8)
    queue, entries = bpe.RankQueue(300_000), []
    for _ in range(3000):
        if rng.random() < 0.6:
            entry = (rng.choice([rng.randrange(300_000), rng.randrange(5)]), rng.randrange(1000))
            entries.append(entry)
            queue.push(*entry)
        elif entries:
            entries.remove(best := min(entries))
            assert queue.pop() == best
    for best in sorted(entries):
        assert queue.pop() == best
    assert queue.pop() is None


def test_small_vocabulary_where_order_matters():
    """Ranks in which a later merge makes a pair of a lower rank."""
    tokens = [bytes([b]) for b in b"abc"]
    ranks = {t: i + 10 for i, t in enumerate(tokens)} | {b"ab": 5, b"abc": 2, b"bc": 3, b"ca": 4, b"cab": 1}
    own = bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding(
        "small",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks | {bytes([b]): 100 + b for b in range(256) if bytes([b]) not in ranks},
        special_tokens={},
    )
    rng = random.Random(0)
    for _ in range(500):
        text = "".join(rng.choices("abc", k=rng.randint(1, 30)))
        assert own.merge(text.encode()) == library.encode_ordinary(text), text


def test_a_byte_without_a_token_is_an_error():
    small = bpe.ByteBpe({b"a": 0, b"b": 1, b"ab": 2}, r"\S+|\s+")
    assert small.merge(b"aab") == [0, 2]
    with pytest.raises(ValueError, match="lacks a byte"):
        small.merge(b"abc")
