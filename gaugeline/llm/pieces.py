"""Whole texts to ids through units that the tokenizer treats separately, each encoded once.

A unit is a word with the white space before it, or the white space at the end of a text; a worker
keeps the ids of the units it has met.  Words are found and told apart as arrays, by 64-bit hashes, so
a repeated word costs no Python object.  Only units between which the tokenizer never joins anything are
used; a text with unusual white space is one unit.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import public_tokenizers
import regex
import xxhash

from gaugeline.llm import word_arrays

#: Units and ids that a worker remembers; beyond either all are forgotten.
REMEMBERED, IDS_REMEMBERED = 1_500_000, 1 << 23
#: Places for units met before, looked up without sorting; a power of two.
MET = 1 << 19
#: Longer parts of a unit are not remembered.
LONGEST_REMEMBERED = 64
#: White space other than blank, tab and line ends: such texts are not cut.
UNUSUAL = re.compile(r"[^\S \t\n\r]|[\u180e\u200b\ufeff]")
#: Bytes without which no text holds any of these.
SUSPECT = re.compile(rb"[\x0b\x0c\x1c-\x1f\xc2\xe1\xe2\xe3\xef]")
#: Pre-tokens that go to the library in one call.
PARTS_TOGETHER = 1_000
#: Bytes of text that are cut and looked up together.
SLICE_BYTES = 2 << 20
#: Below this character all Unicode versions agree on letters and numbers (fixed value).
STABLE_BELOW = "\u0250"
#: What no line of common letters holds: other letters, and white space.
UNCOMMON = re.compile(f"[^\0-{chr(ord(STABLE_BELOW) - 1)}]|[^\\S\n]")
#: Bytes without which no line holds any of these.
UNSURE = word_arrays.byte_set("".join(map(chr, [*range(10), *range(11, 33), 0xC2, *range(0xC9, 256)])))
_BREAK = word_arrays.byte_set(" \t\n\r")
BLANK = ord(" ")
TAIL = np.array([0x7FB5D329728EA185], np.uint64)


class IdStore:
    """Runs of ids, numbered as they come."""

    def __init__(self):
        self.count = self.filled = 0
        self.begin, self.size = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)
        self.ids = np.zeros(1 << 14, "<u4")

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        first, count = self.count, len(sizes)
        while first + count > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        while self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.size[first : first + count] = sizes
        self.begin[first : first + count] = self.filled + np.cumsum(sizes) - sizes
        self.filled += len(ids)
        self.count += count
        return np.arange(first, self.count)

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs, one after another, and where each run ends."""
        sizes = self.size[numbers].astype(np.int64)
        ends = np.cumsum(sizes)
        places = np.repeat(self.begin[numbers] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.ids[places], ends


class PieceEncoder:
    """``encode`` gives each text's ids as little-endian 32-bit integers.

    With ``gaps`` the white space before a word belongs to its unit, as in vocabularies that take a
    blank into the word; without, the tokenizer drops white space.  ``fold``: A-Z count as a-z.
    """

    def __init__(self, gaps: bool, fold: bool, encode_pieces: Callable[[list[str]], list[bytes]], together: _Together | None = None):
        self.gaps, self.fold, self.encode_pieces, self.together = gaps, fold, encode_pieces, together
        self.forget()

    def forget(self) -> None:
        # Keys in their order, which take a tenth of a dictionary's memory, and the number of each.
        self.keys, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        # The last unit met of each hash; no key belongs in the place of its complement.
        self.met_key, self.met_number = ~np.arange(MET, dtype=np.uint64), np.zeros(MET, np.int32)
        self.store = IdStore()

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= SLICE_BYTES):
                size += len(texts[stop])
                stop += 1
            yield from self._encode_slice(texts[at:stop])
            at = stop

    def _units(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All texts in one, begin, end and key of every unit, and the units of each text."""
        data, places = word_arrays.joined(texts)
        starts, ends, keys = word_arrays.words(data, _BREAK, self.fold)
        of = np.searchsorted(places, starts, "right") - 1
        words = np.bincount(of, minlength=len(texts))
        if not self.gaps:
            return data, starts, ends, keys, words
        begins = np.empty_like(starts)
        begins[1:] = ends[:-1]
        first = np.flatnonzero(np.diff(of, prepend=-1) > 0)
        begins[first] = places[of[first]]
        gap = starts - begins
        mark = np.zeros(len(starts), np.uint64)
        blank = np.zeros(len(starts), bool)
        one = np.flatnonzero(gap == 1)
        blank[one] = np.frombuffer(data, np.uint8)[begins[one]] == BLANK
        mark[blank] = 1
        for i in np.flatnonzero((gap > 0) & ~blank).tolist():
            mark[i] = xxhash.xxh64_intdigest(data[begins[i] : starts[i]]) | 2
        keys = word_arrays.join_hash(keys, mark)
        # White space at the end of a text is a unit of its own.
        stops = places + np.fromiter(map(len, texts), np.int64, len(texts))
        tails = places.copy()
        some = np.flatnonzero(words)
        tails[some] = ends[np.cumsum(words)[some] - 1]
        tailed = np.flatnonzero(stops > tails)
        more = np.array([xxhash.xxh64_intdigest(data[tails[i] : stops[i]]) for i in tailed.tolist()], np.uint64)
        at = np.cumsum(words)[tailed]
        begins, ends = np.insert(begins, at, tails[tailed]), np.insert(ends, at, stops[tailed])
        keys = np.insert(keys, at, word_arrays.join_hash(TAIL, more))
        words[tailed] += 1
        return data, begins, ends, keys, words

    def _learn(self, data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of new units, whose ids are kept."""
        pieces = [data[b:e] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
        if self.together and self.together.takes(lines := b"\n".join(pieces), len(pieces)):
            return self.store.add(*self.together.encode(lines.decode("utf-8")))
        found = self.encode_pieces([p.decode("utf-8") for p in pieces])
        sizes = np.fromiter((len(f) // 4 for f in found), np.int64, len(found))
        return self.store.add(np.frombuffer(b"".join(found), "<u4"), sizes)

    def _numbers(self, keys: np.ndarray, data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        distinct, first, local = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = np.flatnonzero(place < len(self.keys))
        known[inside] = self.keys[place[inside]] == distinct[inside]
        numbers = np.empty(len(distinct), np.int32)
        numbers[known] = self.number[place[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            at = first[fresh]
            numbers[fresh] = self._learn(data, begins[at], ends[at])
            old = np.ones(len(self.keys) + len(fresh), bool)
            old[place[fresh] + np.arange(len(fresh))] = False
            self.keys, self.number = _merged(old, self.keys, distinct[fresh]), _merged(old, self.number, numbers[fresh])
        return numbers[local]

    def _encode_slice(self, texts: list[bytes]) -> list[bytes]:
        odd = {i: text for i, t in enumerate(texts) if SUSPECT.search(t) and UNUSUAL.search(text := t.decode("utf-8"))}
        data, begins, ends, keys, units = self._units([b"" if i in odd else t for i, t in enumerate(texts)] if odd else texts)
        slot = (keys & np.uint64(MET - 1)).astype(np.int64)
        numbers = self.met_number[slot]
        unmet = np.flatnonzero(self.met_key[slot] != keys)
        if len(unmet):
            slot, key = slot[unmet], keys[unmet]
            numbers[unmet] = number = self._numbers(key, data, begins[unmet], ends[unmet])
            # Of units with one hash, the last number must go with the last key.
            self.met_key[slot] = key
            same = self.met_key[slot] == key
            self.met_number[slot[same]] = number[same]
        found, stops = self.store.joined(numbers)
        ids = found.tobytes()
        cuts = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(units)])] * 4
        out = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        if odd:
            for i, whole in zip(odd, self.encode_pieces(list(odd.values())), strict=True):
                out[i] = whole
        if self.store.count > REMEMBERED or self.store.filled > IDS_REMEMBERED:
            self.forget()
        return out


class _Together:
    """Units of common letters, each in a line of its own: one call of the library for many new pre-tokens.

    For vocabularies that mark the last token of a pre-token, so that the ids show where each one ends.
    """

    def __init__(self, tokenizer, pattern: regex.Pattern, fold: Callable[[str], str], letters: Callable[[str], list]):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.fold, self.split = fold, regex.compile(f"{pattern.pattern}|\n").findall
        self.bare = Tokenizer(tokenizer.model)
        self.bare.pre_tokenizer = CharDelimiterSplit("\n")
        suffix, vocabulary = tokenizer.model.end_of_word_suffix, tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.letters = _byte_letters(letters)
        self.forget()

    @staticmethod
    def of(tokenizer, pattern: regex.Pattern, letters: Callable[[str], list]) -> _Together | None:
        """None unless ends of pre-tokens show, white space is dropped, and letters are at most lower-cased."""
        usual = "".join(c for c in map(chr, range(ord(STABLE_BELOW))) if not c.isspace())
        shown = tokenizer.normalizer.normalize_str(usual) if tokenizer.normalizer else usual
        fold = next((f for f in (str.lower, str) if f(usual) == shown), None)
        if fold is None or not getattr(tokenizer.model, "end_of_word_suffix", None) or pattern.findall("a\nb") != ["a", "b"]:
            return None
        return _Together(tokenizer, pattern, fold, letters)

    @staticmethod
    def takes(lines: bytes, count: int) -> bool:
        if lines.count(b"\n") != count - 1:
            return False
        return not UNSURE[np.frombuffer(lines, np.uint8)].any() or not UNCOMMON.search(lines.decode("utf-8"))

    def forget(self) -> None:
        self.store = IdStore()
        # The end of a line, which stands between pieces, has no ids.
        self.number = {"\n": int(self.store.add(np.zeros(0, "<u4"), np.zeros(1, np.int64))[0])}

    def encode(self, lines: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all lines, one after another, and how many each has."""
        if self.store.count > REMEMBERED // 10 or self.store.filled > IDS_REMEMBERED // 6:
            self.forget()
        parts = self.split(self.fold(lines))
        fresh = list(dict.fromkeys(parts).keys() - self.number.keys())
        for at in range(0, len(fresh), PARTS_TOGETHER):
            self._learn(fresh[at : at + PARTS_TOGETHER])
        numbers = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        ids, ends = self.store.joined(numbers)
        for part in [p for p in fresh if len(p) > LONGEST_REMEMBERED]:
            del self.number[part]
        return ids, np.diff(ends[numbers == 0], prepend=0, append=len(ids))

    def _learn(self, parts: list[str]) -> None:
        shown, _ = codecs.charmap_decode("\n".join(parts).encode("utf-8"), "strict", self.letters)
        ids = np.array(self.bare.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(parts):  # letters that the vocabulary lacks may leave no mark
            alone = [e.ids for e in self.bare.encode_batch_fast(shown.split("\n"), add_special_tokens=False)]
            ids, ends = np.array(sum(alone, []), "<u4"), np.cumsum([len(a) for a in alone])
        self.number.update(zip(parts, self.store.add(ids, np.diff(ends, prepend=0)).tolist(), strict=True))


def _byte_letters(letters: Callable[[str], list]) -> str:
    """The letter that stands for each byte of UTF-8, as ``letters`` shows them; the end of a line stays."""
    table = ["\ufffe"] * 256
    for part in (range(0x80), range(0x80, 0x800), range(0x800, 0xD800, 0x40), range(0xE000, 0x110000, 0x1000)):
        for character in map(chr, part):
            for byte, letter in zip(character.encode("utf-8"), letters(character)[0][0], strict=True):
                table[byte] = letter
    table[ord("\n")] = "\n"
    return "".join(table)


def _merged(first: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Values of ``one`` where ``first`` is true, and of ``other`` elsewhere."""
    out = np.empty(len(first), one.dtype)
    out[first], out[~first] = one, other
    return out


@cache
def tokenizer_encoder(path: str, gaps: bool) -> PieceEncoder:
    """Encodes with the tokenizers library; texts that look like special tokens are ordinary text.

    One per worker process.  Pieces of common letters go straight to the library's model, each
    pre-token by itself; all others take the library's whole way.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    split = _pre_token_pattern(path).findall
    normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
    letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    byte_letters = {b: letters(chr(b))[0][0] for b in range(128)}
    to_ids, pack = tokenizer.model.tokenize, struct.pack
    parts: dict[str, bytes] = {}

    def pre_token_ids(part: str) -> bytes:
        shown = part.translate(byte_letters) if part.isascii() else letters(part)[0][0]
        found = [t.id for t in to_ids(shown)]
        return pack(f"<{len(found)}I", *found)

    def piece_ids(piece: str) -> bytes:
        split_piece = split(normalize(piece))
        if len(split_piece) == 1:
            return pre_token_ids(split_piece[0])
        out = []
        for part in split_piece:
            ids = parts.get(part)
            if ids is None:
                ids = pre_token_ids(part)
                if len(part) <= LONGEST_REMEMBERED:
                    parts[part] = ids
            out.append(ids)
        return b"".join(out)

    def encode_pieces(pieces: list[str]) -> list[bytes]:
        if len(parts) > REMEMBERED // 10:
            parts.clear()
        common = [bool(p) and max(p) < STABLE_BELOW for p in pieces]
        rest = [p for p, c in zip(pieces, common, strict=True) if not c]
        others = iter(tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return [piece_ids(p) if c else pack(f"<{len(e := next(others).ids)}I", *e) for p, c in zip(pieces, common, strict=True)]

    together = _Together.of(tokenizer, _pre_token_pattern(path), letters)
    return PieceEncoder(gaps, normalize("A") == "a", encode_pieces, together)


def _pre_token_pattern(path: str) -> regex.Pattern:
    """The pattern by which the tokenizer of this file splits, read from the file."""
    with open(path, encoding="utf-8") as file:
        rule = json.load(file)["pre_tokenizer"]
    steps = rule.get("pretokenizers", [rule])
    own = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"]
    return regex.compile(own[0] if own else public_tokenizers.PATTERN)
