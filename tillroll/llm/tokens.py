"""Token ids of whole texts with the `tokenizers` library, each distinct unit of text encoded once per worker.

The tokenizer file used here never forms a token across white space, nor between an ASCII letter and ASCII punctuation
other than the apostrophe: its pre-tokenizer cuts there, and its normaliser (NFC, white space to a space, lower case)
does not reach across. A text's ids are thus those of its units in order. Units are found and hashed with numpy, known
ones are looked up in a bounded hash table of ids, and the library encodes the others. Two independent 64-bit values
identify a unit.

Texts of a tokenizer file that normalises or cuts in another way are encoded whole, row by row.

Defined results: a null or empty text has no ids; repeated texts have equal ids."""

from __future__ import annotations

import array
import json
import os
import re
import threading
from collections.abc import Iterator

import numpy as np

from . import common as C

#: Slots of a worker's table of known units (a power of two); it is emptied when half of them are taken.
CACHE_SLOTS = 1 << 21
#: Bytes of text encoded at a time; longer texts are cut at spaces.
PASS_BYTES = 1 << 18

#: The pre-tokens of lower-cased Latin-1 text, as the tokenizer file splits it (fixed value of its format).
LATIN_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t\n\x0b\x0c\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")

#: How a tokenizer file must normalise and cut texts to be encoded by units (fixed values of its format).
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed",
     "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

_LOADED: dict[str, "TokenEncoder"] = {}
_LOCK = threading.Lock()

#: Classes of bytes: 0 space or line feed, 1 ASCII letter, 2 ASCII punctuation but the apostrophe, 3 any other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[0x20, 0x0A]] = 0
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1
for _low, _high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _CLASS[_low:_high] = 2
_CLASS[0x27] = 3
#: Whether a unit begins where class b follows class a, at 4 * a + b.
_BEGINS = np.zeros(16, bool)
_BEGINS[[1, 2, 3, 4 * 1 + 2, 4 * 2 + 1]] = True


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, every other byte for the next letter from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cuts_by_units(path: str) -> bool:
    """Whether a tokenizer file cuts texts as described above, and its added tokens begin with "<|" and stand alone."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    return (file.get("normalizer") == NORMALIZER and file.get("pre_tokenizer") == PRE_TOKENIZER
            and not file.get("truncation") and not file["model"].get("dropout") and all(
                t["content"].startswith("<|") and not re.search(r"\s", t["content"])
                and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"])
                for t in file.get("added_tokens") or []))


class TokenEncoder:
    """Encodes texts to ids equal to Tokenizer.encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, slots: int = CACHE_SLOTS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_units = cuts_by_units(path)
        self.letters = byte_letters()
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.slots = slots
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(self.slots, np.uint64)
        self.sums = np.zeros(self.slots, np.uint64)
        self.unit = np.full(self.slots, -1, np.int32)
        self.count = 0
        self.first = np.zeros(1, np.int64)  # where each unit's ids begin in `ids`, and the end of the last
        self.ids = np.zeros(0, np.uint32)

    def _unit_ids(self, unit: str) -> list[int]:
        if any(s in unit for s in self.special):
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        if unit.isascii() and unit.isalpha():
            return [t.id for t in self.model.tokenize(unit.lower())]
        try:
            unit.encode("latin-1")
        except UnicodeEncodeError:
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        ids: list[int] = []
        for piece in LATIN_PIECES.findall(unit.lower()):
            ids += [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))]
        return ids

    def _find(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The number of each unit, -1 for unknown ones (linear probing)."""
        found = np.full(len(h), -1, np.int32)
        at = (h >> self.shift).astype(np.int64)
        rest = np.arange(len(h))
        while len(rest):
            unit = self.unit[at]
            same = (self.keys[at] == h[rest]) & (self.sums[at] == c[rest]) & (unit >= 0)
            found[rest[same]] = unit[same]
            on = ~same & (unit >= 0)
            rest, at = rest[on], (at[on] + 1) & (self.slots - 1)
        return found

    def _learn(self, h: np.ndarray, c: np.ndarray, texts: list[str]) -> None:
        flat, lengths = array.array("I"), np.empty(len(texts), np.int64)
        for i, t in enumerate(texts):
            ids = self._unit_ids(t)
            lengths[i] = len(ids)
            flat.extend(ids)
        number = np.arange(self.count, self.count + len(texts), dtype=np.int32)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, np.array(flat, np.uint32)])
        self.count += len(texts)
        at, rest = (h >> self.shift).astype(np.int64), np.arange(len(h))
        while len(rest):  # of several units that want one free slot the last gets it, the others go on
            free = self.unit[at] < 0
            self.unit[at[free]] = number[rest[free]]
            won = free & (self.unit[at] == number[rest])
            self.keys[at[won]], self.sums[at[won]] = h[rest[won]], c[rest[won]]
            rest, at = rest[~won], (at[~won] + 1) & (self.slots - 1)

    def _encode_pass(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _CLASS[body]
        if body.tobytes().find(b"<|") >= 0:  # special tokens may be spelled here: cut at white space only, keep case
            kind[kind == 2] = 3
        else:
            upper = (body >= 0x41) & (body <= 0x5A)
            upper[:-1] &= body[1:] < 0x80  # and before a possible combining mark, which NFC joins to the letter first
            body = body | (upper.view(np.uint8) << 5)
        before = np.empty_like(kind)
        before[:1], before[1:] = 0, kind[:-1]
        before[offsets[:-1][offsets[:-1] < len(body)]] = 0
        starts = np.flatnonzero(_BEGINS[4 * before + kind])
        blank = np.flatnonzero(kind == 0)
        ends = np.empty_like(starts)
        ends[:-1], ends[-1:] = starts[1:], len(body)
        place = np.searchsorted(blank, starts)  # a unit ends at the next blank, row end or unit
        near = place < len(blank)
        ends[near] = np.minimum(ends[near], blank[place[near]])
        row_end = offsets[np.searchsorted(offsets, starts, "right")] if len(starts) else starts
        ends = np.minimum(ends, row_end)
        h, c = C.span_hashes(body, starts, ends), C.span_sums(body, starts, ends)
        unit = self._find(h, c)
        unknown = np.flatnonzero(unit < 0)
        if len(unknown):
            if 2 * (self.count + len(unknown)) > self.slots and self.count:
                self._empty()
                unknown, unit = np.arange(len(h)), np.full(len(h), -1, np.int32)
            _, one = np.unique(h[unknown] ^ C.mix64(c[unknown]), return_index=True)
            one = unknown[one]
            raw = body.tobytes()
            self._learn(h[one], c[one], [raw[a:b].decode() for a, b in zip(starts[one].tolist(), ends[one].tolist())])
            unit[unknown] = self._find(h[unknown], c[unknown])
        length = (self.first[1:] - self.first[:-1])[unit] if self.count else np.zeros(0, np.int64)
        out = np.zeros(len(unit) + 1, np.int64)
        np.cumsum(length, out=out[1:])
        ids = self.ids[np.repeat(self.first[unit] - out[:-1], length) + np.arange(out[-1])]
        return ids, out[np.searchsorted(starts, offsets)]

    def encode_rows(self, body: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, bool, np.ndarray]]:
        """(row, last part of it, ids) for concatenated UTF-8 texts, in order. Long texts come in several parts."""
        if not self.by_units:
            for r, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                text = body[low:high].tobytes().decode()
                yield r, True, np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            return
        for a, b in C.row_runs(offsets, PASS_BYTES):
            low, high = int(offsets[a]), int(offsets[b])
            if b - a > 1 or high - low <= PASS_BYTES:
                ids, at = self._encode_pass(body[low:high], offsets[a:b + 1] - low)
                for r in range(a, b):
                    yield r, True, ids[at[r - a]:at[r - a + 1]]
                continue
            while low < high:  # one long text, cut after a space
                cut = min(high, low + PASS_BYTES)
                if cut < high:
                    blanks = np.flatnonzero(body[low:cut] == 0x20)
                    if len(blanks) == 0:
                        blanks = np.flatnonzero(body[cut:high] == 0x20) + (cut - low)
                    cut = low + int(blanks[-1 if blanks[0] < cut - low else 0]) + 1 if len(blanks) else high
                ids, _ = self._encode_pass(body[low:cut], np.array([0, cut - low]))
                low = cut
                yield a, low >= high, ids

    def encode(self, text: str | None) -> np.ndarray:
        body = np.frombuffer((text or "").encode(), np.uint8)
        parts = [ids for _, _, ids in self.encode_rows(body, np.array([0, len(body)]))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def encoder(path: str) -> TokenEncoder:
    """The worker's encoder for a tokenizer file (kept for the tasks that follow in the same worker)."""
    with _LOCK:
        if path not in _LOADED:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            _LOADED[path] = TokenEncoder(path)
        return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
