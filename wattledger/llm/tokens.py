"""Encoding of whole texts with a ``tokenizers`` file, remembering the ids of repeated units.

A text is cut into units that the tokenizer encodes independently of their neighbours, so that ids of frequent units
are looked up. Units are exact, not an approximation: see ``Encoder.units``.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# white space on which str.split, Python's \s and the tokenizers' \s do not agree for certain: such texts are one unit
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff]")
_SPACES = " \t\n\r\x0b\x0c"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_PLAIN = re.compile(f" ?[!-~{_LETTERS}]+")
_IS_SPACE = np.isin(np.arange(256), list(_SPACES.encode()))
_MAY_BE_ODD = np.isin(np.arange(256), [*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])  # bytes that odd white space begins with
_WINDOW = 4 << 20  # bytes of text cut into pieces together
_SPACE, _LETTER, _DIGIT, _OTHER, _FOREIGN = range(5)
_CLASS = np.full(256, _FOREIGN, np.uint8)
_CLASS[list(_SPACES.encode())] = _SPACE
_CLASS[0x21:0x7F] = _OTHER
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself if printable Latin-1, else from 256 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(moved)}


class _Memo(dict):
    """unit -> ids as bytes; remembers the first ``limit`` units of usual length, and works out others each time."""

    def __init__(self, ids, limit: int):
        super().__init__()
        self.ids = ids
        self.limit = limit

    def __missing__(self, unit: str) -> bytes:
        found = array("I", self.ids(unit)).tobytes()
        if len(self) < self.limit and len(unit) <= 64:
            self[unit] = found
        return found


class _Known:
    """What ``find`` gives for a key. Keys that came twice are kept; of those that came once the latest ``limit`` at most, since
    most words of a corpus never come again."""

    def __init__(self, find, limit: int):
        self.find, self.limit = find, limit
        self.often: dict = {}
        self.once: dict = {}

    def __getitem__(self, key):
        found = self.often.get(key)
        if found is None:
            found = self.once.get(key)
            if found is None:
                found = self.find(key)
                if len(key) <= 64:
                    if len(self.once) >= self.limit:
                        self.once.clear()
                    self.once[key] = found
            elif len(self.often) < self.limit:
                self.often[key] = found
        return found


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers in bytes, the same as ``encode(..., add_special_tokens=False)``.

    path: a tokenizers JSON file. limit: units or pieces remembered; others are encoded when they occur.
    """

    def __init__(self, path: str, limit: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = _Memo(self.ids, limit)
        self.known = _Known(self._unknown, limit)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        pre, normalizer = config.get("pre_tokenizer") or {}, config.get("normalizer")
        added = [t["content"] for t in config["added_tokens"]]
        plain_added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in config["added_tokens"])
        steps = pre.get("pretokenizers", [pre])
        patterns = [s.get("pattern", {}).get("Regex", "") for s in steps if s.get("type") == "Split"]
        leading = normalizer is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        dropped = (
            len(steps) == 2
            and steps[0].get("behavior") == "Removed"
            and steps[0].get("invert")
            and patterns == [r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"]
        )
        self.kind = "leading" if leading and plain_added else "dropped" if dropped and plain_added else "whole"
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        digits = "[0-9]+" if self.kind == "leading" else "[0-9]"
        lead = " ?" if self.kind == "leading" else ""
        self.pieces = re.compile(f"'(?:s|t|re|ve|m|ll|d)|{lead}[{_LETTERS}]+|{lead}{digits}|{lead}[^ {_LETTERS}0-9]+")
        self.lower = self.kind == "dropped"
        self.letters = _byte_letters()
        self.chunks = re.compile(f" ?[^{_SPACES}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+").findall

    def units(self, text: str) -> list[str]:
        """Parts of ``text`` whose ids, one after the other, are the ids of the text.

        Added tokens are cut out first, as the library does. White space is dropped or, with the byte-level pattern,
        is only ever the first character of a pre-token or a pre-token by itself; so words (with the one space before
        them) and runs of white space do not influence each other. Texts with other than ASCII white space, and all
        texts of a tokenizer of another kind, stay one unit.
        """
        if self.kind == "whole" or _ODD.search(text):
            return [text] if text else []
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [u for i, part in enumerate(parts) for u in ([part] if i % 2 else self._split(part))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        return text.split() if self.kind == "dropped" else self.chunks(text)

    def ids(self, unit: str) -> list[int]:
        """Ids of one unit. Units of plain characters go to the BPE model without the library's work on offsets."""
        if self.kind == "whole" or not _PLAIN.fullmatch(unit) or (self.special and self.special.search(unit)):
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        out: list[int] = []
        for piece in self.pieces.findall(unit.lower() if self.lower else unit):
            # visible ASCII stands for itself
            written = piece if piece.isascii() and piece[0] != " " else "".join([self.letters[b] for b in piece.encode()])
            out += [t.id for t in self.tokenizer.model.tokenize(written)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; 4 bytes each."""
        return [b"".join(map(self.memo.__getitem__, self.units(t))) for t in texts]

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a column, null as empty, the same as ``encode`` gives.

        All texts are cut into pieces at once, whose distinct ones are looked up. Texts that ``units`` does not cut by plain
        white space go the other way.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.kind == "whole":
            return [np.frombuffer(x, "<u4") for x in self.encode(texts.to_pylist())]
        offsets, data = _buffers(texts)
        ends = np.concatenate([[0], np.cumsum(_MAY_BE_ODD[data])])
        odd = ends[offsets[1:]] > ends[offsets[:-1]]
        for i in np.flatnonzero(odd).tolist():
            odd[i] = bool(_ODD.search(texts[i].as_py()))
        for token in self.added:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd)
        if odd.any():
            offsets, data = _buffers(texts.take(pa.array(plain)))
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        ids, bounds = self._plain_ids(offsets, data)
        for i, start, stop in zip(plain.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out[i] = ids[start:stop]
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.frombuffer(self.encode([texts[i].as_py()])[0], "<u4")
        return out

    def _plain_ids(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where those of each text begin."""
        parts, bounds, before = [], np.zeros(len(offsets), np.int64), 0
        for start, stop in _windows(offsets, data):
            own = data[start:stop]
            texts = np.arange(np.searchsorted(offsets, start), np.searchsorted(offsets, stop, "left" if stop < len(data) else "right"))
            cuts, own = self._cut(own, offsets[texts] - start)
            pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(own)).astype(np.int32)), pa.py_buffer(own)])
            coded = pieces.dictionary_encode()
            number = coded.indices.to_numpy()
            known = [self.known[p] for p in coded.dictionary.to_pylist()]
            sizes = np.array([len(k) // 4 for k in known], dtype=np.int64)
            first, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), "<u4")
            n = sizes[number]
            total = np.cumsum(n)
            # the ids of a piece stand together in ``flat``, from where its own begin
            parts.append(flat[np.repeat(first[number] - total + n, n) + np.arange(int(total[-1]))])
            bounds[texts] = before + np.concatenate([[0], total])[np.searchsorted(cuts, offsets[texts] - start)]
            before += int(total[-1])
        return (np.concatenate(parts) if parts else np.zeros(0, "<u4")), bounds

    def _unknown(self, piece: bytes) -> bytes:
        return b"" if self.kind == "dropped" and piece.isspace() else array("I", self.ids(piece.decode())).tobytes()

    def _cut(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin, and the bytes as they are looked up. ``texts``: where texts begin.

        Units of plain characters are cut as ``pieces`` does: at changes between letters, digits and other characters, before
        and after the endings it names. Others are pieces as a whole. If the tokenizer lower-cases, so are the plain ones.
        """
        leading = self.kind == "leading"
        kind = _CLASS[data]
        latin = np.flatnonzero(data[:-1] == 0xC3)
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
        kind[latin] = kind[latin + 1] = _LETTER
        space = kind == _SPACE
        change = np.flatnonzero(space[1:] != space[:-1]) + 1
        cut = np.zeros(len(data), bool)
        cut[0] = True
        cut[texts[texts < len(data)]] = True
        if leading:  # the last white space before a word is a unit by itself, or part of the word if it is a space
            words = change[~space[change]]
            words = words[~cut[words]]
            cut[words - 1] = True
            cut[words[data[words - 1] != 0x20]] = True
            cut[change[space[change]]] = True
        else:
            cut[change] = True
        unit = np.cumsum(cut) - 1
        plain = (np.add.reduceat(kind == _FOREIGN, np.flatnonzero(cut)) == 0)[unit]
        starts = cut.copy()
        inside = plain[1:] & ~cut[1:] & ~space[:-1]
        different = kind[1:] != kind[:-1]
        if not leading:
            different |= kind[1:] == _DIGIT
            upper = plain & (data >= 0x41) & (data <= 0x5A)
            second = latin[plain[latin] & (data[latin + 1] >= 0x80) & (data[latin + 1] <= 0x9E)] + 1
            data = data + upper.astype(np.uint8) * np.uint8(0x20)
            data[second] += 0x20
        cut[1:] |= inside & different
        marks = np.flatnonzero((data == 0x27) & plain & cut)
        ends = np.concatenate([data, np.zeros(2, np.uint8)])
        one, two = ends[marks + 1], ends[marks + 2]
        short = np.isin(one, list(b"stmd"))
        long = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
        size = np.where(short, 2, np.where(long, 3, 0))
        marks, size = marks[size > 0], size[size > 0]
        same = unit[np.minimum(marks + size - 1, len(data) - 1)] == unit[marks]
        marks, size = marks[same], size[same]
        cut[marks + 1] = False
        after = marks + size
        cut[after[after < len(data)]] = True
        cut |= starts
        return np.flatnonzero(cut), data


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 on and the bytes of a column without nulls."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _windows(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``_WINDOW`` bytes that end with a text or a word, before white space."""
    start = 0
    while start < len(data):
        stop, step = start + _WINDOW, _WINDOW
        while stop < len(data):
            end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            space = _IS_SPACE[data[max(stop - step, start + 1) - 1 : stop]]
            word_ends = np.flatnonzero(space[1:] & ~space[:-1])
            best = max(end, max(stop - step, start + 1) + int(word_ends[-1]) if len(word_ends) else 0)
            if best > start:
                stop = best
                break
            stop += step
        stop = min(stop, len(data))
        yield start, stop
        start = stop


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    return Encoder(path)


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
