"""Token ids of whole texts by a public tokenizer, with a per-worker memory of words.

A tokenizer whose rules are those of ``_RULES`` never joins characters across ASCII white space, nor a
letter with a following punctuation mark of ``_CUT``. So a text's ids are those of its
pieces, and each distinct piece is given to the library once per worker. Texts that hold
the start of a special token are given to the library whole, and so are all texts of a
tokenizer with other rules.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa

from bibweave.llm.textvec import LOWER, SPACE, Words, slices

#: Pieces a worker remembers before it starts anew, and slots of its table (24 MB).
MEMORY, SLOTS = 1 << 20, 1 << 21

_LETTER = np.array([65 <= i <= 90 or 97 <= i <= 122 for i in range(256)])
_LATIN_TAIL = np.array([0x80 <= i <= 0xBF and i not in (0x97, 0xB7) for i in range(256)])
_CUT = np.array([chr(i) in ".,;:!?*#$%&" for i in range(256)])


# The normaliser and the splitting for which pieces can be encoded one by one, as the library states them.
_RULES = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)


def _by_pieces(library) -> bool:
    """Whether a tokenizer has the rules under which pieces can be encoded one by one."""
    parts = library.normalizer, library.pre_tokenizer
    return all(p is not None and json.loads(p.__getstate__()) == rule for p, rule in zip(parts, _RULES))


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [i for i in range(256) if i not in plain]
    return {i: chr(i) for i in plain} | {i: chr(256 + k) for k, i in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()
_LATIN = str.maketrans({chr(c): "".join(_BYTE_LETTERS[b] for b in chr(c).encode()) for c in range(0x24F + 1)})


@functools.cache
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Encodes slices of a column; one per worker and tokenizer file."""

    def __init__(self, path: str):
        self.library = _library(path)
        self.model = self.library.model
        self.by_pieces = _by_pieces(self.library)
        self.special = [t.content.encode().lower() for t in self.library.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.entry = np.zeros(SLOTS, np.int32)
        self.held = 0
        self.at = np.zeros(MEMORY, np.int64)
        self.size = np.zeros(MEMORY, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _piece(self, piece: bytes) -> list[int]:
        """Ids of one piece; a word of Latin letters only is one unit and goes straight to the merges."""
        text = piece.decode()
        if text.isascii():
            if text.isalpha():
                return [t.id for t in self.model.tokenize(text.lower())]
        elif text.isalpha() and max(text) <= "\u024f" and "\u0130" not in text:
            return [t.id for t in self.model.tokenize(text.lower().translate(_LATIN))]
        return self.library.encode(text, add_special_tokens=False).ids

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if unknown."""
        slot = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        key = self.keys[slot]
        out = np.where(key == h, self.entry[slot], -1)
        on = np.flatnonzero((key != h) & (key != 0))
        while len(on):
            slot[on] = (slot[on] + 1) & (SLOTS - 1)
            key = self.keys[slot[on]]
            hit = key == h[on]
            out[on[hit]] = self.entry[slot[on[hit]]]
            on = on[~hit & (key != 0)]
        return out

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Remember new distinct pieces."""
        found = [self._piece(piece) for piece in pieces]
        size = np.array([len(x) for x in found], dtype=np.int64)
        flat = np.array([i for x in found for i in x], dtype=np.uint32)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(flat), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        entry = np.arange(self.held, self.held + len(found))
        self.at[entry], self.size[entry] = self.used + np.cumsum(size) - size, size
        self.used, self.held = self.used + len(flat), self.held + len(found)
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):  # each free slot goes to one of those that ask for it
            free = todo[self.keys[slot[todo]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.entry[slot[won]] = hashes[won], entry[won]
            todo = todo[self.keys[slot[todo]] != hashes[todo]]
            slot[todo] = (slot[todo] + 1) & (SLOTS - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, one after another, and each row's bounds."""
        rows = len(offsets) - 1
        words = Words(data, offsets, ~SPACE[data])
        # A-Z of words in ASCII only: elsewhere case can change how marks compose
        low = LOWER[data]
        wide = data >= 128
        if wide.any():
            seen = np.concatenate([[0], np.cumsum(wide)])
            odd = np.flatnonzero(seen[words.end] > seen[words.start])
            turn = np.zeros(len(data) + 1, dtype=np.int8)
            turn[words.start[odd]] += 1
            turn[words.end[odd]] -= 1
            low = np.where(np.cumsum(turn[:-1], dtype=np.int8) > 0, data, low)
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = _CUT[low[1:]] & _LETTER[low[:-1]]
        # letters of the second Latin block: C3 80 to C3 BF but for the signs at 97 and B7
        cut[2:] |= _CUT[low[2:]] & _LATIN_TAIL[low[1:-1]] & (low[:-2] == 0xC3)
        cut[words.start] = False  # a row may begin with a mark, after the letter that ends the one before
        start, end = cut.copy(), cut
        start[words.start] = True
        words.start = np.flatnonzero(start)
        words.end = np.sort(np.concatenate([words.end, np.flatnonzero(end)]))
        h = words.hashes(low)
        h[h == 0] = 1
        entry = self._find(h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            unique, first = np.unique(h[new], return_index=True)
            if self.held + len(unique) > MEMORY:
                self._forget()
                unique, first = np.unique(h, return_index=True)
                new = np.arange(len(h))
            raw = low.tobytes()
            self._learn(unique, [raw[words.start[i] : words.end[i]] for i in new[first]])
            entry[new] = self._find(h[new])
        size = self.size[entry].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        pick = np.repeat(self.at[entry] - total[:-1], size) + np.arange(total[-1])
        ids = self.ids[pick]
        bounds = total[np.searchsorted(words.start, offsets)]
        return ids, bounds

    def rows(self, column: pa.Array):
        """Ids of each row of a string column; nulls are empty."""
        if not self.by_pieces:
            for text in column:
                yield np.array(self.library.encode(text.as_py() or "", add_special_tokens=False).ids, dtype=np.uint32)
            return
        for _, _, data, offsets in slices(column):
            ids, bounds = self.encode(data, offsets)
            raw = data.tobytes() if len(data) else b""
            low = raw.lower()
            # the library finds them in any case, so every row is judged by its lower-cased bytes
            special = {i for i in range(len(offsets) - 1) if any(t in low[offsets[i] : offsets[i + 1]] for t in self.special)} if any(t in low for t in self.special) else ()
            for i in range(len(offsets) - 1):
                if i in special:
                    text = raw[offsets[i] : offsets[i + 1]].decode()
                    yield np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
                else:
                    yield ids[bounds[i] : bounds[i + 1]]


@functools.cache
def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return Encoder(path)
