"""Token ids of whole slices of texts, encoding every unit of text once.

The pattern of byte-level BPE matches from left to right and never looks back, and always has
a border between a character that is not white space and one that is, and between a letter
and a comma or full stop. Cut at such borders, a text falls into units whose ids follow each
other. Units are told apart by a 64-bit hash; a unit met before is looked up, a new one is
encoded by the tokenizer. The store is emptied when it holds STORED units, which bounds it.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from lakepnl.llm.text import Words

STORED = 1 << 21
_ALL = np.arange(256)
_BLANK = (_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D))
_LETTER = ((_ALL >= 0x41) & (_ALL <= 0x5A)) | ((_ALL >= 0x61) & (_ALL <= 0x7A))
#: Last bytes of white space beyond ASCII; which of these characters it is depends on the bytes before.
_LAST = np.isin(_ALL, [0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F])
_LEAD = np.isin(_ALL, [0xE1, 0xE2, 0xE3])


def units(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Consecutive spans that together are the whole documents."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        last, now = data[:-1], data[1:]
        two, three = np.zeros(n - 1, np.uint8), np.zeros(n - 1, np.uint8)
        two[1:], three[2:] = data[: n - 2], data[: max(0, n - 3)]
        wide_blank = _LAST[last] & ((two == 0xC2) | _LEAD[three])
        ends_word = ~_BLANK[last] & ~wide_blank
        latin = (two == 0xC3) & (last >= 0x80) & (last <= 0xBF) & (last != 0x97) & (last != 0xB7)
        cut[1:n] = (_BLANK[now] & ends_word) | (((now == 0x2C) | (now == 0x2E)) & (_LETTER[last] | latin))
    cut[offsets] = True
    edge = np.flatnonzero(cut)
    start = edge[:-1]
    return Words(data, start, edge[1:], np.searchsorted(start, offsets))


class Encoder:
    """Ids by the tokenizer file at path, without special tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self._empty()

    def _empty(self) -> None:
        # Sorted hashes of the units that are stored, and where the sizes and ids of each lie.
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pool, self.filled = np.zeros(1 << 20, np.uint32), 0
        self.at, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """Stores new units, given with their hashes in order."""
        known, made = len(self.keys), [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, made), np.int64, len(made))
        ends = self.filled + np.cumsum(size)
        if known + len(keys) > len(self.at):
            more = max(len(keys), len(self.at))
            self.at, self.size = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.at, self.size))
        if ends[-1] > len(self.pool):
            more = max(int(ends[-1]) - len(self.pool), len(self.pool))
            self.pool = np.concatenate([self.pool, np.zeros(more, np.uint32)])
        self.at[known : known + len(keys)], self.size[known : known + len(keys)] = ends - size, size
        self.pool[self.filled : ends[-1]] = np.fromiter(chain.from_iterable(made), np.uint32, int(size.sum()))
        self.filled = int(ends[-1])
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.slot = np.insert(self.slot, place, np.arange(known, known + len(keys)))

    def _slots(self, found: Words) -> np.ndarray:
        """Where the ids of each unit are stored."""
        hashes = found.hashes()
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        keys = ranked[new]
        if len(self.keys) + len(keys) > STORED:
            self._empty()
        missing = np.ones(len(keys), bool)
        if len(self.keys):
            near = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            missing = self.keys[near] != keys
        if missing.any():
            which, data = order[np.flatnonzero(new)[missing]], found.data.tobytes()
            spans = zip(found.start[which].tolist(), found.end[which].tolist(), strict=True)
            self._learn(keys[missing], [data[a:b].decode("utf-8", "surrogatepass") for a, b in spans])
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        return self.slot[np.searchsorted(self.keys, keys)][inverse]

    def counts(self, found: Words) -> np.ndarray:
        """Number of tokens of each unit."""
        if not len(found.start):
            return np.zeros(0, np.int64)
        slots = self._slots(found)
        return self.size[slots]

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents in a row, and where those of each document begin."""
        found = units(data, offsets)
        if not len(found.start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        slots = self._slots(found)
        ends = np.concatenate(([0], np.cumsum(self.size[slots])))
        place = np.repeat(self.at[slots] - ends[:-1], self.size[slots]) + np.arange(ends[-1])
        return self.pool[place], ends[found.first]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
