"""Texts cut into units that a byte-level BPE encodes independently.

A unit is a run of white space with the run of other characters after it, or
a run of letters that white space, a full stop, a comma or the end follows.
No pre-token of the byte-level pattern reaches across such a cut, so the ids
of a text are the ids of its units, one after the other. Each distinct unit
is encoded once and looked up afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np

from tessera.llm.common import ranges

#: Unicode white space (fixed values of the White_Space property).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = rf"[{SPACE}]*[^\W\d_]+(?=[.,{SPACE}]|\Z)|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
CUT = rf"(?<=[^{SPACE}])(?=[{SPACE}])"
#: Distinct units kept before the table starts afresh, and characters cut at a time.
MAX_UNITS, SEGMENT = 400_000, 1 << 20

Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


class _Index(dict):
    """Unit -> number; a new unit gets the next number and waits to be encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.waiting.append(unit)
        return n


class UnitCoder:
    """Encodes texts through ``encode(units) -> (flat ids, ids per unit)``."""

    def __init__(self, encode: Encoder, max_units: int = MAX_UNITS) -> None:
        self.encode, self.unit, self.cut, self.max_units = encode, re.compile(UNIT), re.compile(CUT), max_units
        self._reset()

    def _reset(self) -> None:
        self.index = _Index()
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lens = np.empty(0, np.int64)

    def _flush(self) -> None:
        if self.index.waiting:
            flat, lens = self.encode(self.index.waiting)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
            self.lens = np.concatenate([self.lens, lens])
            self.flat = np.concatenate([self.flat, flat])
            self.index.waiting = []

    def segments(self, text: str) -> Iterator[str]:
        """Pieces of about SEGMENT characters, cut before white space."""
        at = 0
        while len(text) - at > SEGMENT and (m := self.cut.search(text, at + SEGMENT)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the number of ids of each."""
        if len(self.index) > self.max_units:
            self._reset()
        number, parts, counts = self.index.__getitem__, [np.empty(0, np.int64)], []
        for text in texts:
            before = len(parts)
            for segment in self.segments(text):
                parts.append(np.array(list(map(number, self.unit.findall(segment))), np.int64))
            counts.append(sum(map(len, parts[before:])))
        self._flush()
        units = np.concatenate(parts)
        lens = self.lens[units]
        ends = np.concatenate([[0], np.cumsum(lens)])
        at = ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return self.flat[ranges(self.starts[units], lens)], np.diff(at)
