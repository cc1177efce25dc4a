"""Texts to token ids piece by piece, with a bounded table of the pieces met before."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np

from mercata.llm.common import ragged

BLOCK = 1 << 20  # characters


class PieceTable:
    """Cuts texts into pieces whose ids do not depend on one another, and learns each piece once.

    A subclass says how to cut (``pieces``) and how to encode new pieces (``learn``, which calls
    ``keep``). Above ``limit`` pieces those not met again since the last time are dropped.
    """

    def __init__(self, kind: type, limit: int):
        self.kind, self.limit = kind, limit
        self.known: dict[str, int] = {}
        self.flat = np.empty(1 << 16, kind)
        self.bounds = np.zeros(1 << 12, np.int64)
        self.met = np.zeros(1 << 12, bool)
        self.used = 0

    def pieces(self, text: str) -> list[str]:
        raise NotImplementedError

    def learn(self, new: list[str]) -> None:
        raise NotImplementedError

    def keep(self, pieces: Iterable[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Add pieces that are not known yet; ``ids`` has their ids one after another."""
        end, code, n = self.used + len(ids), len(self.known), len(lengths)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(end, len(self.flat)), self.kind)])
        if code + n + 1 > len(self.bounds):
            more = max(code + n + 1, len(self.bounds))
            self.bounds = np.concatenate([self.bounds, np.zeros(more, np.int64)])
            self.met = np.concatenate([self.met, np.zeros(more, bool)])
        self.flat[self.used : end] = ids
        self.bounds[code + 1 : code + 1 + n] = self.used + np.cumsum(lengths)
        self.met[code : code + n] = False
        self.used = end
        self.known.update(zip(pieces, range(code, code + n), strict=True))

    def drop_unmet(self) -> None:
        rows = np.flatnonzero(self.met[: len(self.known)])
        if len(rows) > self.limit // 2:
            rows = rows[:0]
        lengths = np.diff(self.bounds)[rows]
        flat = ragged(self.flat, self.bounds[rows], lengths)
        stay = self.met[: len(self.known)] if len(rows) else np.zeros(len(self.known), bool)
        names = [p for p, yes in zip(self.known, stay.tolist(), strict=True) if yes]
        self.known, self.used = {}, 0
        self.keep(names, flat, lengths)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        block: list[list[str]] = []
        size = 0
        for i, text in enumerate(texts):
            block.append(self.pieces(text))
            size += len(text)
            if size > BLOCK or i == len(texts) - 1:
                yield from self._encode_block(block)
                block, size = [], 0

    def _encode_block(self, block: list[list[str]]) -> Iterator[np.ndarray]:
        if len(self.known) > self.limit:
            self.drop_unmet()
        look = self.known.get
        found = [np.fromiter(map(look, pieces, repeat(-1)), np.int64, len(pieces)) for pieces in block]
        gaps = [np.flatnonzero(codes < 0).tolist() for codes in found]
        if new := {pieces[i] for pieces, gap in zip(block, gaps, strict=True) for i in gap}:
            self.learn(list(new))
        for pieces, codes, gap in zip(block, found, gaps, strict=True):
            self.met[codes[codes >= 0]] = True
            if gap:
                codes[gap] = [self.known[pieces[i]] for i in gap]
            starts = self.bounds[codes]
            yield ragged(self.flat, starts, self.bounds[codes + 1] - starts)
