"""Texts to the ids of a word-level BPE vocabulary, by the tokenizers library.

The vocabulary drops white space, so a text's ids are those of its pieces between blanks and line
ends. Each Python worker asks the library only for pieces that are new to it, many in one call.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

from mercata.llm.bpe import byte_alphabet
from mercata.llm.common import ragged
from mercata.llm.pieces import PieceTable

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
KNOWN_PIECES = 1_200_000
CALL = 64
POINTS = ".,;:!?"


class WordIds(PieceTable):
    def __init__(self, path: str, known: int = KNOWN_PIECES):
        from tokenizers import Tokenizer

        super().__init__(np.uint16, known)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark_id, self.mark = min((i, t.content) for i, t in special.items())
        self.model = self.tokenizer.model
        self.alphabet = {byte: shown for shown, byte in byte_alphabet().items()}
        self.points = {"": []} | {p: self._ids(p).tolist() for p in POINTS}

    def pieces(self, text: str) -> list[str]:
        # The vocabulary is lower case; Python's lower case is the library's for these letters.
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)

    def learn(self, new: list[str]) -> None:
        """A word of plain letters, with a point at most after it, goes straight to the library's
        BPE model, in lower case and in its byte alphabet, and is learnt as a piece itself. Other
        pieces go through the whole tokenizer, parted by a special token."""
        known, model = self.known, self.model
        if any(p not in known for p in self.points):
            self.keep_rows({p: ids for p, ids in self.points.items() if p not in known})
        words: dict[str, list[int]] = {}
        shaped, bases, points, odd = [], [], [], []
        for p in new:
            word, point = (p, "") if p.isalpha() else (p[:-1], p[-1:])
            if point not in self.points or not word.isalpha():
                odd.append(p)
            elif word.isascii() or max(word) < "\u0100":
                word = word.lower()
                if word not in known and word not in words:
                    words[word] = [t.id for t in model.tokenize(word if word.isascii() else self.bytewise(word))]
                if word != p:
                    shaped.append(p)
                    bases.append(word)
                    points.append(point)
            else:
                odd.append(p)
        self.keep_rows(words)
        codes = np.empty(2 * len(shaped), np.int64)
        codes[::2] = np.fromiter(map(known.__getitem__, bases), np.int64, len(bases))
        codes[1::2] = np.fromiter(map(known.__getitem__, points), np.int64, len(points))
        starts = self.bounds[codes]
        lengths = self.bounds[codes + 1] - starts
        self.keep(shaped, ragged(self.flat, starts, lengths), lengths[::2] + lengths[1::2])
        odd = [p for p in odd if p not in known]
        for i in range(0, len(odd), CALL):
            part = [p for p in odd[i : i + CALL] if self.mark not in p]
            if part:
                ids = self._ids(self.mark.join(part))
                marks = np.flatnonzero(ids == self.mark_id)
                self.keep(part, ids[ids != self.mark_id], np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1)
        self.keep_rows({p: self._ids(p) for p in odd if self.mark in p})

    def keep_rows(self, rows: dict[str, list[int]]) -> None:
        flat = np.fromiter(chain.from_iterable(rows.values()), np.uint16)
        self.keep(rows, flat, np.fromiter(map(len, rows.values()), np.int64, len(rows)))

    def bytewise(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.alphabet)

    def with_end(self, texts: list[str], end_id: int = END_ID) -> Iterator[np.ndarray]:
        """The ids of each text (uint16), then ``end_id``."""
        end = np.array([end_id], np.uint16)
        for ids in self.encode(texts):
            yield np.concatenate([ids, end])


@lru_cache(maxsize=1)
def word_ids(path: str, known: int = KNOWN_PIECES) -> WordIds:
    """One for each Python worker."""
    return WordIds(path, known)
