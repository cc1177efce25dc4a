"""Byte-level BPE encoding and decoding by a walk over the trie of distinct words.

In greedy BPE the last token of a text's encoding is fixed by the text, and the tokens before it
encode the text before it. So one *last token* per trie node is the whole encoding of the node's
prefix: the last token of a prefix is the one suffix of it that is a token and that BPE would
leave beside the last token of what stands before. Distinct words are visited in sorted order,
which is a depth-first walk of their trie: states of a shared prefix stay on the stack and are
computed once. Texts are cut at single blanks and line ends (tokens never cross these), the
pieces are looked up, and only pieces that are new to the worker are encoded.

Rows never leave their partition: there is no shuffle, and memory is one Arrow batch and a
bounded table of known pieces.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from mercata.llm.common import ragged, read_table
from mercata.llm.pieces import PieceTable

VOCABULARY = "byte_bpe_50k.json"
KNOWN_PIECES = 600_000
NEVER = 1 << 60
UNMADE = (-1, 0, 0)
SPACES = regex.compile(r"\s\s")
CUT = regex.compile(r"(?<=\S)(?=[ \n]\S)")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        texts = {word: bytes(alphabet[c] for c in word) for word in spec["model"]["vocab"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*spec["model"]["vocab"].values(), *self.special.values()])
        self.text = [b""] * size
        for word, number in spec["model"]["vocab"].items():
            self.text[number] = texts[word]
        for word, number in self.special.items():
            self.text[number] = word.encode()
        self.number = {texts[word]: number for word, number in spec["model"]["vocab"].items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: rank of its merge, left, right
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ids = self.number[texts[left]], self.number[texts[right]]
            self.rank[ids] = rank
            self.parts.setdefault(self.number[texts[left] + texts[right]], (rank, *ids))
        #: Every end of every token, with its number, or -1 where the end itself is no token.
        self.ends = {t[i:]: self.number.get(t[i:], -1) for t in self.number for i in range(len(t))}
        self._beside: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        lengths = np.array([len(t) for t in self.text], np.int64)
        self.flat, self.lengths = np.frombuffer(b"".join(self.text), np.uint8), lengths
        self.starts = np.cumsum(lengths) - lengths

    def beside(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side.

        The merges that made the two are undone, the latest first. The parts that meet must never
        have been the next pair to merge: the left part's own next merge came no later than
        theirs, or the right part's came before it (of equal merges the left one is done first).
        """
        key = (left, right)
        if (known := self._beside.get(key)) is None:
            known = True
            left_until = right_until = NEVER
            while known:
                meet = self.rank.get((left, right), NEVER)
                known = not (meet < left_until and meet <= right_until and meet < NEVER)
                left_made, right_made = self.parts.get(left, UNMADE), self.parts.get(right, UNMADE)
                if left_made is UNMADE and right_made is UNMADE:
                    break
                if left_made[0] > right_made[0]:
                    left_until, _, left = left_made
                else:
                    right_until, right, _ = right_made
            self._beside[key] = known
        return known

    def whole(self, token: int) -> bool:
        """Whether BPE turns the token's text into that one token."""
        if (known := self._whole.get(token)) is None:
            if (made := self.parts.get(token)) is None:
                known = True
            else:
                _, left, right = made
                known = self.whole(left) and self.whole(right) and self._meet(left, right, made[0])
            self._whole[token] = known
        return known

    def _meet(self, left: int, right: int, rank: int) -> bool:
        """Whether the two stand side by side until the merge of ``rank``."""
        self.rank.pop((left, right))
        try:
            self._beside.pop((left, right), None)
            return self.beside(left, right)
        finally:
            self._beside.pop((left, right), None)
            self.rank[(left, right)] = rank

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The encodings of distinct words, given in sorted order."""
        out, last, before = [], [0], b""
        ends, text, known = self.ends, self.text, self._beside
        for word in words:
            depth, most = 0, min(len(word), len(before))
            while depth < most and word[depth] == before[depth]:
                depth += 1
            del last[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                start = end - 1
                while True:  # exactly one suffix fits
                    token = ends[word[start:end]]
                    if token >= 0:
                        if start == 0:
                            fits = self.whole(token)
                        elif (fits := known.get((last[start], token))) is None:
                            fits = self.beside(last[start], token)
                        if fits:
                            break
                    start -= 1
                last.append(token)
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end -= len(text[last[end]])
            out.append(ids[::-1])
            before = word
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of the ids in UTF-8, with broken sequences replaced."""
        raw = ragged(self.flat, self.starts[ids], self.lengths[ids]).tobytes()
        return raw.decode("utf-8", "replace").encode()


class Encoder(PieceTable):
    """Texts to ids."""

    def __init__(self, path: str, pattern: str):
        super().__init__(np.int32, KNOWN_PIECES)
        self.words = Vocabulary(path)
        self.pattern = regex.compile(pattern)
        self.marks = regex.compile("|".join(map(regex.escape, self.words.special)) or r"(?!)")

    def pieces(self, text: str) -> list[str]:
        """The text cut before each blank or line end that stands alone between other characters."""
        if SPACES.search(text) is None and "\0" not in text:
            return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        return CUT.split(text)

    def words_of(self, piece: str) -> list[str | int]:
        """The words of a piece and the ids of special tokens that it holds."""
        out: list[str | int] = []
        end = 0
        for mark in self.marks.finditer(piece):
            out += self.pattern.findall(piece[end : mark.start()])
            out.append(self.words.special[mark.group()])
            end = mark.end()
        return out + self.pattern.findall(piece[end:])

    def learn(self, new: list[str]) -> None:
        """Encode the words that are new among the pieces, then put the pieces together from words."""
        split = [(p, self.words_of(p)) for p in new]
        words = sorted({w for _, ws in split for w in ws if w not in self.known and isinstance(w, str)}, key=str.encode)
        rows = self.words.encode_words([w.encode() for w in words])
        self.keep(words, np.array([i for r in rows for i in r], np.int32), np.array([*map(len, rows)], np.int64))
        mixed, rows = [], []
        for piece, ws in split:
            if piece not in self.known:
                row: list[int] = []
                for w in ws:
                    if isinstance(w, int):
                        row.append(w)
                    else:
                        code = self.known[w]
                        row += self.flat[self.bounds[code] : self.bounds[code + 1]].tolist()
                mixed.append(piece)
                rows.append(row)
        self.keep(mixed, np.array([i for r in rows for i in r], np.int32), np.array([*map(len, rows)], np.int64))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One for each vocabulary and Python worker."""
    return Encoder(path, pattern)


def encoded(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """One row per row of ``df``: the id and ``ids`` (int32 array). A null text is empty."""

    def run(batches):
        words = encoder(path, pattern)
        for batch in batches:
            rows = list(words.encode([t or "" for t in batch.column(1).to_pylist()]))
            flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
            bounds = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(bounds, pa.array(flat))], ["id", "ids"])

    kind = dict(df.dtypes)[id_col]
    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>"
    )


def decoded(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``df`` (id, ids): the id and the text of its ids."""

    def run(batches):
        words = encoder(path, pattern).words
        for batch in batches:
            texts = [words.decode(np.asarray(ids.values)) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["id", "text"])

    kind = dict(df.dtypes)["id"]
    return df.select("id", "ids").mapInArrow(run, f"id {kind}, text string")


def round_trips(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """Each row's id, number of tokens, digest of its ids and digest of the text decoded from them."""

    def run(batches):
        words = encoder(path, pattern)
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            for ids in words.encode([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids))
                ids_digest.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_digest.append(hashlib.sha256(words.words.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(df.dtypes)[id_col]
    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = str(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN
    rows = round_trips(read_table(spark, sf_dir, "documents"), "doc_id", "text", path, pattern)
    return rows.withColumnRenamed("id", "doc_id")
