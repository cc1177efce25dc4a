"""Vector bin packing of token sequences.

A sequence has three limits: tokens, segments (pieces of documents) and loss-bearing tokens. It is
filled by the dot-product heuristic: of the examples that fit in what is left, the one whose
demand vector, weighted by how scarce each dimension is, points most along the free capacity. Where
no whole example fits any more, a text is cut to fill the rest (``cut``); instruction data, whose
examples must stay whole, leaves the rest free. Sequences with a power of two of tokens need no
padding, so what is over at the end of a block is dealt out in powers of two.

Each task packs its own rows in blocks of bounded size as they come, so nothing is shuffled and
no task holds more than a block; a hot source or many copies do not matter. A sequence's id is the
task's partition number in the upper bits and a running number below; what a task that is run
again returns is complete in itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from mercata.llm.common import give_back, read_table
from mercata.llm.word_ids import KNOWN_PIECES, VOCABULARY, word_ids

BLOCK_ROWS, BLOCK_TOKENS = 2048, 1 << 22


@dataclass(frozen=True)
class Limits:
    """Of one sequence. Segments are as many as tokens unless fewer are asked for."""

    tokens: int = 4096
    segments: int = 4096
    loss: int = 4096


@dataclass
class Piece:
    row: int  # of the block
    start: int  # tokens of the row before it
    length: int
    sequence: int
    offset: int


def place(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool) -> list[Piece]:
    """Deal a block's rows out to sequences numbered from 0.

    With ``cut`` every token bears loss or the row's loss spreads evenly over its tokens, and no
    row is refused. Without it a row beyond a limit by itself gets a sequence of its own.
    """
    return (_Cutter if cut else _Keeper)(tokens, loss, limits).run()


class _Packer:
    def __init__(self, tokens: np.ndarray, loss: np.ndarray, limits: Limits):
        self.cap = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.left = np.asarray(tokens, np.int64).copy()  # tokens not dealt out yet, by row
        self.rate = np.asarray(loss, float) / np.maximum(tokens, 1)
        self.start = np.zeros(len(self.left), np.int64)
        self.pieces: list[Piece] = []
        self.sequence = 0

    def demand(self) -> np.ndarray:
        return np.stack([self.left, np.ones(len(self.left)), self.left * self.rate], 1) / self.cap

    def give(self, row: int, length: int, offset: int) -> None:
        self.pieces.append(Piece(row, int(self.start[row]), int(length), self.sequence, offset))
        self.start[row] += length
        self.left[row] -= length

    def fill(self) -> tuple[int, np.ndarray]:
        """Whole examples into one sequence, best first; its tokens and what is free."""
        need, free, offset = self.need, np.ones(3), 0
        while True:
            fits = (need <= free + 1e-9).all(1) & self.open
            if not fits.any():
                return offset, free
            row = int(np.argmax(np.where(fits, need @ (self.weight * free), -1.0)))
            length = self.left[row]
            free = free - need[row]
            self.open[row] = False
            self.give(row, length, offset)
            offset += int(length)

    def prepare(self, open_rows: np.ndarray) -> None:
        self.open = open_rows
        self.need = self.demand()
        self.weight = self.need[open_rows].sum(0)


class _Keeper(_Packer):
    def run(self) -> list[Piece]:
        self.prepare(np.ones(len(self.left), bool))
        for row in np.flatnonzero((self.need > 1).any(1)):
            self.open[row] = False
            self.give(row, self.left[row], 0)
            self.sequence += 1
        while self.open.any():
            self.fill()
            self.sequence += 1
        return self.pieces


class _Cutter(_Packer):
    def run(self) -> list[Piece]:
        cap = int(self.cap[0])
        # The most tokens of a row that one sequence can take.
        most = np.minimum(cap, np.where(self.rate > 0, self.cap[2] // np.maximum(self.rate, 1e-9), cap)).astype(np.int64)
        most = np.maximum(most, 1)
        for row in np.flatnonzero(self.left >= most):
            while self.left[row] >= most[row]:
                self.give(row, self.even(most[row]), 0)
                self.sequence += 1
        self.prepare(self.left > 0)
        while self.open.any():
            total, *others = (self.need[self.open].sum(0) * self.cap).round(6)
            if total < cap and (np.array(others) <= self.cap[1:]).all():
                self.rest(int(total))
                break
            offset, free = self.fill()
            gap = cap - offset
            if gap and self.open.any() and free[1] * self.cap[1] >= 1:
                # No example fits whole; cut the one with the most tokens for the room there is.
                row = int(np.argmax(np.where(self.open, self.left, -1)))
                room = gap if self.rate[row] == 0 else min(gap, int(free[2] * self.cap[2] / self.rate[row] + 1e-9))
                if 0 < room < self.left[row]:
                    self.give(row, room, offset)
                    self.need[row] = np.array([self.left[row], 1, self.left[row] * self.rate[row]]) / self.cap
            self.sequence += 1
        return self.pieces

    def even(self, length: int) -> int:
        """The largest full or power-of-two length up to ``length``."""
        return length if length == self.cap[0] else 1 << (int(length).bit_length() - 1)

    def rest(self, total: int) -> None:
        """Less than one sequence is over: one sequence for each power of two in it."""
        rows = iter(np.flatnonzero(self.open))
        row = next(rows)
        while total:
            size, offset, segments = self.even(total), 0, 0
            while offset < size:
                if self.left[row] == 0:
                    row = next(rows)
                length = min(size - offset, int(self.left[row]))
                self.give(row, length, offset)
                offset += length
                segments += 1
            total -= size
            self.sequence += 1
        self.open[:] = False


def packed_documents(
    df: DataFrame, id_col: str, text_col: str, path: str, limits: Limits = Limits(), *, known: int = KNOWN_PIECES
) -> DataFrame:
    """One row per piece of a text: every token bears loss and texts may be cut.

    Columns: id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null text is empty and
    has the end id alone. Repeated rows are packed as many times as they come; a null id stays null.
    A Python worker keeps the ids of about ``known`` pieces of texts.
    """

    def run(batches):
        give_back()
        words = word_ids(path, known)
        first = TaskContext.get().partitionId() << 32
        for ids, rows in _blocks(batches, words):
            lengths = np.array([len(r) for r in rows], np.int64)
            pieces = place(lengths, lengths, limits, cut=True)
            yield _piece_rows(ids, rows, lengths, pieces, first)
            first += 1 + max(p.sequence for p in pieces)

    kind = dict(df.dtypes)[id_col]
    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(
        run,
        f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )


def _blocks(batches, words) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    ids: list[pa.Array] = []
    rows: list[np.ndarray] = []
    tokens = taken = 0
    for batch in batches:
        taken = 0
        for i, row in enumerate(words.with_end([t or "" for t in batch.column(1).to_pylist()])):
            rows.append(row)
            tokens += len(row)
            if len(rows) >= BLOCK_ROWS or tokens >= BLOCK_TOKENS:
                ids.append(batch.column(0).slice(taken, i + 1 - taken))
                yield pa.concat_arrays(ids), rows
                ids, rows, tokens, taken = [], [], 0, i + 1
        ids.append(batch.column(0).slice(taken))
    if rows:
        yield pa.concat_arrays(ids), rows


def _piece_rows(ids, rows, lengths, pieces: list[Piece], first: int) -> pa.RecordBatch:
    crc = [zlib.crc32(rows[p.row][p.start : p.start + p.length].astype("<u4").tobytes()) for p in pieces]
    at = np.array([p.row for p in pieces], np.int64)
    columns = [
        ids.take(pa.array(at)),
        *[pa.array(c, pa.int64()) for c in ([p.start for p in pieces], [p.length for p in pieces], crc, lengths[at])],
        *[pa.array(c, pa.int64()) for c in ([first + p.sequence for p in pieces], [p.offset for p in pieces])],
    ]
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays(columns, names)


def packed_examples(
    df: DataFrame, id_col: str, tokens_col: str, loss_col: str, limits: Limits = Limits(segments=64)
) -> DataFrame:
    """Instruction examples, kept whole: the columns id, tokens, loss, sequence_id, segment, offset.

    Null counts are zero. An example beyond a limit by itself has a sequence of its own.
    """

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                tokens, loss = (np.array(c.fill_null(0).to_pylist(), np.int64) for c in part.columns[1:])
                pieces = place(tokens, loss, limits, cut=False)
                segment: dict[int, int] = {}
                order = [segment[p.sequence] for p in pieces if not segment.update({p.sequence: segment.get(p.sequence, -1) + 1})]
                at = np.array([p.row for p in pieces], np.int64)
                numbers = [tokens[at], loss[at], [first + p.sequence for p in pieces], order, [p.offset for p in pieces]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), *[pa.array(n, pa.int64()) for n in numbers]],
                    ["id", "tokens", "loss", "sequence_id", "segment", "offset"],
                )
                first += 1 + max((p.sequence for p in pieces), default=-1)

    kind = dict(df.dtypes)[id_col]
    return df.select(
        df[id_col].alias("id"), df[tokens_col].cast("long").alias("tokens"), df[loss_col].cast("long").alias("loss")
    ).mapInArrow(run, f"id {kind}, tokens long, loss long, sequence_id long, segment long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = str(public_tokenizers.path(VOCABULARY))
    return packed_documents(read_table(spark, sf_dir, "documents"), "doc_id", "text", path).withColumnRenamed("id", "doc_id")
