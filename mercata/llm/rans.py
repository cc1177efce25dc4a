"""Static range asymmetric numeral system over token ids, many interleaved lanes at a time.

Frequencies are scaled to ``2 ** BITS``. Token ``t`` of a block belongs to lane ``t % lanes``; all
lanes take a step together, so a block is coded by array operations. States lie in
[2**31, 2**63) and move 32 bits at a time to one stream. Every ``every`` steps a checkpoint keeps
all states and the place in the stream: a reader starts at any of them, and ``decode`` runs all
stretches between checkpoints side by side.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

BITS = 20
LOW = np.uint64(1 << 31)
LANES, EVERY = 1024, 256
MAGIC = b"RTOK"
HEAD = struct.Struct("<4sHHIIIII")  # magic, version, bits, lanes, steps between checkpoints, tokens, words, table checksum


@dataclass(frozen=True)
class Table:
    """Frequencies that sum to ``2 ** BITS``; symbols that never occur have none."""

    freq: np.ndarray

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> "Table":
        counts = np.asarray(counts, np.int64)
        total = int(counts.sum())
        if not total:
            return cls(np.zeros(len(counts), np.uint64))
        scaled = np.where(counts > 0, np.maximum(1, counts * (1 << BITS) // total), 0)
        # What rounding leaves over or takes too much is settled among the most frequent symbols.
        spare = (1 << BITS) - int(scaled.sum())
        for s in np.argsort(-scaled, kind="stable"):
            if not spare:
                break
            step = spare if spare > 0 else max(spare, 1 - int(scaled[s]))
            scaled[s] += step
            spare -= step
        return cls(scaled.astype(np.uint64))

    @property
    def start(self) -> np.ndarray:
        return (np.cumsum(self.freq) - self.freq).astype(np.uint64)

    def slots(self) -> np.ndarray:
        """The symbol of each of the ``2 ** BITS`` slots."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))

    def checksum(self) -> int:
        return zlib.crc32(self.freq.astype("<u4").tobytes())


def encode(tokens: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    """One block. Its checksum covers all that stands before it."""
    n = len(tokens)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    freq, start = table.freq, table.start
    bits, low32 = np.uint64(BITS), np.uint64(0xFFFFFFFF)
    state = np.full(lanes, LOW)
    chunks: list[np.ndarray] = []
    checkpoints: list[tuple[np.ndarray, int]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        symbols = tokens[step * lanes : (step + 1) * lanes]
        active = state[: len(symbols)]
        f = freq[symbols]
        over = active >= f << np.uint64(63 - BITS)
        if over.any():
            chunks.append((active[over] & low32).astype("<u4"))
            written += len(chunks[-1])
            active = np.where(over, active >> np.uint64(32), active)
        whole, rest = np.divmod(active, f)
        state[: len(symbols)] = (whole << bits) + rest + start[symbols]
        if step % every == 0:
            checkpoints.append((state.copy(), written))
    words = np.concatenate(chunks[::-1]) if chunks else np.empty(0, "<u4")
    head = HEAD.pack(MAGIC, 1, BITS, lanes, every, n, len(words), table.checksum())
    states = [s.astype("<u8").tobytes() + struct.pack("<I", len(words) - at) for s, at in checkpoints[::-1]]
    body = head + b"".join(states) + words.tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, slots: np.ndarray | None = None) -> np.ndarray:
    """The block's tokens; raises ValueError if the block or the table is not what was written."""
    if len(block) < HEAD.size + 4 or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("block checksum differs")
    magic, version, bits, lanes, every, n, n_words, table_sum = HEAD.unpack_from(block)
    if (magic, version, bits) != (MAGIC, 1, BITS) or table_sum != table.checksum():
        raise ValueError("block of another format or frequency table")
    if not n:
        return np.empty(0, np.uint32)
    steps = -(-n // lanes)
    count = -(-steps // every)
    kind = np.dtype([("state", "<u8", (lanes,)), ("at", "<u4")])
    checkpoints = np.frombuffer(block, kind, count, HEAD.size)
    words = np.frombuffer(block, "<u4", n_words, HEAD.size + count * kind.itemsize)
    slots = table.slots() if slots is None else slots
    freq, start, mask = table.freq, table.start, np.uint64((1 << BITS) - 1)
    state = checkpoints["state"].astype(np.uint64)
    at = checkpoints["at"].astype(np.int64)
    out = np.zeros((count, every, lanes), np.uint32)
    # Only the last stretch can be short: of its steps, and of the lanes in its last step.
    last_steps = steps - (count - 1) * every
    for step in range(min(every, steps)):
        rows = count if step < last_steps else count - 1
        if not rows:
            break
        own = state[:rows]
        slot = own & mask
        symbols = slots[slot]
        out[:rows, step] = symbols
        own = freq[symbols] * (own >> np.uint64(BITS)) + slot - start[symbols]
        if rows == count and step == last_steps - 1 and n % lanes:
            own[-1, n % lanes :] = LOW  # lanes without a token in the last step
        need = own < LOW
        got = need.sum(1)
        place = at[:rows, None] + np.cumsum(need, 1) - 1
        own[need] = (own[need] << np.uint64(32)) | words[place[need]].astype(np.uint64)
        at[:rows] += got
        state[:rows] = own
    return out.reshape(-1)[:n]
