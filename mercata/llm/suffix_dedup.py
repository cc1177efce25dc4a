"""Removal of passages that occurred before, by column-wise multi-document suffix sorting.

A byte goes if a string of ``LENGTH`` bytes over it also starts earlier. Two equal strings choose
the same anchor inside themselves (of their 32-byte grams the one with the least hash), so texts
are compared only around anchors that occur more than once:

1. texts are packed, straight from the scan, into blocks in a table bucketed by block; later joins with
   blocks read it in place, so texts are never shuffled;
2. every block lists its anchors, each with the run of strings that chose it; anchors are counted
   with map-side sums, and those that occur once go;
3. the pieces of text around the others are dealt to shards by anchor, one packed row per block
   and shard, and each shard is sorted as a collection: all pieces are aligned at their anchors, and one
   symbol of every piece is inserted each round, from the last column to the first. A round reads
   one column in sequence, which in the order of the suffixes is that column's part of the
   Burrows-Wheeler transform, and updates the order and the common prefixes of neighbours. Equal
   strings stand in the same column, so the columns' parts need not be merged, and a round costs one
   pass over the pieces instead of over the whole collection. Neighbours with a common prefix of
   ``LENGTH`` are equal strings; all but the first go;
4. the runs of strings that go are gathered by block, and each text is cut.

An anchor that occurs over ``HOT`` times is split into its single strings, which are dealt out by
their own hash (128 bits decide within a block): copies within a block are settled there, so a passage
in a third of all texts arrives once per block. The number of shards follows the number of repeated
anchors, so a shard holds about ``SHARD`` pieces at any size. The columns of a shard stay in memory;
nothing is put in a machine's own folders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import bucketed, fresh, give_back, partitions, ragged, read_table
from mercata.session import cut_lineage

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1  # grams in a string
HOT = 4096
SHARD = 32_768
BLOCK = 8 << 20
PART = 1 << 20
PLACE = np.uint64((1 << 24) - 1)
FIRST_ID = -(1 << 63)  # stands for a missing id
WIDTH = LENGTH + WINDOW - 1  # columns around an anchor


def hashed(data: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each substring of ``length`` bytes, put together from halves."""
    with np.errstate(over="ignore"):
        base = np.uint64(base)
        power, size = base, 1  # of base, for strings of size bytes
        of_size = data.astype(np.uint64) + np.uint64(1)
        out, done, n = None, 0, len(data) - length + 1
        rest = length
        while True:
            if rest & size:
                part = of_size[done : done + n]
                out = part if out is None else out * power + part
                done += size
                rest -= size
            if not rest:
                break
            of_size = of_size[:-size] * power + of_size[size:]
            power = power * power
            size *= 2
        out = out ^ (out >> np.uint64(29))
        out = out * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))


def anchors(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs of strings in the texts at ``starts`` that share an anchor.

    Returns the text's index, the run's start, the anchor's place (both in the text), the number of
    strings in the run, and the anchor's hash. Texts under ``LENGTH`` bytes have none.
    """
    counts = np.maximum(lengths - LENGTH + 1, 0)
    windows = ragged(np.arange(len(data)), starts, counts)
    if not len(windows):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    grams = hashed(data, GRAM)
    least = grams & ~PLACE | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= WINDOW:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: len(grams) - WINDOW + 1], least[WINDOW - size :])
    place = (least[windows] & PLACE).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)])
    first = np.flatnonzero(new)
    row = np.searchsorted(starts, windows[first], "right") - 1
    n = np.diff(np.append(first, len(windows)))
    return row, windows[first] - starts[row], place[first] - starts[row], n, grams[place[first]]


def packed(df: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """A table bucketed by ``block``: per text its id, the hash of its text, its length and the columns
    ``keep``, and all texts behind one another, compressed."""
    body = F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")
    texts = df.select(
        F.coalesce(df[id_col].cast("long"), F.lit(FIRST_ID)).alias("rid"),
        F.xxhash64(body).alias("th"),
        body.alias("body"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]).alias("row"),
    )
    row_kind = texts.schema["row"].dataType.simpleString()

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            bodies = batch.column(2).to_pylist()
            first = size = 0
            for i, b in enumerate(bodies):
                size += len(b)
                if size >= BLOCK or i == len(bodies) - 1:
                    ends = pa.array([0, i + 1 - first], pa.int32())
                    lengths = pa.array([*map(len, bodies[first : i + 1])], pa.int64())
                    lists = [c.slice(first, i + 1 - first) for c in (batch.column(0), batch.column(1), batch.column(3))]
                    columns = [pa.ListArray.from_arrays(ends, c) for c in (*lists, lengths)]
                    blob = pack.compress(b"".join(bodies[first : i + 1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), *columns, pa.array([blob], pa.binary())],
                        ["block", "rids", "ths", "rows", "lengths", "texts"],
                    )
                    block, first, size = block + 1, i + 1, 0

    schema = f"block long, rids array<long>, ths array<long>, rows array<{row_kind}>, lengths array<long>, texts binary"
    return bucketed(texts.mapInArrow(run, schema), "block", "dedup_blocks")


def _texts(lengths, blob) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes, and the starts and lengths of its texts."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), np.uint8)
    sizes = lengths.values.to_numpy()
    return data, np.cumsum(sizes) - sizes, sizes


def stretches(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a block of about ``PART`` bytes: where it starts, and its texts' starts in it and
    lengths. A text above that is cut into parts that overlap by a string."""
    first = 0
    while first < len(sizes):
        last, size = first, 0
        while last < len(sizes) and (last == first or size + sizes[last] <= PART):
            size += sizes[last]
            last += 1
        if size <= PART:
            yield int(starts[first]), starts[first:last] - starts[first], sizes[first:last]
        else:
            for base in range(0, int(size) - LENGTH + 1, PART):
                part = min(PART + LENGTH - 1, int(size) - base)
                yield int(starts[first]) + base, np.zeros(1, np.int64), np.array([part])
        first = last


def listed_anchors(blocks: DataFrame) -> DataFrame:
    """h (the anchor's hash), block and ``place``: the run's start in the block, the anchor and the
    number of strings, in one number."""

    def run(batches):
        for batch in batches:
            for block, lengths, blob in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                data, starts, sizes = _texts(lengths, blob)
                for base, own, part in stretches(starts, sizes):
                    at, start, anchor, n, h = anchors(data[base : base + int(own[-1] + part[-1])], own, part)
                    place = (base + own[at] + start) << 16 | (anchor - start) << 8 | n
                    columns = [h.view(np.int64), np.full(len(h), block), place]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "block", "place"])

    return blocks.select("block", "lengths", "texts").mapInArrow(run, "h long, block long, place long")


class Pieces:
    """Pieces of text and where they are from: text of the block, start in it, lead, strings."""

    FIELDS = (("doc", np.int32), ("start", np.int64), ("lead", np.uint8), ("n", np.uint8))

    def __init__(self, doc, start, lead, n, data):
        self.doc, self.start, self.lead, self.n, self.data = doc, start, lead, n, data

    def pack(self, rids: np.ndarray, ths: np.ndarray) -> bytes:
        """With the id and hash of each text that has a piece."""
        docs, ref = np.unique(self.doc, return_inverse=True)
        parts = [np.array([len(docs), len(ref)], np.int64), docs.astype(np.int32), rids[docs], ths[docs]]
        parts += [ref.astype(np.int32), self.start.astype(np.int64), self.lead.astype(np.uint8), self.n.astype(np.uint8), self.data]
        return zstandard.ZstdCompressor(level=3).compress(b"".join(p.tobytes() for p in parts))

    @staticmethod
    def unpack(blob: bytes) -> tuple:
        """doc, rid, th, start, lead and n of each piece, and the bytes."""
        raw = zstandard.ZstdDecompressor().decompress(blob)
        d, m = np.frombuffer(raw, np.int64, 2)
        at, out = 16, []
        for kind, count in ((np.int32, d), (np.int64, d), (np.int64, d), (np.int32, m), (np.int64, m), (np.uint8, m), (np.uint8, m)):
            out.append(np.frombuffer(raw, kind, count, at))
            at += out[-1].nbytes
        docs, rids, ths, ref, start, lead, n = out
        return docs[ref], rids[ref], ths[ref], start, lead.astype(np.int64), n.astype(np.int64), np.frombuffer(raw, np.uint8, offset=at)


def pack_runs(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """Runs of strings that go: text of the block, first string and end of the strings."""
    parts = (doc.astype(np.int32), start.astype(np.int64), (end - start).astype(np.int32))
    return zstandard.ZstdCompressor(level=3).compress(b"".join(p.tobytes() for p in parts))


def unpack_runs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    m = len(raw) // 16
    start = np.frombuffer(raw, np.int64, m, 4 * m)
    return np.frombuffer(raw, np.int32, m), start, start + np.frombuffer(raw, np.int32, m, 12 * m)


def single_strings(data, pos, n, doc, order, start) -> tuple[np.ndarray, ...]:
    """The strings of hot runs: positions and hashes of those to send on, and positions of those
    that the block itself has earlier. ``order`` ranks texts, ``start`` is a text's place in the block."""
    sizes = n + LENGTH - 1
    joined = ragged(data, pos, sizes)
    at = ragged(np.arange(len(joined)), np.cumsum(sizes) - sizes, n)
    where = ragged(np.arange(int(pos.max(initial=0)) + WINDOW + 1), pos, n)
    whose = np.repeat(doc, n)
    hashes = [hashed(joined, LENGTH, base)[at] for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
    by = np.lexsort((where - start[whose], order[whose], hashes[1], hashes[0]))
    new = np.ones(len(by), bool)
    new[1:] = (hashes[0][by][1:] != hashes[0][by][:-1]) | (hashes[1][by][1:] != hashes[1][by][:-1])
    first = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    # A repeated row's own string is no earlier one.
    same = (order[whose[by]] == order[whose[first]]) & (where[by] - start[whose[by]] == where[first] - start[whose[first]])
    sent, told = by[same], by[~same]
    return where[sent], whose[sent], hashes[0][sent], where[told], whose[told]


def pieces(blocks: DataFrame, shards: int) -> DataFrame:
    """Blocks with their repeated anchors (``anchors``: place, shard, hot) to packed pieces by shard,
    and ``told``, packed runs that the block settled itself."""

    def run(batches):
        for batch in batches:
            for block, rids, ths, lengths, blob, own in zip(batch.column(0).to_pylist(), *batch.columns[1:], strict=True):
                data, starts, sizes = _texts(lengths, blob)
                rids, ths = rids.values.to_numpy(), ths.values.to_numpy()
                place, shard = (own.values.field(i).to_numpy() for i in range(2))
                hot = own.values.field(2).to_numpy(zero_copy_only=False)
                pos, lead, n = place >> 16, place >> 8 & 255, place & 255
                doc = np.searchsorted(starts, pos, "right") - 1
                sent = [pos[~hot]], [doc[~hot]], [lead[~hot]], [n[~hot]], [shard[~hot]]
                if hot.any():
                    by = np.lexsort((ths, rids))
                    order = np.empty(len(by), np.int64)
                    order[by] = np.cumsum(np.append(False, (rids[by][1:] != rids[by][:-1]) | (ths[by][1:] != ths[by][:-1])))
                    first, whose, h, told, told_doc = single_strings(data, pos[hot], n[hot], doc[hot], order, starts)
                    extra = first, whose, np.zeros(len(first)), np.ones(len(first)), (h % np.uint64(shards)).astype(np.int64)
                    for column, more in zip(sent, extra, strict=True):
                        column.append(more)
                    by = np.argsort(told, kind="stable")
                    told, told_doc = told[by], told_doc[by]
                    heads = np.flatnonzero(np.append(True, (told[1:] != told[:-1] + 1) | (told_doc[1:] != told_doc[:-1]))) if len(told) else told
                    ends = np.append(heads[1:], len(told)) - 1 if len(told) else told
                    at = told_doc[heads]
                    runs = pack_runs(at, told[heads] - starts[at], told[ends] + 1 - starts[at])
                    yield _shard_batch([block % shards], [block], [None], [runs])
                pos, doc, lead, n, shard = (np.concatenate(c).astype(np.int64) for c in sent)
                by = np.lexsort((pos, shard))
                heads = np.flatnonzero(np.append(True, shard[by][1:] != shard[by][:-1])) if len(by) else by
                blobs = []
                for rows in np.split(by, heads[1:]) if len(by) else []:
                    text = ragged(data, pos[rows], n[rows] + LENGTH - 1)
                    blobs.append(Pieces(doc[rows], pos[rows] - starts[doc[rows]], lead[rows], n[rows], text).pack(rids, ths))
                yield _shard_batch(shard[by][heads].tolist(), [block] * len(blobs), blobs, [None] * len(blobs))

    return blocks.select("block", "rids", "ths", "lengths", "texts", "anchors").mapInArrow(
        run, "shard long, block long, pieces binary, told binary"
    )


def _shard_batch(shard, block, blobs, told) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip((shard, block, blobs, told), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["shard", "block", "pieces", "told"])


def repeated(lead: np.ndarray, n: np.ndarray, data: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the strings of each piece also start earlier, as a table (piece, string).

    A piece has ``n`` strings and ``lead`` bytes before its anchor; ``data`` has the pieces' bytes.
    ``rank`` orders the pieces by where their anchors stand; equal ranks are the same place.
    """
    m, sizes = len(n), n + LENGTH - 1
    columns = np.zeros((WIDTH, m), np.uint8)  # 0 where a piece has no byte; no UTF-8 text has byte 255
    piece = np.repeat(np.arange(m), sizes)
    within = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    columns[within + (WINDOW - 1 - lead)[piece], piece] = data + 1
    order, common = np.arange(m), np.zeros(m + 1, np.int16)
    out = np.zeros((m, WINDOW), bool)
    never = np.int64(1) << 62
    for column in range(WIDTH - 1, -1, -1):
        symbols = columns[column][order]  # the transform's part for the suffixes one column on
        by_symbol = np.argsort(symbols, kind="stable")
        order, symbols = order[by_symbol], symbols[by_symbol]
        if m > 1:
            spans = np.empty(2 * m - 2, np.int64)
            spans[::2], spans[1::2] = by_symbol[:-1] + 1, by_symbol[1:] + 1
            least = np.minimum.reduceat(common, spans)[::2]
            common[1:m] = np.where(symbols[1:] == symbols[:-1], least + 1, 0)
        if column < WINDOW:
            string = column - (WINDOW - 1 - lead[order])
            real = (string >= 0) & (string < n[order])
            if real.any():
                ranks = np.where(real, rank[order], never)
                firsts = np.flatnonzero(np.concatenate([[True], common[1:m] < LENGTH]))
                least = np.repeat(np.minimum.reduceat(ranks, firsts), np.diff(np.append(firsts, m)))
                late = real & (ranks > least)
                out[order[late], string[late]] = True
    return out


def settled(block: np.ndarray, blobs: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Packed pieces of one shard to packed runs, by block."""
    parts = [Pieces.unpack(b) for b in blobs]
    doc, rid, th, start, lead, n, data = (np.concatenate(c) for c in zip(*parts, strict=True))
    block = np.repeat(block, [len(p[0]) for p in parts])
    anchor = start + lead
    order = np.lexsort((anchor, th, rid))
    a, b = order[:-1], order[1:]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.append(0, (rid[a] != rid[b]) | (th[a] != th[b]) | (anchor[a] != anchor[b])))
    late = np.pad(repeated(lead, n, data, rank), ((0, 0), (1, 1)))
    at, first = np.nonzero(late[:, 1:] & ~late[:, :-1])
    _, last = np.nonzero(late[:, :-1] & ~late[:, 1:])
    by = np.argsort(block[at], kind="stable")
    at, first, last = at[by], first[by], last[by]
    heads = np.flatnonzero(np.append(True, block[at][1:] != block[at][:-1])) if len(at) else at
    runs = [pack_runs(doc[at[r]], start[at[r]] + first[r], start[at[r]] + last[r]) for r in np.split(np.arange(len(at)), heads[1:])] if len(at) else []
    return block[at][heads].tolist(), runs


def removed_runs(rows: DataFrame) -> DataFrame:
    """Packed pieces by shard to packed runs (block, runs)."""

    def run(batches):
        give_back()
        for block, blobs, told in _whole_shards(batches):
            blocks, runs = settled(block, blobs) if blobs else ([], [])
            blocks, runs = blocks + [b for b, _ in told], runs + [r for _, r in told]
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(runs, pa.binary())], ["block", "runs"])

    spread = rows.repartition(partitions(rows), "shard").sortWithinPartitions("shard")
    return spread.mapInArrow(run, "block long, runs binary")


def _whole_shards(batches) -> Iterator[tuple[np.ndarray, list[bytes], list[tuple[int, bytes]]]]:
    """The rows of each shard; they come in order of shard."""
    blocks: list[int] = []
    blobs: list[bytes] = []
    told: list[tuple[int, bytes]] = []
    current = None
    for batch in batches:
        for shard, block, blob, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard != current and (blobs or told):
                yield np.array(blocks, np.int64), blobs, told
                blocks, blobs, told = [], [], []
            current = shard
            if blob is None:
                told.append((block, runs))
            else:
                blocks.append(block)
                blobs.append(blob)
    if blobs or told:
        yield np.array(blocks, np.int64), blobs, told


def covered(first: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which bytes of a text lie in a string that starts in one of the runs."""
    steps = np.bincount(first, minlength=size + 1) - np.bincount(end - 1 + LENGTH, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def whole_characters(text: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` with the other bytes of each UTF-8 character that it cuts in two."""
    firsts = np.flatnonzero(np.concatenate([[True], (text[1:] & 0xC0) != 0x80]))
    return np.repeat(np.logical_or.reduceat(gone, firsts), np.diff(np.append(firsts, len(text))))


def cut_texts(blocks: DataFrame, whole: bool = False) -> DataFrame:
    """Blocks with their packed runs (``found``, null for none) to the columns row, n_bytes, n_removed,
    n_spans and ``kept`` (the bytes that stay; with ``whole``, without what is left of characters cut in two) of each text."""
    row_kind = blocks.schema["rows"].dataType.elementType.simpleString()

    def run(batches):
        give_back()
        for batch in batches:
            for rows, lengths, blob, found in zip(*batch.columns, strict=True):
                data, starts, sizes = _texts(lengths, blob)
                runs = [unpack_runs(r) for r in found.as_py() or []] or [(np.empty(0, np.int64),) * 3]
                doc, first, end = (np.concatenate(c) for c in zip(*runs, strict=True))
                by = np.argsort(doc, kind="stable")
                bounds = np.searchsorted(doc[by], np.arange(len(sizes) + 1))
                removed, spans, kept = [], [], []
                for k, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                    own, text = by[bounds[k] : bounds[k + 1]], data[start : start + size]
                    gone = covered(first[own], end[own], size) if len(own) else np.zeros(size, bool)
                    removed.append(int(gone.sum()))
                    spans.append(int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum()))
                    if whole and removed[-1]:
                        gone = whole_characters(text, gone)
                    kept.append((text[~gone] if removed[-1] else text).tobytes())
                numbers = [pa.array(c, pa.int64()) for c in (sizes, removed, spans)]
                columns = [rows.values, *numbers, pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = f"row {row_kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    return blocks.select("rows", "lengths", "texts", "found").mapInArrow(run, schema)


def without_repeats(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None, *, whole: bool = False) -> DataFrame:
    """The columns ``keep`` (all, unless given) and a last struct column with n_bytes, n_removed,
    n_spans and ``kept``, named ``deduplicated`` (with underscores after it, if need be).

    With ``whole``, what is left of a character that was cut in two is not in ``kept`` either; the numbers stay.

    Texts are ordered by id, a missing id first, then by a hash of the text. A null text is empty.
    Rows equal in id and text are one text: none is earlier than the other, and both get one result.
    """
    columns = df.columns if keep is None else keep
    out = fresh(df, "deduplicated")
    blocks = packed(df, id_col, text_col, columns)
    listed = listed_anchors(blocks)
    often = cut_lineage(listed.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "anchors")
    total = often.agg(F.sum("c")).first()[0] or 0
    shards = max(4 * partitions(df), -(-total // SHARD))
    own = F.struct("place", F.pmod("h", F.lit(shards)).alias("shard"), (F.col("c") > HOT).alias("hot"))
    repeats = listed.join(often, "h").select("block", own.alias("anchor"))
    repeats = repeats.groupBy("block").agg(F.collect_list("anchor").alias("anchors"))
    found = removed_runs(pieces(blocks.join(repeats, "block"), shards))
    found = found.groupBy("block").agg(F.collect_list("runs").alias("found"))
    done = cut_texts(blocks.join(found, "block", "left"), whole)
    made = F.struct("n_bytes", "n_removed", "n_spans", "kept").alias(out)
    return done.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)], made)


def query(spark, sf_dir: str) -> DataFrame:
    rows = without_repeats(read_table(spark, sf_dir, "documents"), "doc_id", "text", ["doc_id"])
    cut = F.col(rows.columns[-1])
    return rows.select(
        "doc_id", *[cut[c].alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.sha2(cut["kept"], 256).alias("kept_sha256")
    )
