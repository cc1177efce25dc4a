"""Token ids in compressed files that can be read in parallel.

Documents are encoded once and written as an intermediate table with counts of the ids; their sum over all
documents gives the shared frequency table. The documents are then put in ascending order of id by
a range shuffle of the ids (not the texts), cut into blocks at document ends, and each block is
coded on its own. A file set is a folder with

* ``table``: id and scaled frequency of every token that occurs,
* ``blocks``: file, block, first_token (ids of the file before it), n_tokens, the documents' ids
  and lengths, the coded ``payload`` (see ``rans``: header, checkpoints, stream, checksum).

Spark writes both, so tasks that are run again leave no half-written files. Reading decodes each
block by itself; only the number of tokens of each file is gathered, one row per file.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm import rans
from mercata.llm.common import partitions, read_table
from mercata.llm.word_ids import VOCABULARY, word_ids
from mercata.session import cut_lineage, scratch_path

BLOCK_TOKENS = 1 << 20
SYMBOLS = 1 << 16


def tokenised(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """id, n (tokens) and the ids (16 bits each) of every row; a null text has the end id alone.
    The first row of each batch also has how often each id occurs in the batch (``counts``)."""
    kinds = pa.list_(pa.struct([("symbol", pa.int32()), ("n", pa.int64())]))

    def run(batches):
        words = word_ids(path)
        for batch in batches:
            rows = list(words.with_end([t or "" for t in batch.column(1).to_pylist()]))
            if not rows:
                continue
            flat, lengths = np.concatenate(rows), np.array([*map(len, rows)], np.int64)
            n = np.bincount(flat, minlength=SYMBOLS)
            seen = np.flatnonzero(n)
            pairs = pa.StructArray.from_arrays([pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64())], ["symbol", "n"])
            ends = pa.array([0, *[len(seen)] * len(rows)], pa.int32())
            counts = pa.ListArray.from_arrays(ends, pairs, mask=pa.array([i > 0 for i in range(len(rows))])).cast(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths), _packed(flat, lengths), counts],
                ["id", "n", "ids", "counts"],
            )

    kind = dict(df.dtypes)[id_col]
    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n long, ids binary, counts array<struct<symbol: int, n: long>>"
    )


def _packed(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column of ids, two bytes each; the ids are not copied."""
    ends = np.concatenate([[0], np.cumsum(2 * lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(flat.astype("<u2"))])


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    if not len(column):
        return []
    _, ends, data = column.cast(pa.large_binary()).buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view("<u2")
    return np.split(flat, (ends[1:-1] - ends[0]) // 2)


def frequencies(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs, from the counts that ``tokenised`` keeps; bounded by the vocabulary."""

    def run(batches):
        counts = np.zeros(SYMBOLS, np.int64)
        for batch in batches:
            for part in batch.column(0):
                symbols, n = (part.values.field(i).to_numpy() for i in range(2))
                counts[symbols] += n
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())], ["symbol", "n"])

    total = np.zeros(SYMBOLS, np.int64)
    kept = tokens.select("counts").where("counts IS NOT NULL")
    sums = kept.mapInArrow(run, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    for row in sums.collect():
        total[row["symbol"]] = row["n"]
    return total


def write_tokens(tokens: DataFrame, path: str) -> None:
    """The rows of ``tokenised`` as a file set; rows of equal id are ordered by their ids."""
    spark = tokens.sparkSession
    table = rans.Table.of_counts(frequencies(tokens))
    freq = table.freq
    spark.createDataFrame(
        [(int(s), int(freq[s])) for s in np.flatnonzero(freq)], "symbol int, freq long"
    ).coalesce(1).write.parquet(f"{path}/table")
    id_kind = dict(tokens.dtypes)["id"]

    def run(batches):
        coder = rans.Table(freq)
        file, block, first = TaskContext.get().partitionId(), 0, 0
        ids: list[pa.Array] = []
        rows: list[np.ndarray] = []
        held = 0

        def written():
            flat = np.concatenate(rows)
            keys = pa.concat_arrays(ids)
            lengths = pa.array([*map(len, rows)], pa.int64())
            ends = pa.array([0, len(rows)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    *[pa.array([v], pa.int64()) for v in (file, block, first, len(flat))],
                    pa.ListArray.from_arrays(ends, keys),
                    pa.ListArray.from_arrays(ends, lengths),
                    pa.array([rans.encode(flat, coder)], pa.binary()),
                ],
                ["file", "block", "first_token", "n_tokens", "ids", "lengths", "payload"],
            )

        for batch in batches:
            taken = 0
            for i, row in enumerate(_unpacked(batch.column(1))):
                rows.append(row)
                held += len(row)
                if held >= BLOCK_TOKENS:
                    ids.append(batch.column(0).slice(taken, i + 1 - taken))
                    yield written()
                    block, first, taken = block + 1, first + held, i + 1
                    ids, rows, held = [], [], 0
            ids.append(batch.column(0).slice(taken))
        if rows:
            yield written()

    # Range limits also on the content, so that many rows of one id do not meet in one task.
    order = [F.col("id").asc_nulls_first(), F.col("n"), F.xxhash64("ids"), F.col("ids")]
    ordered = tokens.drop("counts").repartitionByRange(partitions(tokens), *order[:3]).sortWithinPartitions(*order)
    schema = f"file long, block long, first_token long, n_tokens long, ids array<{id_kind}>, lengths array<long>, payload binary"
    ordered.select("id", "ids").mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """One row per document, decoded from the files: id, start (ids of all documents before it in
    the set), n_tokens, ids_crc32 and, unless left out, ``ids``."""
    blocks = spark.read.parquet(f"{path}/blocks")
    freq = np.zeros(SYMBOLS, np.uint64)
    for row in spark.read.parquet(f"{path}/table").collect():  # bounded by the vocabulary
        freq[row["symbol"]] = row["freq"]
    sizes = {r["file"]: r["n"] for r in blocks.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect()}
    before, total = {}, 0
    for file in sorted(sizes):
        before[file] = total
        total += sizes[file]
    id_kind = dict(blocks.dtypes)["ids"].removeprefix("array<")[:-1]
    raw = freq.tobytes()

    def run(batches):
        table, slots = _reader(raw)
        for batch in batches:
            for i in range(batch.num_rows):
                file, first, keys, lengths, payload = (batch.column(k)[i] for k in range(5))
                tokens = rans.decode(payload.as_py(), table, slots)
                lengths = np.asarray(lengths.values, np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw_ids = tokens.astype("<u4")
                crc = [zlib.crc32(raw_ids[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]
                columns = [
                    keys.values,
                    pa.array(before[file.as_py()] + first.as_py() + starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    bounds = pa.array(np.concatenate([[0], ends]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(tokens.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    schema = f"id {id_kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return blocks.select("file", "first_token", "ids", "lengths", "payload").mapInArrow(run, schema)


@lru_cache(maxsize=2)
def _reader(raw: bytes) -> tuple[rans.Table, np.ndarray]:
    table = rans.Table(np.frombuffer(raw, np.uint64))
    return table, table.slots()


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = str(public_tokenizers.path(VOCABULARY))
    tokens = cut_lineage(tokenised(read_table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary), "tokens")
    path = scratch_path(spark, "token-files")
    write_tokens(tokens, path)
    return read_tokens(spark, path, with_ids=False).withColumnRenamed("id", "doc_id")
