"""Vector code compression: product codes by whole-number k-means with adaptive distance bounds.

Components become integers, vectors are cut into equal consecutive parts, and every part position has
a codebook of its own. Between rounds each part keeps, in its row of a written table, its ``b`` closest
entries in order, a lower bound on the distance to each of them, and one outer bound on the distance to all
entries beyond. When the codebooks have moved, every bound shrinks by how far its entry moved, the
outer one by the farthest move of all. A part whose exact distance to its entry is below all its bounds keeps
the entry without looking at any other. Otherwise the entries up to the last bound that was reached are compared
by exact integers, ties to the lower index, and if the outer bound was reached all entries are. The
bounds are kept in half precision and always rounded down, so a doubtful case is compared, never decided. ``b`` starts
at a quarter of the entries and falls to the longest list a round had to look at, an eighth at least.

Rows stay where they are: a round is one pass that writes codes and bounds, and one that adds up, per part and
entry, the integers of the rows that took it (one row per task and entry, summed by Spark). The codebooks, entries
times components, are all that meets on the driver.

Odd rows: vectors that are null or hold null or non-finite components take no part. Shorter vectors count
as filled up with zeros to the longest one's length, and that is rounded up to a multiple of the parts. Components
beyond ``LIMIT`` count as the limit, so squared distances fit in 64 bits. The start takes the first rows by id, then by
vector; repeated rows count as often as they come, rows without an id come last. Fewer rows than entries give as many
entries as rows. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.common import read_table
from mercata.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 27
CHUNK = 1 << 11  # rows compared at a time
STATE = "values binary, code binary, error long, near binary, low binary, outer binary, listed int, whole int"


@dataclass(frozen=True)
class Bounds:
    """What rows know about their distances: ``near`` (rows, parts, b), its lower bounds, and the outer bound."""

    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label and vector (array<double>) of the rows that take part."""
    rows = df.select(
        df[id_col].alias("id"), df[label_col].alias("label"), df[vector_col].cast("array<double>").alias("vector")
    )
    return rows.where("vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")


def whole_numbers(vectors: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """Floors of the scaled components as rows of ``width`` integers."""
    lengths = np.asarray(vectors.value_lengths(), np.int64)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    out = np.zeros((len(lengths), width), np.int64)
    at = np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[at] = np.clip(flat, -LIMIT, LIMIT)
    return out


def distances(values: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Squared distances (rows, parts, entries) between ``values`` (rows, parts, d) and ``books`` (parts, entries, d)."""
    gaps = values[:, :, None, :] - books[None]
    return np.einsum("npkd,npkd->npk", gaps, gaps)


def downward(bounds: np.ndarray) -> np.ndarray:
    """Half-precision numbers that are at most ``bounds``; below zero a bound says nothing, so zero will do."""
    clipped = np.clip(bounds, 0, 65504)
    half = clipped.astype(np.float16)
    return np.where(half.astype(float) > clipped, np.nextafter(half, np.float16(0)), half)


def compared(values: np.ndarray, books: np.ndarray, b: int) -> tuple[np.ndarray, Bounds]:
    """All entries compared: exact squared distance to the closest, and bounds for the ``b`` closest."""
    exact = distances(values, books)
    order = np.argsort(exact, axis=2, kind="stable")[:, :, : b + 1]
    near = np.take_along_axis(exact, order, 2)
    low = np.sqrt(near.astype(float)) * (1 - 1e-12)
    outer = low[:, :, b] if order.shape[2] > b else np.full(low.shape[:2], 65504.0)
    return near[:, :, 0], Bounds(order[:, :, :b].astype(np.uint16), downward(low[:, :, :b]), downward(outer))


def moved(values: np.ndarray, books: np.ndarray, steps: np.ndarray, old: Bounds, b: int) -> tuple[np.ndarray, Bounds, np.ndarray, np.ndarray]:
    """The assignment after each entry moved by at most ``steps`` (parts, entries).

    Returns the exact squared distances, the new bounds cut to ``b`` entries, the length of the list that each row
    had to look at in any part (0 if none), and how many of its parts were compared with all entries.
    """
    parts = np.arange(books.shape[0])[None, :]
    near, low = old.near.copy(), old.low.astype(float) - steps[parts[:, :, None], old.near]
    outer = old.outer.astype(float) - steps.max(1)[None]
    gaps = values - books[parts, near[:, :, 0]]
    exact = np.einsum("npd,npd->np", gaps, gaps)
    upper = np.sqrt(exact.astype(float)) * (1 + 1e-12)
    reached = low <= upper[:, :, None]
    reached[:, :, 0] = False
    width = near.shape[2]
    last = np.where(reached.any(2), width - np.argmax(reached[:, :, ::-1], 2), 0)
    everything = outer <= upper if width < books.shape[1] else np.zeros_like(exact, bool)
    low[:, :, 0] = upper * (1 - 1e-11)

    for n in np.unique(last[~everything]):
        if n < 2:
            continue
        row, part = np.nonzero((last == n) & ~everything)
        own = near[row, part, :n].astype(np.int64)
        gaps = values[row, part][:, None] - books[part[:, None], own]
        found = np.einsum("nkd,nkd->nk", gaps, gaps)
        order = np.lexsort((own, found), axis=1)
        found = np.take_along_axis(found, order, 1)
        near[row, part, :n] = np.take_along_axis(own, order, 1)
        low[row, part, :n] = np.sqrt(found.astype(float)) * (1 - 1e-12)
        exact[row, part] = found[:, 0]
    if b < width:
        outer = np.minimum(outer, low[:, :, b:].min(2))
    near, low = near[:, :, :b], downward(low[:, :, :b])
    outer = downward(outer)
    for part in np.flatnonzero(everything.any(0)):
        row = np.flatnonzero(everything[:, part])
        least, fresh = compared(values[row, part][:, None], books[part : part + 1], b)
        exact[row, part] = least[:, 0]
        near[row, part], low[row, part], outer[row, part] = fresh.near[:, 0], fresh.low[:, 0], fresh.outer[:, 0]
    listed = np.where(everything, 0, last).max(1)
    return exact, Bounds(near, low, outer), listed, everything.sum(1)


def _rows(values: np.ndarray, exact: np.ndarray, bounds: Bounds, listed: np.ndarray, whole: np.ndarray) -> list[pa.Array]:
    def packed(x: np.ndarray, kind: str) -> pa.Array:
        return pa.array([row.tobytes() for row in np.ascontiguousarray(x.reshape(len(x), -1).astype(kind))], pa.binary())

    return [
        packed(values, "<i4"),
        packed(bounds.near[:, :, 0], "<u2"),
        pa.array(exact.sum(1), pa.int64()),
        packed(bounds.near, "<u2"),
        packed(bounds.low, "<f2"),
        packed(bounds.outer, "<f2"),
        pa.array(listed, pa.int32()),
        pa.array(whole, pa.int32()),
    ]


def _matrix(column: pa.Array, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, *shape)


class Coder:
    """One collection's codebooks and how to bring them up to date; ``state`` holds the rows."""

    def __init__(self, rows: DataFrame, parts: int, entries: int, scale: int = SCALE):
        self.spark, self.parts, self.scale = rows.sparkSession, parts, scale
        first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries)  # bounded by the codebook
        start = [r["vector"] for r in first.select("vector").collect()]
        longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
        self.width = -(-max(longest, 1) // parts) * parts
        numbers = whole_numbers(pa.array(start, pa.list_(pa.float64())), self.width, scale)
        self.books = numbers.reshape(len(start), parts, self.width // parts).transpose(1, 0, 2)
        self.rows, self.state, self.steps, self.passes = rows, None, None, 0
        self.least = max(1, -(-entries // 8))
        self.b = self.next_b = min(max(1, entries // 4), max(len(start), 1))

    def assign(self) -> None:
        """One pass over all rows: codes, errors and bounds under the present codebooks."""
        books, steps, b, parts, width, scale = self.books, self.steps, self.next_b, self.parts, self.width, self.scale
        old_b = self.b

        def first(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(i, CHUNK)
                    values = whole_numbers(part.column(2), width, scale).reshape(part.num_rows, parts, -1)
                    exact, bounds = compared(values, books, b)
                    none = np.zeros(part.num_rows, np.int32)
                    yield out(part, _rows(values, exact, bounds, none, none))

        def again(batches):
            for batch in batches:
                for i in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(i, CHUNK)
                    values = _matrix(part.column(2), "<i4", parts, width // parts).astype(np.int64)
                    shape = (parts, old_b)
                    old = Bounds(
                        _matrix(part.column(3), "<u2", *shape), _matrix(part.column(4), "<f2", *shape), _matrix(part.column(5), "<f2", parts)
                    )
                    yield out(part, _rows(values, *moved(values, books, steps, old, b)))

        def out(part: pa.RecordBatch, made: list[pa.Array]) -> pa.RecordBatch:
            names = ["id", "label", "values", "code", "error", "near", "low", "outer", "listed", "whole"]
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], names)

        kinds = dict(self.rows.dtypes)
        schema = f"id {kinds['id']}, label {kinds['label']}, {STATE}"
        if self.state is None:
            found = self.rows.mapInArrow(first, schema)
        else:
            found = self.state.select("id", "label", "values", "near", "low", "outer").mapInArrow(again, schema)
        self.state, self.b = cut_lineage(found, "vector-codes"), b
        self.passes += 1

    def move(self) -> None:
        """Each entry becomes the floor of its parts' mean; entries that no part took stay."""
        parts, k, d = self.books.shape

        def sums(batches):
            n = np.zeros((parts, k), np.int64)
            total = np.zeros((parts, k, d), object)
            for batch in batches:
                if not batch.num_rows:
                    continue
                values = _matrix(batch.column(0), "<i4", parts, d).astype(np.int64)
                code = _matrix(batch.column(1), "<u2", parts).astype(np.int64)
                for p in range(parts):
                    n[p] += np.bincount(code[:, p], minlength=k)
                    added = np.zeros((k, d), np.int64)
                    np.add.at(added, code[:, p], values[:, p])
                    total[p] += added
            part, entry = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    pa.array(entry, pa.int32()),
                    pa.array(n[part, entry], pa.int64()),
                    pa.array(total[part, entry].tolist(), pa.list_(pa.int64())),
                ],
                ["part", "entry", "n", "total"],
            )

        found = self.state.select("values", "code").mapInArrow(sums, "part int, entry int, n long, total array<long>")
        added = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]
        books = self.books.copy()
        for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():  # one row per entry
            books[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(d)]
        gaps = books - self.books
        self.steps = np.sqrt((gaps * gaps).sum(2).astype(float)) * (1 + 1e-12)
        self.books = books
        if self.passes > 1:  # the first pass compares everything, so it says nothing about lists
            longest = self.state.agg(F.max("listed")).first()[0] or 0
            self.next_b = min(self.b, max(self.least, int(longest)))


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def coded(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """id, label, code (two little-endian bytes per part) and error of each usable row, with how its last assignment
    went (``listed``: the longest list looked at, ``whole``: parts compared with all entries), and the codebooks
    (parts, entries, components). At most 65,536 entries."""
    coder = Coder(usable(df, id_col, vector_col, label_col), parts, entries, scale)
    if not coder.books.shape[1]:
        kinds = dict(coder.rows.dtypes)
        empty = f"id {kinds['id']}, label {kinds['label']}, code binary, error long, listed int, whole int"
        return df.sparkSession.createDataFrame([], empty), coder.books
    coder.assign()
    for _ in range(rounds):
        coder.move()
        coder.assign()
    return coder.state.select("id", "label", "code", "error", "listed", "whole"), coder.books


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = coded(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    # Entries are below 256, so the low byte of each pair is the index.
    code = F.lower(F.regexp_replace(F.hex("code"), "(..)..", "$1"))
    joined = rows.join(by_label.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same by plain comparison of every part with every entry."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""ranked{k} as (select p.vec_id, p.part, e.entry, list_sum(list_transform(list_zip(p.v, e.c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) as d
  from part_rows p join book{k} e using (part)),
near{k} as materialized (select vec_id, part, arg_min(entry, d::hugeint * 65536 + entry) as entry, min(d) as d from ranked{k} group by all)""")
        if k < rounds:
            steps.append(f"""mean{k} as (select part, entry, i, sum(v[i])::hugeint as s, count(*)::hugeint as n
  from near{k} join part_rows using (vec_id, part), width, range(1, w + 1) t(i) group by all),
new{k} as (select part, entry, list(((s - ((s % n) + n) % n) / n)::bigint order by i) as c from
  (select part, entry, i, s, n from mean{k}) group by all),
book{k + 1} as materialized (select part, entry, coalesce(n.c, b.c) as c from book{k} b left join new{k} n using (part, entry))""")
    return f"""with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
width as materialized (select max(len(v)) // {parts} as w from kept),
part_rows as materialized (select vec_id, p as part, v[p * w + 1 : (p + 1) * w] as v from kept, width, range({parts}) t(p)),
book0 as materialized (select part, row_number() over (partition by part order by vec_id) - 1 as entry, v as c
  from part_rows where vec_id in (select vec_id from kept order by vec_id limit {entries})),
{", ".join(steps)},
coded as (select vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' order by part) as code, sum(d)::bigint as error from near{rounds} group by all),
digest as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as h from book{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256
from coded join kept using (vec_id), digest"""


ORACLE = _oracle()
