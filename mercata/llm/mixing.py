"""Mixing sources to target weights by subset sums over document lengths.

Every source gets a target number of words. A source whose target is at least its size is taken whole as often as that
goes; what is left of the target is a budget for one more copy of some documents, and it is met by document lengths alone:

1. documents are counted by source and exact length;
2. of each length the budget's share is taken, rounded down, then one more of each length, longest first, until
   what is left is at most ``WINDOW`` words or no length fits;
3. bounded-knapsack dynamic programming over the documents still free fits the rest: all sums up to twice the rest are
   marked in one long integer, which is shifted by each length, and the sum nearest to the rest is traced back;
4. of each length as many documents as were chosen are selected in the order of a seeded hash of their ids.

In Spark: words are counted in one pass that keeps ids, sources and sizes only. The counts by length, at most as many as the
square root of twice a source's words, are fitted by one task per source. A source and length with many documents is dealt out
by ranges of the hash to bins of about ``BIN_ROWS``; counts of the bins say how many each gives, so no group is put in
order by one task. Targets are found by rounds of sums over one row per source.

Odd rows: a null text has no words; documents without words are never taken. Rows without a source are a source of
their own, the last. Repeated rows count as often as they come; rows without an id, or of one id, source and size, are
interchangeable. An empty table gives an empty result; without any words all targets are zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercata.llm.common import read_table
from mercata.operators.ordering import with_global_order
from mercata.session import cut_lineage

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
SEED = 20_260_101
WINDOW = 1 << 15  # words that the dynamic programme fits, unless single documents are longer
BIN_ROWS = 10_000
BYTES = 1 << 22  # of text looked at together

GAPS = np.zeros(256, bool)
GAPS[[0x20, *range(0x09, 0x0E)]] = True


# -- sizes --------------------------------------------------------------------------------


def word_counts(column: pa.Array) -> np.ndarray:
    """The number of words of each text: runs of anything but ASCII white space."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    counts = np.zeros(len(column), np.int64)
    if len(column) == 0 or offsets[0] == offsets[-1]:
        return counts
    data = np.frombuffer(data, np.uint8)
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    gap_before = True
    for a in range(int(offsets[0]), int(offsets[-1]), BYTES):
        b = min(a + BYTES, int(offsets[-1]))
        gap = GAPS[data[a:b]]
        starts = ~gap
        starts[1:] &= gap[:-1]
        starts[0] &= gap_before
        own = heads[np.searchsorted(heads, a) : np.searchsorted(heads, b)] - a
        starts[own] = ~gap[own]
        counts += np.diff(np.searchsorted(np.flatnonzero(starts) + a, offsets))
        gap_before = bool(gap[-1])
    return counts


def sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, size (words) and a running number of every row, written once."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(word_counts(batch.column(2)))], ["id", "source", "size"]
            )

    kind = dict(df.dtypes)[id_col]
    rows = df.select(df[id_col].alias("id"), df[source_col].cast("string").alias("source"), df[text_col].cast("string").alias("text"))
    counted = rows.mapInArrow(run, f"id {kind}, source string, size long")
    return cut_lineage(counted.withColumn("number", F.monotonically_increasing_id()), "sizes")


# -- targets ------------------------------------------------------------------------------


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size and target of rows (source, source_size), one per source.

    Weights go round the sources in order, null last. ``share`` of all words is dealt out by weight; no target exceeds
    ``most`` times its source, and what is over is dealt out again among the others.
    """
    placed = sources.select("source", "source_size", F.col("source").isNull().alias("missing"), F.lit(0).alias("zero"))
    place = (F.col("row_number") - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    ordered = with_global_order(placed, "zero", ["missing", "source"])
    weighted = cut_lineage(ordered.select("source", "source_size", weight.cast("long").alias("weight")), "weights")
    level, before = 0.0, None
    while level != before:  # sources that a round finds above their limit stay there: the level only rises
        full = F.col("weight") * F.lit(level) > most * F.col("source_size")
        found = weighted.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        before = level
        if found["weight"]:
            level = (share * found["all"] - most * found["full"]) / found["weight"]
        elif found["all"] is not None:
            level = float("inf")
    target = F.least(F.col("weight") * F.lit(level), (most * F.col("source_size")).cast("double"))
    return weighted.select("source", "source_size", target.alias("target"))


# -- lengths ------------------------------------------------------------------------------


def fitted(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size (positive, descending) make up ``budget`` words most nearly."""
    total = sum(s * c for s, c in zip(sizes, counts, strict=True))
    if budget >= total:
        return list(counts)
    takes = [c * budget // total for c in counts]
    left = budget - sum(s * t for s, t in zip(sizes, takes, strict=True))
    for i, size in enumerate(sizes):
        if left <= WINDOW:
            break
        if size <= left:
            takes[i] += 1
            left -= size
    # Bit s of ``reached``: some of the items so far sum to s. Item i of ``parent[s]`` was the last of them.
    reached, mask, items = 1, (1 << (2 * left + 1)) - 1, []
    parent = np.full(2 * left + 1, -1, np.int64)
    for i, size in enumerate(sizes):
        free, packed = min(counts[i] - takes[i], 2 * left // size), 1
        while free and not reached >> left & 1:
            packed = min(packed, free)
            free -= packed
            new = (reached << size * packed) & mask & ~reached
            if new:
                bits = np.frombuffer(new.to_bytes(2 * left // 8 + 1, "little"), np.uint8)
                parent[np.flatnonzero(np.unpackbits(bits, bitorder="little")[: 2 * left + 1])] = len(items)
                items.append((i, packed))
                reached |= new
            packed *= 2
    sums = np.concatenate([[0], np.flatnonzero(parent >= 0)])
    at = int(sums[np.argmin(np.abs(sums - left))])
    while at:
        i, packed = items[parent[at]]
        takes[i] += packed
        at -= sizes[i] * packed
    return takes


def planned(lengths: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """source, size, n, copies (of every document), extra (documents that get one more), source_size and target of
    each length; ``lengths`` has rows (source, size, n), ``wanted`` those of ``targets``."""
    schema = "source string, size long, n long, copies long, extra long, source_size long, target double"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending")])
        sizes, counts = table.column("size").to_pylist(), table.column("n").to_pylist()
        total, target = table.column("source_size")[0].as_py(), table.column("target")[0].as_py()
        copies = min(int(target // total), most - 1) if total else 0
        known = sum(s > 0 for s in sizes)  # documents without words come last
        takes = fitted(sizes[:known], counts[:known], int(target - copies * total + 0.5))
        takes += [0] * (len(sizes) - known)
        columns = {"copies": [copies] * len(sizes), "extra": takes}
        columns = {k: pa.array(x, pa.int64()) for k, x in columns.items()}
        columns |= {k: table.column(k) for k in ("source", "size", "n", "source_size", "target")}
        return pa.table({k: columns[k] for k in ("source", "size", "n", "copies", "extra", "source_size", "target")})

    told = lengths.join(wanted.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    return told.groupBy("source").applyInArrow(run, schema)


# -- documents ----------------------------------------------------------------------------


def selected(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Each row of ``sized`` with its plan and whether it gets an extra copy: the first of its length by a seeded hash."""
    # Rows without an id are told apart by their number; they are interchangeable.
    order = F.xxhash64(F.lit(seed), "id", F.when(F.col("id").isNull(), F.col("number")))
    # The hash's rank among all 2**31 leading values says which bin a row goes to.
    lead = F.shiftrightunsigned(order, 33)
    bins = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(BIN_ROWS)))
    told = plan.withColumnsRenamed({"source": "of", "size": "length"})
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("length"))
    tagged = rows.join(told, same).drop("of", "length").withColumn("order", order)
    tagged = cut_lineage(tagged.withColumn("bin", F.floor(lead * bins / F.lit(2.0**31))), "planned")

    upto = F.sum("c").over(Window.partitionBy("source", "size").orderBy("bin"))
    parts = tagged.where("extra > 0 AND extra < n").groupBy("source", "size", "bin", "extra").agg(F.count(F.lit(1)).alias("c"))
    given = F.greatest(F.lit(0), F.least(F.col("c"), F.col("extra") - F.col("upto") + F.col("c")))
    parts = parts.withColumn("upto", upto).select(
        F.col("source").alias("of"), F.col("size").alias("length"), F.col("bin").alias("part"), given.alias("given")
    )
    same = same & (F.col("bin") == F.col("part"))
    joined = tagged.join(parts, same, "left")
    place = F.row_number().over(Window.partitionBy("source", "size", "bin").orderBy("order", "number"))
    undecided = joined.where("given > 0").withColumn("chosen", place <= F.col("given")).select(*tagged.columns, "chosen")
    decided = joined.where("given IS NULL OR given = 0").withColumn("chosen", F.col("given").isNull() & (F.col("extra") > 0))
    return undecided.unionByName(decided.select(*tagged.columns, "chosen"))


def mixed(
    df: DataFrame, id_col: str, text_col: str, source_col: str,
    *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
) -> DataFrame:
    """id, source, size, source_size, target (both the source's, in words) and copies of every row.

    ``copies`` is how often the mix takes the document, ``most`` times at most. The copies depend on the ids, sources and sizes
    alone, so a run over the same rows gives the same mix however they are laid out.
    """
    rows = sized(df, id_col, text_col, source_col)
    lengths = cut_lineage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    plan = cut_lineage(planned(lengths, targets(sources, weights, share, most), most), "length-plan")
    chosen = selected(rows, plan, seed)
    return chosen.select("id", "source", "size", "source_size", "target", (F.col("copies") + F.col("chosen").cast("long")).alias("copies"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixed(read_table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source"
    )
