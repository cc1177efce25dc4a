"""Near-duplicates by SimHash fingerprints and meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 * half`` bits share a variant that differs from each in
at most ``half``. Every distinct fingerprint therefore emits all its variants within ``half`` bits,
and equal variants meet. Variants are shuffled by their leading bits: one row stands for all the
variants of a fingerprint that have these leading bits, and the task that gets it writes them out
(with 64 bits and half = 2 there are 2,081 variants but only 37 rows at 8 leading bits). The
number of leading bits grows with the number of fingerprints, so an even spread gives buckets of at most
``BUCKET_VARIANTS`` variants. Near copies share leading bits: buckets with over twice as many are counted
and dealt out again by ``MORE_BITS`` more bits, until none is left or ``LAST_PREFIX`` bits are used,
where a bucket is two variants and the fingerprints around them. Fingerprints that share a variant
differ in at most twice ``half`` bits, so ties need no other check.

Copies are one fingerprint. Inside a bucket equal variants tie their fingerprints to the smallest
one they reach, so a group of g near copies costs g rows, not all its pairs, and no link between
groups is lost. The ties of all buckets are joined to components on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import fresh, partitions, read_table
from mercata.llm.components import star_forest
from mercata.session import cut_lineage

BITS = 64
SEED = 42
BUCKET_VARIANTS = 2_000_000
LEAST_PREFIX, MOST_PREFIX = 8, 24
MORE_BITS, LAST_PREFIX = 4, BITS - 1
PART = 1 << 15
EMITTED = 1 << 12  # fingerprints at a time: each has up to 300 rows


def fingerprint(text: str | None, words: int) -> int:
    """The fingerprint of a text: 0 if it is null or has no words.

    A-Z are lower-cased; words are parted by ASCII white space; shingles of ``words`` words,
    repeats included, are hashed by XXH64; a bit is set if it is set in over half the hashes.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[: -words] + 1])
        shingles = map(joined.__getitem__, map(slice, starts.tolist(), ends[words - 1 :].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), PART):
        part = hashes[i : i + PART].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id and fp (a signed long) of every row."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    kind = dict(df.dtypes)[id_col]
    return df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def flips(bits: int, most: int) -> np.ndarray:
    """All masks of ``bits`` bits with at most ``most`` set, grouped by how many are set."""
    return np.array([sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def prefix_bits(n: int, half: int) -> int:
    variants = n * sum(comb(BITS, k) for k in range(half + 1))
    return int(min(max(np.ceil(np.log2(max(variants, 1) / BUCKET_VARIANTS)), LEAST_PREFIX), MOST_PREFIX))


def bucket_ties(prefix: int, fps: np.ndarray, lead: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Ties (root, member) between the fingerprints of one bucket whose variants meet in it."""
    low = BITS - lead
    spent = np.bitwise_count(fps >> np.uint64(low) ^ np.uint64(prefix))
    variants, owners = [], []
    for used in range(half + 1):
        own = np.flatnonzero(spent == used)
        masks = flips(low, half - used)
        variants.append(((fps[own] & np.uint64((1 << low) - 1))[:, None] ^ masks).reshape(-1))
        owners.append(np.repeat(own.astype(np.int32), len(masks)))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variants)
    variants, owners = variants[order], owners[order]
    same = np.concatenate([[False], variants[1:] == variants[:-1], [False]])
    met = same[1:] | same[:-1]
    owners, firsts = owners[met], np.flatnonzero(~same[:-1][met])
    if not len(owners):
        return fps[:0], fps[:0]
    # Colliding pairs, each of them with the first of its variant, are verified.
    lead_of = np.repeat(owners[firsts], np.diff(np.append(firsts, len(owners))))
    near = np.bitwise_count(fps[owners] ^ fps[lead_of]) <= 2 * half
    owners, firsts = owners[near], (np.cumsum(near) - 1)[firsts]
    # Spread the smallest fingerprint over groups that overlap, until nothing changes.
    sizes = np.diff(np.append(firsts, len(owners)))
    rank = np.empty(len(fps), np.int64)
    by_value = np.argsort(fps.view(np.int64), kind="stable")
    rank[by_value] = np.arange(len(fps))
    label = rank.copy()
    while True:
        least = np.minimum.reduceat(label[owners], firsts)
        new = label.copy()
        np.minimum.at(new, owners, np.repeat(least, sizes))
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != rank)
    return fps[by_value[label[member]]], fps[member]


def _emitted(rows: DataFrame, lead: int, more: int, half: int) -> DataFrame:
    """Rows (prefix, fp) by ``more`` bits beyond the ``lead`` bits of ``prefix``, within what ``half`` has left.

    With ``lead`` 0 every fingerprint starts a row.
    """
    masks = [flips(more, k) for k in range(half + 1)]

    def run(batches):
        for batch in batches:
            fps = batch.column(1).to_numpy().view(np.uint64)
            old = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fps), EMITTED):
                part, prefix = fps[i : i + EMITTED], old[i : i + EMITTED]
                spent = np.bitwise_count(part >> np.uint64(BITS - lead) ^ prefix) if lead else np.zeros(len(part), np.uint8)
                tail = part >> np.uint64(BITS - lead - more) & np.uint64((1 << more) - 1)
                for used in range(half + 1):
                    own = np.flatnonzero(spent == used)
                    if not len(own):
                        continue
                    mask = masks[half - used]
                    prefixes = (prefix[own] << np.uint64(more) | tail[own])[:, None] ^ mask
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(prefixes.reshape(-1).view(np.int64)), pa.array(np.repeat(part[own].view(np.int64), len(mask)))],
                        ["prefix", "fp"],
                    )

    return rows.select("prefix", "fp").mapInArrow(run, "prefix long, fp long")


def buckets(distinct: DataFrame, half: int) -> Iterator[tuple[int, DataFrame]]:
    """Leading bits and rows (prefix, fp): every bucket with all its fingerprints, heavy ones split."""
    lead = prefix_bits(distinct.count(), half)
    rows = _emitted(distinct.select(F.lit(0).cast("long").alias("prefix"), "fp"), 0, lead, half)
    while True:
        variants = F.element_at(
            F.array(*[F.lit(sum(comb(BITS - lead, k) for k in range(half - used + 1))) for used in range(half + 1)]),
            F.bit_count(F.shiftrightunsigned("fp", BITS - lead).bitwiseXOR(F.col("prefix"))) + 1,
        )
        sizes = rows.groupBy("prefix").agg(F.sum(variants.cast("long")).alias("n"))
        heavy = cut_lineage(sizes.where(F.col("n") > 2 * BUCKET_VARIANTS).select("prefix"), "heavy-prefixes")
        if lead == LAST_PREFIX or heavy.isEmpty():
            yield lead, rows
            return
        yield lead, rows.join(heavy, "prefix", "left_anti")
        more = min(MORE_BITS, LAST_PREFIX - lead)
        rows = cut_lineage(_emitted(rows.join(heavy, "prefix", "left_semi"), lead, more, half), "split-prefixes")
        lead += more


def ties(distinct: DataFrame, half: int) -> DataFrame:
    """Rows (a, b), a < b: enough links between the values of ``fp`` to join all that differ in at
    most ``2 * half`` bits, directly or through others that do."""

    def met(lead: int, rows: DataFrame) -> DataFrame:
        def meet(batches):
            for prefix, fps in _buckets(batches):
                a, b = (x.view(np.int64) for x in bucket_ties(prefix, fps, lead, half))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        rows = rows.repartition(partitions(distinct), "prefix").sortWithinPartitions("prefix")
        return rows.mapInArrow(meet, "a long, b long")

    return reduce(DataFrame.union, [met(lead, rows) for lead, rows in buckets(distinct, half)])


def _buckets(batches) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each prefix; they come in order of prefix."""
    held: list[np.ndarray] = []
    current = None
    for batch in batches:
        prefixes, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], prefixes[1:] != prefixes[:-1]])) if len(prefixes) else []
        for start, end in zip(starts, [*starts[1:], len(prefixes)], strict=True):
            if prefixes[start] != current and held:
                yield int(current), np.concatenate(held)
                held = []
            current = prefixes[start]
            held.append(fps[start:end])
    if held:
        yield int(current), np.concatenate(held)


def components(df: DataFrame, id_col: str, text_col: str, *, words: int = 5, half: int = 2) -> DataFrame:
    """Rows id, fp, component_id for every row of ``df``.

    ``component_id`` is the smallest id that links reach, the row itself included. Rows without an
    id take part and may have no component id if all they reach have none either. Repeated rows
    stay repeated.
    """
    rows = cut_lineage(fingerprints(df, id_col, text_col, words), "fingerprints")
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    forest = star_forest(ties(distinct, half))
    rooted = distinct.join(forest.withColumnsRenamed({"a": "root", "b": "fp"}), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("id", "fp", "component_id")


def deduplicated(df: DataFrame, id_col: str, text_col: str, *, words: int = 5, half: int = 2) -> DataFrame:
    """The rows of ``df``, one for each component: the one with the smallest id.

    Rows without an id come after all others; of repeated rows one stays. The rows are written once with a
    running number, which stands for the row from then on.
    """
    number = fresh(df, "row_number")
    rows = cut_lineage(df.withColumn(number, F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), F.col(number).alias("number"))
    keyed = rows.select(key.alias("key"), F.col(text_col).alias("text"))
    grouped = components(keyed, "key", "text", words=words, half=half)
    gone = grouped.where("id <> component_id").select(F.col("id.number").alias(number))
    return rows.join(gone, number, "left_anti").drop(number)


def query(spark, sf_dir: str) -> DataFrame:
    rows = components(read_table(spark, sf_dir, "documents"), "doc_id", "text", words=4)
    return rows.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
