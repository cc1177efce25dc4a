"""Text quality by perplexity under a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney model of byte strings of ``ORDER`` = 4: bytes, as the
words of noisy text in many languages are mostly unseen, and because the number of distinct strings grows slowly. All
counts are tables on Spark, hashed by string: raw counts of the longest strings, continuation
counts (how many different bytes stand before) of the shorter, and per context its total and how many
followers have a count of 1, 2 and more. Joins of these tables give the probability of each string;
discounts come from the counts of counts, four numbers an order.

Texts are packed once, straight from the scan, into blocks in a table bucketed by block. Each block asks
for the probabilities of its distinct strings; requests are joined with the probabilities by string, and the
answers go back to the blocks. The buckets let both joins with blocks read them in place, so text is
never shuffled. A string that is in a third of all blocks is one row for each of them, and Spark
splits such a join. One trusted document in ``HELD_OUT``, by a hash of its id, is not counted: these set
the limits. A document is kept if its perplexity is at most the ``QUANTILE`` quantile, exactly, of its
language's held-out documents (of all of them, where its language has none), times ``slack``: ``SLACK`` unless
given, which spares clean texts where few documents set the limit; with 1 the quantile itself is the limit.

A text without words has no perplexity and is not kept. If nothing is trusted, all others are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import bucketed, read_table
from mercata.session import cut_lineage

ORDER = 4
BYTES = 256  # equally likely below the shortest strings
BLOCK = 4 << 20
QUANTILE = 0.98
SLACK = 1.25
DENSE = 4 << 20  # cells of a table of contexts by bytes; with more, strings are sorted
HELD_OUT = 5
PAD = b"\n\n\n"  # before each text; texts have no line ends


def normal(text: str | None) -> bytes:
    """Lower case (A-Z), digits as 0, white space as single blanks."""
    return b" ".join((text or "").encode().lower().translate(DIGITS).split())


DIGITS = bytes(ord("0") if ord("0") <= b <= ord("9") else b for b in range(256))


def packed(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """A table bucketed by ``block``: block, the ids and languages of its rows, and its texts, packed."""
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [normal(t) for t in batch.column(2).to_pylist()]
            first = size = 0
            for i, t in enumerate(texts):
                size += len(t)
                if size >= BLOCK or i == len(texts) - 1:
                    ends = pa.array([0, i + 1 - first], pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, c.slice(first, i + 1 - first)) for c in batch.columns[:2]]
                    blob = pack.compress(PAD + PAD.join(texts[first : i + 1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), *lists, pa.array([blob], pa.binary())], ["block", "ids", "langs", "texts"]
                    )
                    block, first, size = block + 1, i + 1, 0

    rows = df.select(df[id_col].alias("id"), df[lang_col].cast("string").alias("lang"), df[text_col].cast("string").alias("text"))
    blocks = rows.mapInArrow(run, f"block long, ids array<{kind}>, langs array<string>, texts binary")
    return bucketed(blocks, "block", "text_blocks")


class Strings:
    """The strings of a block's texts: their distinct numbers in order, and each position's place among them."""

    def __init__(self, blob: bytes):
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
        self.starts = np.flatnonzero(self.data == PAD[0])[2::3] + 1
        self.lengths = np.append(self.starts[1:] - 3, len(self.data)) - self.starts

    def select(self, rows: np.ndarray) -> np.ndarray:
        """Whether each position belongs to one of the rows (given as a mask)."""
        own = np.zeros(len(self.data), bool)
        steps = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(steps, self.starts[rows], 1)
        np.add.at(steps, (self.starts + self.lengths)[rows], -1)
        own[:] = np.cumsum(steps[:-1]) > 0
        return own[3:]

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Each position's place among the distinct strings, and these as numbers in ascending order.

        What it holds grows with the block and not with contexts times bytes.
        """
        used = np.flatnonzero(np.bincount(self.data, minlength=256))
        classes = np.zeros(256, np.int32)
        classes[used] = np.arange(len(used))
        c, a = classes[self.data], len(used)
        context = (c[:-3] * a + c[1:-2]) * a + c[2:-1]
        row = np.full(a**3, -1, np.int32)
        row[context] = 0
        contexts = np.flatnonzero(row == 0)
        if len(contexts) * a > DENSE:
            found, place = np.unique(context * np.int64(a) + c[3:], return_inverse=True)
            contexts, last = found // a, found % a
        else:
            row[contexts] = np.arange(len(contexts), dtype=np.int32)
            cell = row[context] * a + c[3:]
            seen = np.flatnonzero(np.bincount(cell, minlength=len(contexts) * a))
            at = np.zeros(len(contexts) * a, np.int32)
            at[seen] = np.arange(len(seen), dtype=np.int32)
            contexts, last, place = contexts[seen // a], seen % a, at[cell]
        numbers = used[contexts // (a * a)] << 24 | used[contexts // a % a] << 16 | used[contexts % a] << 8 | used[last]
        return place, numbers


def _counted(strings: Strings, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct strings that end in these rows, as numbers in ascending order, and their counts."""
    place, grams = strings.cells()
    counts = np.bincount(place[strings.select(rows)], minlength=len(grams))
    seen = np.flatnonzero(counts)
    return grams[seen], counts[seen]


def _gram_batches(grams, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(counts, pa.int64())], ["gram", "n"])


def counted(blocks: DataFrame, trusted: DataFrame) -> DataFrame:
    """gram and n over the rows of the blocks whose ids ``trusted`` (id) has."""

    def run(batches):
        for batch in batches:
            for ids, blob, own in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                mask = pc.is_in(ids.values, value_set=own.values).to_numpy(zero_copy_only=False)
                yield _gram_batches(*_counted(Strings(blob.as_py()), mask))

    placed = blocks.select("block", F.explode("ids").alias("id"))
    own = placed.join(trusted.distinct(), "id").groupBy("block").agg(F.collect_set("id").alias("own"))
    rows = blocks.select("block", "ids", "texts").join(own, "block").select("ids", "texts", "own")
    return rows.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def requested(blocks: DataFrame) -> DataFrame:
    """block and gram of every string that a block has."""

    def run(batches):
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                strings = Strings(blob.as_py())
                grams, _ = _counted(strings, np.ones(len(strings.starts), bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), block), pa.int64()), pa.array(grams, pa.int64())], ["block", "gram"]
                )

    return blocks.select("block", "texts").mapInArrow(run, "block long, gram long")


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """For counts of 1, 2 and more, from how many strings have a count of 1 to 4.

    Where these are too few for the estimate, it is 0.5, 1 and 1.5, and never above the count.
    """
    n = dict.fromkeys(range(1, 5), 0) | {r["n"]: r["count"] for r in table.where("n <= 4").groupBy("n").count().collect()}
    if not all(n.values()):
        return 0.5, 1.0, 1.5
    y = n[1] / (n[1] + 2 * n[2])
    found = [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05), k) for d, k in zip(found, (1.0, 2.0, 3.0), strict=True))


def probabilities(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For strings of 1 to ``ORDER`` bytes: (gram, p) of those seen, and (context, rest) with the
    share of probability that a context leaves to shorter strings."""
    tables = [counts]
    for size in range(ORDER - 1, 0, -1):
        shorter = tables[0].groupBy((F.col("gram") % BYTES**size).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        tables.insert(0, cut_lineage(shorter, f"strings-{size}"))
    out: list[tuple[DataFrame, DataFrame]] = []
    for size, table in enumerate(tables, 1):
        d1, d2, d3 = discounts(table)
        table = table.withColumn("context", F.floor(F.col("gram") / BYTES).cast("long"))
        n = F.col("n")
        stats = table.groupBy("context").agg(
            F.sum("n").alias("total"), *[F.count_if(c).alias(k) for k, c in (("n1", n == 1), ("n2", n == 2), ("n3", n > 2))]
        )
        rests = cut_lineage(
            stats.select("context", "total", ((d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("total")).alias("rest")),
            f"contexts-{size}",
        )
        own = F.greatest(n - F.when(n == 1, d1).when(n == 2, d2).otherwise(d3), F.lit(0.0)) / F.col("total")
        rows = table.join(rests, "context").withColumn("shorter", F.col("gram") % BYTES ** (size - 1))
        if out:
            below = out[-1][0].select(F.col("gram").alias("shorter"), F.col("p").alias("below"))
            rows = rows.join(below, "shorter")
        else:
            rows = rows.withColumn("below", F.lit(1 / BYTES))
        chances = rows.select("gram", (own + F.col("rest") * F.col("below")).alias("p"))
        out.append((cut_lineage(chances, f"chances-{size}"), rests.select("context", "rest")))
    return out


def looked_up(grams: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """gram and bits (of information) of each row of ``grams``, by backing off to shorter strings."""
    value: Column = F.lit(1 / BYTES)
    for size, (chances, rests) in enumerate(model, 1):
        p, rest = f"p{size}", f"rest{size}"
        at = F.col("gram") % BYTES**size
        grams = grams.withColumn("at", at).join(chances.select(F.col("gram").alias("at"), F.col("p").alias(p)), "at", "left")
        grams = grams.withColumn("at", F.floor(at / BYTES).cast("long"))
        grams = grams.join(rests.select(F.col("context").alias("at"), F.col("rest").alias(rest)), "at", "left").drop("at")
        value = F.coalesce(F.col(p), F.coalesce(F.col(rest), F.lit(1.0)) * value)
    return grams.select("gram", (-F.log2(value)).alias("bits"))


def scored(blocks: DataFrame, bits: DataFrame) -> DataFrame:
    """id, lang, n (bytes) and perplexity (a byte; null for empty texts) of every row of the blocks."""
    kind = dict(blocks.dtypes)["ids"].removeprefix("array<")[:-1]

    def run(batches):
        for batch in batches:
            for ids, langs, blob, answers in zip(*batch.columns, strict=True):
                strings = Strings(blob.as_py())
                place, grams = strings.cells()
                table = np.zeros(len(grams))
                own = strings.select(np.ones(len(strings.starts), bool))
                seen = np.zeros(len(table), bool)
                seen[place[own]] = True
                if answers.is_valid:  # in ascending order of strings, as the places are
                    table[seen] = answers.values.field(1).to_numpy()
                sums = np.concatenate([[0.0], np.cumsum(table[place] * own)])
                first = strings.starts - 3
                total = sums[first + strings.lengths] - sums[first]
                mean = total / np.maximum(strings.lengths, 1)
                perplexity = pa.array(np.exp2(mean), mask=strings.lengths == 0)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, langs.values, pa.array(strings.lengths), perplexity], ["id", "lang", "n", "perplexity"]
                )

    answers = bits.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("gram", "bits"))).alias("answers"))
    rows = blocks.join(answers, "block", "left").select("ids", "langs", "texts", "answers")
    return rows.mapInArrow(run, f"id {kind}, lang string, n long, perplexity double")


def judged(
    df: DataFrame, trusted: DataFrame, id_col: str, text_col: str, lang_col: str, quantile: float = QUANTILE, slack: float = SLACK
) -> DataFrame:
    """id, lang, n, perplexity, limit and kept of every row of ``df``; ``trusted`` has the ids (id) of
    trusted texts. Repeated rows stay repeated; a null id is never trusted."""
    blocks = packed(df, id_col, text_col, lang_col)
    trusted = trusted.where("id IS NOT NULL").distinct()
    measure = F.pmod(F.xxhash64("id"), F.lit(HELD_OUT)) == 0
    counts = cut_lineage(counted(blocks, trusted.where(~measure)), "strings")
    model = probabilities(counts)
    asked = cut_lineage(requested(blocks), "requests")
    bits = looked_up(asked.select("gram").distinct(), model)
    rows = cut_lineage(scored(blocks, asked.join(bits, "gram")), "perplexities")
    known = rows.join(trusted.where(measure), "id", "left_semi").where("perplexity IS NOT NULL")
    cut = slack * F.percentile("perplexity", quantile)  # one number a trusted document that is held out
    by_lang = known.where("lang IS NOT NULL").groupBy("lang").agg(cut.alias("limit"))
    overall = known.agg(cut.alias("limit")).first()["limit"]
    limit = F.coalesce("limit", F.lit(overall).cast("double"))
    kept = F.col("perplexity").isNotNull() & (limit.isNull() | (F.col("perplexity") <= limit))
    return rows.join(by_lang, "lang", "left").select("id", "lang", "n", "perplexity", limit.alias("limit"), kept.alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    rows = judged(read_table(spark, sf_dir, "documents"), labels.select(F.col("doc_id").alias("id")), "doc_id", "text", "lang")
    return rows.select(F.col("id").alias("doc_id"), "lang", F.col("n").alias("n_bytes"), "perplexity", "limit", "kept")
