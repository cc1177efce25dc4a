"""Spelling variants by a dictionary of trie node pairs.

The words of a vocabulary are put in order, forwards and again spelt backwards, and the nodes of both tries are
numbered: a word shares the numbers of its common prefix with the word before it and gets new ones
for the rest. A word of L letters then has L + 1 prefix nodes and as many suffix nodes. Two words differ

* in one replaced letter if, with that letter skipped, they have the same pair (prefix node, suffix node);
* in one inserted letter if the longer one, with the letter skipped, has a pair that the shorter one has
  where its prefix and suffix meet.

Pairs are whole numbers, so equal pairs are exact neighbours and no word is compared with another. Of equal
letters side by side only the last is skipped for the second case, so each pair of words is found once.

In Spark: the vocabulary is sorted by a range shuffle and numbered in blocks; what a block takes over from the words
before it is worked out from one row per block (``BLOCK_WORDS`` words each). Pairs are shuffled by both numbers.
Words that share a pair differ in one letter, so a pair has at most as many as the alphabet has
letters, and one more; each gets how many of the others are near it and the best of them, no pairs are written out.
What a word gets from all its pairs is added up with map-side combine.

Counting words: each task adds up what it reads and passes on a row per distinct word, so frequent words cost a row per
task. Odd rows: null texts have no words; a null id is written as nothing in front of the colon; repeated rows
count as often as they come; words of any length are handled. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm.common import partitions, read_table
from mercata.session import cut_lineage

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, FACTOR = 7, 2, 10
DELETED_ONE_IN = 31
HELD_WORDS = 200_000  # of a task before it passes its counts on
BLOCK_WORDS, BLOCK_LETTERS = 1 << 14, 1 << 18
PART_ROWS = 1 << 18  # pairs at a time
REPLACED, SKIPPED, MET = 0, 1, 2  # the letter is skipped: not the last of equal ones, or it is; nothing is skipped


# -- words and how often they occur -------------------------------------------------------


def words_of(texts: Iterable[tuple[str, str | None]], least: int = LEAST_LETTERS) -> Iterator[tuple[str, int]]:
    """The words of (id, text) rows with counts; a letter is deleted from one in 31 occurrences."""
    run = re.compile(f"[{LETTERS}]{{{least},}}")
    for name, text in texts:
        if not text:
            continue
        # Only A-Z change: bytes above 127 have no case.
        found = Counter(run.findall(text.encode().lower().decode()))
        start = zlib.crc32(f"{name}:".encode())
        for word, n in found.items():
            h = zlib.crc32(word.encode(), start)
            if h % DELETED_ONE_IN == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < least:
                    continue
            yield word, n


def vocabulary(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """word and n of all words of at least ``LEAST_LETTERS`` letters that occur ``LEAST_COUNT`` times or more."""

    def run(batches):
        held: Counter = Counter()

        def told():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in words_of([row]):
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield told()
                    held.clear()
        if held:
            yield told()

    texts = df.select(F.coalesce(df[id_col].cast("string"), F.lit("")).alias("id"), df[text_col].cast("string").alias("text"))
    counted = texts.where("text IS NOT NULL").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# -- numbers of trie nodes ----------------------------------------------------------------


def common_length(a: str, b: str) -> int:
    """How many letters two words share from the start."""
    low, high = 0, min(len(a), len(b))
    if high < 64:
        for i in range(high):
            if a[i] != b[i]:
                return i
        return high
    while low < high:  # long words: by halves
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def local_nodes(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Nodes of sorted words, numbered from 0 as if no word stood before them.

    Returns the numbers of all prefixes of one letter or more, word after word, the words' lengths, and how many there are.
    """
    flat: list[int] = []
    stack: list[int] = []
    before, total = "", 0
    for word in words:
        k = common_length(before, word)
        del stack[k:]
        stack.extend(range(total, total + len(word) - k))
        total += len(word) - k
        flat.extend(stack)
        before = word
    return np.array(flat, np.int64), np.array([*map(len, words)], np.int64), total


def sorted_blocks(words: DataFrame, by: F.Column, other: list[str]) -> DataFrame:
    """The words in order of ``by``, many to a row: part, block, keys, the columns ``other`` as arrays, nodes (numbered as in
    ``local_nodes``), size, first, last and tail (the last word's nodes)."""

    def run(batches):
        part, block, keys, rows, letters = TaskContext.get().partitionId(), 0, [], [], 0

        def written():
            nodes, lengths, total = local_nodes(keys)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([keys], pa.list_(pa.string())),
                    *[pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.concat_arrays(c)) for c in zip(*rows, strict=True)],
                    pa.array([nodes.astype("<i8").tobytes()], pa.binary()),
                    pa.array([total], pa.int64()),
                    pa.array([keys[0]], pa.string()),
                    pa.array([keys[-1]], pa.string()),
                    pa.array([nodes[len(nodes) - lengths[-1] :].tolist()], pa.list_(pa.int64())),
                ],
                ["part", "block", "keys", *other, "nodes", "size", "first", "last", "tail"],
            )

        for batch in batches:
            taken = 0
            for i, key in enumerate(batch.column(0).to_pylist()):
                keys.append(key)
                letters += len(key)
                if len(keys) >= BLOCK_WORDS or letters >= BLOCK_LETTERS or i == batch.num_rows - 1:
                    rows.append([c.slice(taken, i + 1 - taken) for c in batch.columns[1:]])
                    taken = i + 1
                if len(keys) >= BLOCK_WORDS or letters >= BLOCK_LETTERS:
                    yield written()
                    block, keys, rows, letters = block + 1, [], [], 0
        if keys:
            yield written()

    kinds = ", ".join(f"{c} array<{k}>" for c, k in words.dtypes if c in other)
    schema = f"part int, block int, keys array<string>, {kinds}, nodes binary, size long, first string, last string, tail array<long>"
    placed = words.select(by.alias("key"), *other).repartitionByRange(partitions(words), "key").sortWithinPartitions("key")
    return cut_lineage(placed.mapInArrow(run, schema), "trie-blocks")


def numbered(blocks: DataFrame, values: list[str]) -> DataFrame:
    """One row per word: its place in the order, ``values`` and ``nodes`` (the root, 0, first).

    Where a block's first word goes on from the word before it, its nodes are those of that word.
    """
    # One row per block of sorted words; what a block takes over is at most its first word long.
    told = blocks.select("part", "block", F.size("keys").alias("words"), "size", "first", "last", "tail").orderBy("part", "block").collect()
    taken: dict[tuple[int, int], tuple[int, int, np.ndarray]] = {}
    words, base, before, stack = 0, 1, "", np.empty(0, np.int64)
    for row in told:
        k = common_length(before, row["first"])
        tail = np.array(row["tail"], np.int64)
        taken[row["part"], row["block"]] = words, base, stack[:k].copy()
        # A local number below k is a node that stood before.
        stack = np.where(tail < k, stack[np.minimum(tail, max(k - 1, 0))] if k else tail, base + tail - k)
        words, base, before = words + row["words"], base + row["size"] - k, row["last"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in ("part", "block", "keys", "nodes", *values)}
                first, base, old = taken[row["part"].as_py(), row["block"].as_py()]
                local = np.frombuffer(row["nodes"].as_py(), "<i8")
                k = len(old)
                nodes = np.where(local < k, old[np.minimum(local, max(k - 1, 0))] if k else local, base + local - k)
                lengths = np.array([len(x) for x in row["keys"].as_py()], np.int64)
                ends = np.concatenate([[0], np.cumsum(lengths + 1)])
                flat = np.zeros(ends[-1], np.int64)
                inner = np.ones(ends[-1], bool)
                inner[ends[:-1]] = False
                flat[inner] = nodes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first + np.arange(len(lengths)), pa.int64()),
                        *[row[v].values for v in values],
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    ],
                    ["place", *values, "nodes"],
                )

    kinds = {c: k.removeprefix("array<")[:-1] for c, k in blocks.dtypes if c in values}
    columns = ", ".join(f"{v} {kinds[v]}" for v in values)
    return blocks.select("part", "block", "keys", "nodes", *values).mapInArrow(run, f"place long, {columns}, nodes array<long>")


# -- pairs of nodes -----------------------------------------------------------------------


def pairs(words: DataFrame) -> DataFrame:
    """prefix, suffix, kind, number and n for each place of each word (number, word, n, prefixes, suffixes)."""

    def run(batches):
        for batch in batches:
            lengths = np.asarray(batch.column(3).value_lengths(), np.int64)  # letters and one
            ends, first = np.cumsum(2 * lengths), 0
            while first < batch.num_rows:
                before = ends[first - 1] if first else 0
                size = max(1, int(np.searchsorted(ends, before + PART_ROWS)) - first)
                part = batch.slice(first, size)
                letters = np.frombuffer("".join(part.column(1).to_pylist()).encode("utf-32-le"), "<u4")
                flat = [part.column(i).flatten().to_numpy() for i in (3, 4)]
                columns = _pairs(letters, lengths[first : first + size], *flat)
                owner = columns.pop()
                numbers = [part.column(i).to_numpy()[owner] for i in (0, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, *numbers)], ["prefix", "suffix", "kind", "number", "n"])
                first += size

    return words.select("number", "word", "n", "prefixes", "suffixes").mapInArrow(
        run, "prefix long, suffix long, kind byte, number long, n long"
    )


def _pairs(letters: np.ndarray, lengths: np.ndarray, prefix: np.ndarray, backward: np.ndarray) -> list[np.ndarray]:
    """prefix, suffix, kind and owner of the pairs of several words; ``lengths`` counts a word's nodes."""
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(prefix)) - starts[owner]
    # The suffix from a place on is the backward word's node of as many letters as are left.
    suffix = backward[starts[owner] + lengths[owner] - 1 - at]
    skip = np.flatnonzero(at < lengths[owner] - 1)
    again = np.zeros(len(skip), bool)  # the next letter of the word is the same
    again[:-1] = (letters[1:] == letters[:-1]) & (owner[skip][1:] == owner[skip][:-1])
    return [
        np.concatenate([prefix, prefix[skip]]),
        np.concatenate([suffix, suffix[skip + 1]]),
        np.concatenate([np.full(len(prefix), MET, np.int8), np.where(again, REPLACED, SKIPPED).astype(np.int8)]),
        np.concatenate([owner, owner[skip]]),
    ]


def near_words(met: DataFrame) -> DataFrame:
    """number, n_near, best_n and best (the near word of largest n, then smallest number) of each word that has near words."""

    def run(batches):
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            # The last pair may go on in the next batch; it has few rows.
            last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
            end = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            held = [c[end:] for c in columns]
            yield _near(*[c[:end] for c in columns])
        if held is not None:
            yield _near(*held)

    placed = met.repartition(partitions(met), "prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    found = placed.mapInArrow(run, "number long, n_near long, best_n long, best long")
    best = F.max(F.struct("best_n", (-F.col("best")).alias("other"))).alias("top")
    summed = found.groupBy("number").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("number", "n_near", "top.best_n", (-F.col("top.other")).alias("best"))


def _near(prefix: np.ndarray, suffix: np.ndarray, kind: np.ndarray, number: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """For rows in order of pairs: how many others of its pair are near each word, and the best of them."""
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])
    group = np.cumsum(new) - 1
    several = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    group, kind, number, n = (x[several] for x in (group, kind, number, n))
    # Best words first, the one without a skipped letter last.
    order = np.lexsort((number, -n, kind == MET, group))
    group, kind, number, n = (x[order] for x in (group, kind, number, n))
    firsts = np.flatnonzero(np.diff(group, prepend=-1))
    which = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(group))))
    rows, skipped = np.arange(len(group)), kind != MET
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # row, others near it, best of them

    # A letter replaced: all rows of a pair that skip one.
    count = np.bincount(which[skipped], minlength=len(firsts))
    own = rows[skipped & (count[which] > 1)]
    first = firsts[which[own]]
    out.append((own, count[which[own]] - 1, np.where(own == first, first + 1, first)))

    # A letter inserted: rows that skip one against the row that does not.
    ends = np.append(firsts, len(group))[1:] - 1
    whole = np.where(kind[ends] == MET, ends, -1) if len(firsts) else ends
    dropped = kind == SKIPPED
    own = rows[dropped & (whole[which] >= 0)] if len(rows) else rows
    out.append((own, np.ones(len(own), np.int64), whole[which[own]]))
    longer = np.bincount(which[own], minlength=len(firsts))
    best = np.full(len(firsts), len(group))
    np.minimum.at(best, which[own], own)
    has = np.flatnonzero(longer > 0)
    out.append((whole[has], longer[has], best[has]))

    row, near, best = (np.concatenate([o[i] for o in out]).astype(np.int64) for i in range(3))
    arrays = [pa.array(x.astype(np.int64)) for x in (number[row], near, n[best], number[best])]
    return pa.RecordBatch.from_arrays(arrays, ["number", "n_near", "best_n", "best"])


# -- forms and roots ----------------------------------------------------------------------


def variants(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts.

    A word's form is its near word of largest n (ties: smallest in code-point order) if that is ``FACTOR`` times its own
    or more, else null; its root is where its forms lead to in the end.
    """
    found = cut_lineage(vocabulary(df, id_col, text_col), "vocabulary")
    forward = numbered(sorted_blocks(found, F.col("word"), ["word", "n"]), ["word", "n"])
    words = cut_lineage(forward.withColumnsRenamed({"place": "number", "nodes": "prefixes"}), "words")
    backward = numbered(sorted_blocks(words, F.reverse("word"), ["number"]), ["number"])
    both = words.join(backward.select("number", F.col("nodes").alias("suffixes")), "number")
    best = near_words(pairs(both))
    plain = words.select("number", "word", "n").join(best, "number", "left")
    formed = F.when(F.col("best_n") >= FACTOR * F.col("n"), F.col("best"))
    told = cut_lineage(plain.select("number", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), formed.alias("form")), "near")

    roots = cut_lineage(told.where("form IS NOT NULL").select("number", F.col("form").alias("root")), "roots")
    while True:  # a step counts ten times as often, and each round doubles the steps
        further = roots.select(F.col("number").alias("root"), F.col("root").alias("next"))
        joined = roots.join(further, "root", "left")
        longer = cut_lineage(joined.select("number", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        roots = longer.select("number", "root")
        if longer.where("went").isEmpty():
            break
    names = told.select("number", "word", "n")
    forms = told.where("form IS NOT NULL").select("number", "form")
    forms = forms.join(names.toDF("form", "form_word", "form_n"), "form").drop("form").join(
        roots.join(names.toDF("root", "root_word", "root_n"), "root").select("number", "root_word"), "number"
    )
    return told.select("number", "word", "n", "n_near").join(forms, "number", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read_table(spark, sf_dir, "documents"), "doc_id", "text")
