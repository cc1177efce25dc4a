"""Large CSV files with line breaks inside quotes, read by many tasks.

Spark cuts a text file into ranges of bytes, and each range into lines. Whether a range starts inside quotes depends on
all quotes before it, so a first pass counts them: each range tells whether its number is odd, and how its first lines read
if they belong to a record that began earlier. A running sum over the ranges of a file says which of them start inside
quotes. A second pass then puts whole records together; a record that runs over the end of its range gets the first
lines of the next one, which that one leaves out.

Only one row per range meets on the driver, with what a record has beyond its range. Quotes must balance, as they do in files
whose quoted fields double the quotes inside: a quote in an unquoted field would count as the start of a quoted one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE = '"'
MOST_OVER = 64 << 20  # characters of a record beyond its range; quotes that never close would take the rest of the file


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _ranges(batches) -> Iterator[tuple[str, int, Iterator[str]]]:
    """The lines of each range that a task reads, in order."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

    for (file, start), own in groupby(rows(), lambda r: r[1:]):
        yield file, start, (r[0] for r in own)


def _surveyed(lines: DataFrame) -> list[tuple[str, int, bool, str, bool]]:
    """file, start, whether the number of quotes is odd, the first lines as the end of a record, and whether that closes."""

    def run(batches):
        for file, start, own in _ranges(batches):
            odd, head, closed, size = False, [], False, 0
            for line in own:
                odd ^= line.count(QUOTE) % 2 == 1
                if not closed and size <= MOST_OVER:
                    head.append(line)
                    size += len(line)
                    closed = odd
            yield pa.RecordBatch.from_pylist(
                [{"file": file, "start": start, "odd": odd, "head": "\n".join(head)[: MOST_OVER + 1], "closed": closed}]
            )

    found = lines.mapInArrow(run, "file string, start long, odd boolean, head string, closed boolean")
    return sorted(tuple(r) for r in found.collect())  # one row per range


def _plan(survey: list[tuple[str, int, bool, str, bool]]) -> dict[tuple[str, int], tuple[bool, list[str]]]:
    """For each range whether it starts inside quotes, and the lines that its last record has in later ranges."""
    plan: dict[tuple[str, int], tuple[bool, list[str]]] = {}
    for _, own in groupby(survey, lambda r: r[0]):
        inside, owner = False, None
        for file, start, odd, head, closed in own:
            plan[file, start] = inside, []
            if inside:
                plan[owner][1].append(head)
                if sum(map(len, plan[owner][1])) > MOST_OVER:
                    raise ValueError(f"quotes do not balance in {file}: a record runs on for over {MOST_OVER} characters")
            if not inside or closed:
                owner = file, start
            inside ^= odd
    return plan


def split_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One row per record of the CSV file or folder at ``path``, as text; empty lines and, if asked for, headers are left out."""
    lines = _lines(spark, path)
    plan = _plan(_surveyed(lines))

    def whole(lines: Iterator[str], inside: bool, over: list[str]) -> Iterator[str]:
        held: list[str] = []
        odd = False
        for line in lines:
            flips = line.count(QUOTE) % 2 == 1
            if inside:  # the end of a record of an earlier range
                inside = not flips
                continue
            held.append(line)
            odd ^= flips
            if not odd:
                yield "\n".join(held).removesuffix("\r")
                held = []
        if held:
            yield "\n".join([*held, *over]).removesuffix("\r")

    def run(batches):
        out: list[str] = []
        for file, start, own in _ranges(batches):
            inside, over = plan[file, start]
            for i, record in enumerate(whole(own, inside, over)):
                if record and not (header and i == 0 and start == 0):
                    out.append(record)
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])
                    out = []
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])

    return lines.mapInArrow(run, "record string")


def split_csv(spark: SparkSession, path: str, ddl: str, options: dict[str, str]) -> DataFrame:
    """The columns ``ddl`` of the CSV at ``path``; ``options`` are those of Spark's reader."""
    options = {k: v for k, v in options.items() if k != "header"}
    parsed = F.from_csv("record", F.lit(ddl), options)
    return split_records(spark, path, header=True).select(parsed.alias("row")).select("row.*")
