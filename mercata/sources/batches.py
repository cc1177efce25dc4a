"""CSV batches: one folder per batch, one file (or folder of part files) per input."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata import schemas
from mercata.sources.records import split_csv

# CSV dialect of the input files.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    # Padding is one of the faults to be cleaned later; the writer would drop it by default.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
BATCH_PREFIX = "batch_"


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` and the path itself, through Spark's own client."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop(spark, path)
    return system.exists(target)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted."""
    system, target = _hadoop(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``, sorted."""
    system, target = _hadoop(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isFile())


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    system, target = _hadoop(spark, path)
    return system.getContentSummary(target).getLength()


def remove_path(spark: SparkSession, path: str) -> None:
    system, target = _hadoop(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    system, target = _hadoop(spark, path)
    stream = system.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: it is written under another name and then given its own."""
    system, target = _hadoop(spark, path)
    _, part = _hadoop(spark, f"{path}.part")
    stream = system.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(target):
        system.delete(target, False)
    if not system.rename(part, target):
        raise OSError(f"could not write {path}")


def scan_csv(spark: SparkSession, folder: str, name: str, split: bool = False) -> DataFrame:
    """One input of a batch as text columns; an absent file gives no rows.

    A line with more or fewer fields than columns comes whole in the last column as well.
    Quoted fields may hold commas and line breaks. Spark reads such a file in one task: the writer below keeps one
    part file per task, and a large file from elsewhere is read by many tasks with ``split`` (see ``records``).
    """
    schema = f"{schemas.INPUT_DDL[name]}, {schemas.MALFORMED} string"
    path = f"{folder}/{name}.csv"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    options = {**CSV_OPTIONS, "columnNameOfCorruptRecord": schemas.MALFORMED, "nullValue": ""}
    if split:
        return split_csv(spark, path, schema, options)
    return spark.read.schema(schema).options(**options, multiLine="true").csv(path)


def stamp(df: DataFrame, batch_id: str, ingested_at: dt.datetime) -> DataFrame:
    """Add the batch id and the load time."""
    return df.withColumn("batch_id", F.lit(batch_id)).withColumn(
        "ingested_at", F.lit(ingested_at).cast("timestamp")
    )


def load_batch(
    spark: SparkSession,
    folder: str,
    batch_id: str,
    names: Iterable[str] = tuple(schemas.INPUT_DDL),
    ingested_at: dt.datetime | None = None,
    split: bool = False,
) -> dict[str, DataFrame]:
    """All inputs of a batch as raw tables, keyed ``raw_<input>``; ``split`` reads large files by many tasks.

    They share one load time: a child counts as an orphan if its order came later.
    """
    ingested_at = ingested_at or dt.datetime.now(dt.timezone.utc)
    return {f"raw_{n}": stamp(scan_csv(spark, folder, n, split), batch_id, ingested_at) for n in names}


def write_csv(df: DataFrame, folder: str, name: str, compression: str = "none") -> None:
    """Write one input of a batch; null becomes an empty field.

    One task reads a part file whole, so a compressed one is as good to read; only ``split`` needs plain files.
    """
    options = {**CSV_OPTIONS, "nullValue": "", "emptyValue": "", "compression": compression}
    df.write.mode("overwrite").options(**options).csv(f"{folder}/{name}.csv")


def available_batches(spark: SparkSession, root: str) -> DataFrame:
    """Batch folders below ``root`` as a one-column table, one row per folder."""
    names = [n for n in list_folders(spark, root) if n.startswith(BATCH_PREFIX)]
    return spark.createDataFrame([(n,) for n in names], "batch_id string")


def batch_status(available: DataFrame, audit: DataFrame) -> DataFrame:
    """Every known batch with whether it lies in the folder and whether it is loaded."""
    done = audit.select("batch_id").distinct().withColumn("is_loaded", F.lit(True))
    there = available.select("batch_id").distinct().withColumn("is_available", F.lit(True))
    return there.join(done, "batch_id", "full_outer").select(
        "batch_id",
        F.coalesce("is_available", F.lit(False)).alias("is_available"),
        F.coalesce("is_loaded", F.lit(False)).alias("is_loaded"),
    )


def next_batch(available: DataFrame, audit: DataFrame) -> str | None:
    """The smallest batch id that is not loaded yet, or None."""
    waiting = available.join(audit.select("batch_id"), "batch_id", "left_anti")
    return waiting.agg(F.min("batch_id")).first()[0]


def profile_files(spark: SparkSession, folder: str) -> DataFrame:
    """File name, row count and column count of every CSV in a folder, each with a header of its own.

    One scan for any number of files. A file may be a folder of part files; it has as many columns as its widest header.
    """
    empty = "file_name string, rows bigint, columns int"
    names = [n for n in (*list_files(spark, folder), *list_folders(spark, folder)) if n.endswith(".csv")]
    if not names:
        return spark.createDataFrame([], empty)
    # A record of more or fewer than one field comes whole in the second column.
    told = {**CSV_OPTIONS, "header": "false", "multiLine": "true", "columnNameOfCorruptRecord": "record"}
    records = spark.read.schema("field string, record string").options(**told).csv(f"{folder}/*.csv")
    record = F.coalesce("record", F.coalesce("field", F.lit("")))
    part = F.col("_metadata.file_path").alias("part")
    parts = (
        records.select(part, record.alias("record"), F.monotonically_increasing_id().alias("place"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), F.min_by("record", "place").alias("header"))
    )
    commas = F.regexp_count(F.regexp_replace("header", '"([^"]|"")*"', ""), F.lit(","))
    name = F.regexp_extract("part", r"/([^/]+\.csv)(/[^/]*)?$", 1).alias("file_name")
    return parts.groupBy(name).agg(F.sum(F.col("n") - 1).alias("rows"), (F.max(commas) + 1).cast("int").alias("columns"))


def find_csv(spark: SparkSession, folder: str, keyword: str) -> DataFrame | None:
    """The first CSV whose name holds ``keyword``, types inferred; None when there is none."""
    system, target = _hadoop(spark, folder)
    if not system.exists(target):
        return None
    names = sorted(s.getPath().getName() for s in system.listStatus(target))
    match = next((n for n in names if keyword in n and n.endswith(".csv")), None)
    if match is None:
        return None
    return spark.read.options(**CSV_OPTIONS, multiLine="true", inferSchema="true").csv(f"{folder}/{match}")
