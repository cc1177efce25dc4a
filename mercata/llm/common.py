"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from mercata.session import name_table, scratch_path

MOST_BUCKETS = 100_000  # Spark's own limit, unless it is set otherwise


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(df: DataFrame) -> int:
    """The number of shuffle partitions the session asks for; it is set to suit the input."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return memory that this Python worker holds but no longer uses: workers go from stage to stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + length]`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def bucketed(df: DataFrame, column: str, label: str) -> DataFrame:
    """``df`` written below the shared folder in buckets of ``column``, without a shuffle.

    A join on the column reads the buckets in place and shuffles the other side alone.
    """
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    path = scratch_path(df.sparkSession, label)
    df.write.bucketBy(min(partitions(df), MOST_BUCKETS), column).option("path", path).saveAsTable(name)
    name_table(path, name)
    return df.sparkSession.table(name)
