"""Operators on keyed tables: keep one row per key, insert if absent, partial upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first under ``order``.

    The ``row_number() = 1`` form lets Spark drop all but the best row of a key
    before the shuffle, so a key holding a large part of the input stays harmless.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def narrow_to_keys(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a large ``existing`` table whose key occurs in the smaller ``new``.

    Done first, it keeps the large side from being shuffled whenever the keys of a
    batch are few enough for Spark's own broadcast limit.
    """
    return existing.join(new.select(*keys), list(keys), "left_semi")


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key is not yet in ``existing``: the first write wins.

    One join, so that ``new``, which may be the outcome of a long plan, is worked out once. Of ``existing`` only the
    keys are read; where it is large and ``new`` is small and cheap, pass it through ``narrow_to_keys`` first.
    """
    return new.join(existing.select(*keys), list(keys), "left_anti")


def upsert_columns(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Merge ``incoming`` into ``current``.

    New keys are added whole. For known keys only the ``update`` columns are taken
    over, nulls included; the other columns keep the value first written.
    """
    keys, update = list(keys), set(update)
    left = current.withColumn("_known", F.lit(True)).alias("cur")
    right = incoming.withColumn("_sent", F.lit(True)).alias("new")
    merged = left.join(right, keys, "full_outer")

    def pick(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in update:
            take_new = F.col("new._sent").isNotNull()
        else:
            take_new = F.col("cur._known").isNull()
        return F.when(take_new, F.col(f"new.{name}")).otherwise(F.col(f"cur.{name}")).alias(name)

    return merged.select([pick(name) for name in current.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
