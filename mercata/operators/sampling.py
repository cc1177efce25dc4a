"""Repeatable samples of an exact size, drawn by hash order inside each group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3  # 4,096 buckets per group and draw


def _digest(group: str, draw: str, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.col(group).cast("string"), F.lit(draw), *[F.col(k) for k in keys]))


def sample_cuts(df: DataFrame, group: str, keys: Sequence[str], rates: Mapping[str, float]) -> DataFrame:
    """Per group and draw, the highest hash that still belongs to the sample.

    A histogram over hash prefixes tells which bucket holds the cut; only the rows of
    that bucket, about 1/4096 of a group, are then ordered. Equal hashes are counted
    first, so copies of one row cannot crowd a task.
    """
    draws = F.array(*[F.struct(F.lit(d).alias("_draw"), _digest(group, d, keys).alias("_hash")) for d in rates])
    hashed = df.select(group, F.explode(draws).alias("_d")).select(
        group, "_d.*", F.substring("_d._hash", 1, BUCKET_DIGITS).alias("_bucket")
    )
    rate = F
    for draw, share in rates.items():
        rate = rate.when(F.col("_draw") == draw, F.lit(share))

    whole = Window.partitionBy(group, "_draw")
    cut_bucket = (
        hashed.groupBy(group, "_draw", "_bucket")
        .agg(F.count(F.lit(1)).alias("_c"))
        .select(
            "*",
            F.sum("_c").over(whole.orderBy("_bucket")).alias("_upto"),
            F.greatest(F.lit(1).cast("bigint"), F.floor(F.sum("_c").over(whole) * rate)).alias("_wanted"),
        )
        .where("_upto >= _wanted and _upto - _c < _wanted")
        .select(group, "_draw", "_bucket", (F.col("_wanted") - F.col("_upto") + F.col("_c")).alias("_need"))
    )
    in_bucket = (
        hashed.join(F.broadcast(cut_bucket), [group, "_draw", "_bucket"])
        .groupBy(group, "_draw", "_hash", "_need")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_upto", F.sum("_copies").over(whole.orderBy("_hash")))
        .where("_upto >= _need")
    )
    return in_bucket.groupBy(group).agg(
        *[F.min(F.when(F.col("_draw") == d, F.col("_hash"))).alias(f"_cut_{d}") for d in rates]
    )


def with_sample_flags(df: DataFrame, group: str, keys: Sequence[str], rates: Mapping[str, float]) -> DataFrame:
    """Add one flag ``is_<name>`` per entry of ``rates``.

    Each flag marks ``max(1, floor(n * rate))`` rows of each group, chosen by hash
    order: the same group, name and keys always give the same rows. Rows that agree in
    all ``keys`` are chosen together. ``df`` is read three times, so it should be cheap
    to read. ``group`` must have few values (one per batch), as its cuts are broadcast.
    """
    cuts = sample_cuts(df, group, keys, rates)
    marked = df.join(F.broadcast(cuts), group, "left")
    flags = {f"is_{d}": F.coalesce(_digest(group, d, keys) <= F.col(f"_cut_{d}"), F.lit(False)) for d in rates}
    return marked.withColumns(flags).drop(*[f"_cut_{d}" for d in rates])


def hash_choice(keys: Sequence[str], salt: str, options: int) -> Column:
    """A repeatable whole number in ``0 .. options - 1`` for each row, each equally likely."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), *[F.col(k) for k in keys]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % options).cast("int")
