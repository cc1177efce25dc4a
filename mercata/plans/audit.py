"""Load accounting per batch and table, and snapshots of the whole warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions.measures import cents, from_cents
from mercata.schemas import DYNAMIC_INPUTS, conform
from mercata.sources.batches import BATCH_PREFIX

NO_BATCH = "(none yet)"


def audit_batches(
    batches: DataFrame, raw: dict[str, DataFrame], rejects: DataFrame, staging: dict[str, DataFrame]
) -> DataFrame:
    """Four rows per batch: in, rejected, loaded, and the rest as duplicates.

    ``batches`` lists ``batch_id, run_time`` and, if known, ``duration_sec``; a batch
    without rows is audited with zeros. Every source is counted by batch before the
    counts meet, so only counts are shuffled.
    """
    zero = F.lit(0).cast("bigint")
    one = F.count(F.lit(1))
    duration = F.col("duration_sec") if "duration_sec" in batches.columns else F.lit(None)
    table_names = F.array(*[F.lit(f"raw_{n}") for n in DYNAMIC_INPUTS])
    frame = batches.select(
        "batch_id",
        F.explode(table_names).alias("table_name"),
        "run_time",
        duration.cast("decimal(8,2)").alias("duration_sec"),
        zero.alias("rows_in"),
        zero.alias("rows_rejected"),
        zero.alias("rows_loaded"),
    )

    def counts(df: DataFrame, column: str) -> DataFrame:
        return df.select("batch_id", "table_name", F.col("n").alias(column))

    pieces = [frame]
    for name in DYNAMIC_INPUTS:
        table = F.lit(f"raw_{name}").alias("table_name")
        arrived = raw[f"raw_{name}"].groupBy("batch_id").agg(one.alias("n")).select("batch_id", table, "n")
        loaded = staging[f"stg_{name}"].groupBy("batch_id").agg(one.alias("n")).select("batch_id", table, "n")
        pieces += [counts(arrived, "rows_in"), counts(loaded, "rows_loaded")]
    refused = (
        rejects.groupBy("batch_id", F.regexp_replace("source_table", "^raw\\.", "").alias("table_name"))
        .agg(one.alias("n"))
    )
    pieces.append(counts(refused, "rows_rejected"))

    summed = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
        .groupBy("batch_id", "table_name")
        .agg(
            F.max("run_time").alias("run_time"),
            F.max("duration_sec").alias("duration_sec"),
            *[F.coalesce(F.sum(c), zero).alias(c) for c in ("rows_in", "rows_rejected", "rows_loaded")],
        )
        .where("run_time is not null")  # a batch that is not asked for
    )
    rest = F.col("rows_in") - F.col("rows_rejected") - F.col("rows_loaded")
    return conform(
        summed.withColumn("rows_dup", rest).withColumn("note", F.lit(None).cast("string")), "load_audit"
    )


def load_history(audit: DataFrame) -> DataFrame:
    """The audit in the order the batches were run."""
    return audit.orderBy("run_time", "batch_id", "table_name")


def snapshot(audit: DataFrame, items: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row: batches loaded, item rows, revenue in whole units, rejects, newest batch."""
    daily = F.col("batch_id").startswith(BATCH_PREFIX)
    loaded = audit.groupBy("batch_id").agg(F.lit(1).alias("_one")).where(daily)
    batches = loaded.agg(
        F.count(F.lit(1)).alias("batches"), F.coalesce(F.max("batch_id"), F.lit(NO_BATCH)).alias("newest_batch")
    )
    facts = items.agg(
        F.count(F.lit(1)).alias("item_rows"),
        F.coalesce(F.round(from_cents(F.sum(cents("item_revenue"))), 0), F.lit(0)).cast("bigint").alias("revenue"),
    )
    return batches.select(
        "batches",
        facts.select("item_rows").scalar().alias("item_rows"),
        facts.select("revenue").scalar().alias("revenue"),
        rejects.agg(F.count(F.lit(1))).scalar().alias("rejected_rows"),
        "newest_batch",
    )


SNAPSHOT_MEASURES = ("batches", "item_rows", "revenue", "rejected_rows")


def snapshot_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per measure: before, after and the difference."""

    def long(df: DataFrame, column: str) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias(column))
                for m in SNAPSHOT_MEASURES
            ]
        )
        return df.select(F.explode(pairs).alias("_p")).select("_p.*")

    joined = long(before, "before").join(long(after, "after"), "measure")
    return joined.withColumn("delta", F.col("after") - F.col("before"))
