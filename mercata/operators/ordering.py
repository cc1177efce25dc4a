"""Order over a whole table without putting it into one task.

A window without a partition moves every row to a single task. Here the rows are
range-partitioned instead; each partition is ordered on its own and a table with one
row per partition carries counts, sums and ties from one partition to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercata.session import cut_lineage

TIE_CHARACTERS = 3  # of a text that settles ties: 4,096 starts of hexadecimal ids
STEPS = 64  # by which a value grows to its e-fold


def with_global_order(df: DataFrame, by: str, tie: Sequence[str]) -> DataFrame:
    """Add ``row_number``, ``rank`` and ``running_sum`` over ``by`` descending.

    ``row_count`` and ``total_sum`` are those of the whole table.

    ``by`` must not be null and ``tie`` must make the order unique; ties in ``by``
    share a rank and are numbered by ``tie``. Because ``tie`` also takes part in the
    range split, a value shared by many rows is spread over several partitions.
    """
    order = [F.col(by).desc(), *[F.col(t).asc() for t in tie]]
    spread = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = cut_lineage(spread, "order")

    inside = Window.partitionBy("_part").orderBy(*order)
    by_value = Window.partitionBy("_part").orderBy(order[0])
    local = placed.select(
        "*",
        F.row_number().over(inside).alias("_row"),
        F.rank().over(by_value).alias("_rank"),
        F.sum(by).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_run"),
    )
    ends = local.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(by).alias("_sum"),
        F.max(by).alias("_first"),
        F.min(by).alias("_last"),
        F.max("_rank").alias("_last_rank"),
    )
    # One row per partition from here on.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    ends = ends.select(
        "*",
        F.sum("_n").over(everything).alias("row_count"),
        F.sum("_sum").over(everything).alias("total_sum"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
    )
    # A value that ends one partition and starts the next has its rank in the earlier one.
    same_value = Window.partitionBy("_value").orderBy("_part", "_side")
    starts = (
        ends.select(
            "_part",
            F.explode(
                F.array(
                    F.struct(
                        F.col("_first").alias("_value"),
                        F.lit("first").alias("_side"),
                        (F.col("_rows_before") + 1).alias("_start"),
                    ),
                    F.struct(
                        F.col("_last").alias("_value"),
                        F.lit("last").alias("_side"),
                        (F.col("_rows_before") + F.col("_last_rank")).alias("_start"),
                    ),
                )
            ).alias("_end"),
        )
        .select("_part", "_end.*")
        .withColumn("_start", F.min("_start").over(same_value))
        .where("_side = 'first'")
        .select("_part", F.col("_start").alias("_first_rank"))
    )
    offsets = ends.join(starts, "_part").select(
        "_part", "_rows_before", "_sum_before", "_first", "_first_rank", "row_count", "total_sum"
    )
    # Bounded by the number of shuffle partitions, hence the hint.
    joined = local.join(F.broadcast(offsets), "_part")
    rank = F.when(F.col(by) == F.col("_first"), F.col("_first_rank")).otherwise(
        F.col("_rows_before") + F.col("_rank")
    )
    return joined.select(
        *df.columns,
        (F.col("_rows_before") + F.col("_row")).alias("row_number"),
        rank.cast("bigint").alias("rank"),
        (F.col("_sum_before") + F.col("_run")).alias("running_sum"),
        "row_count",
        "total_sum",
    )


def with_value_order(df: DataFrame, by: str, tie: str) -> DataFrame:
    """What :func:`with_global_order` adds, as one plan: no job runs and nothing is written until rows are asked for.

    Rows are first counted by value and by the first characters of ``tie``, a text. Values are then summed up inside
    steps of about 1.6 per cent, which do not depend on the data, and over the steps, of which there are at most 6,000;
    equal values are numbered by the counts of the smaller first characters and inside these by ``tie``. So no task
    orders more than a step's distinct values or the rows that share a value and first characters, and as all of this is
    counted, not estimated, a lost executor changes nothing. ``df`` is read twice: Spark shares a shuffle it ends in.
    """
    value, text = F.col(by), F.col(tie)
    keyed = df.withColumn("_start", F.substring(text, 1, TIE_CHARACTERS))
    starts = keyed.groupBy(value.alias("_value"), "_start").agg(F.count(F.lit(1)).alias("_n"))
    kind = dict(df.agg(F.sum(by).alias("s")).dtypes)["s"]

    # Distinct values, in steps from the largest down.
    size = F.col("_value").cast("double")
    step = (-F.signum(size) * F.floor(F.log1p(F.abs(size) * 100) * STEPS)).cast("int")
    values = starts.groupBy("_value").agg(F.sum("_n").alias("_n")).withColumn("_step", step)
    values = values.withColumn("_sum", (F.col("_value") * F.col("_n").cast("decimal(18,0)")).cast(kind))
    inside = Window.partitionBy("_step").orderBy(F.col("_value").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = [F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_above") for c in ("_n", "_sum")]
    values = values.select("_value", "_step", *above)
    steps = starts.groupBy(step.alias("_step")).agg(
        F.sum("_n").alias("_n"), F.sum((F.col("_value") * F.col("_n").cast("decimal(18,0)")).cast(kind)).alias("_sum")
    )
    before = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    steps = steps.select(
        "_step",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
        F.sum("_n").over(everything).alias("row_count"),
        F.sum("_sum").over(everything).cast(kind).alias("total_sum"),
    )
    # The number of steps is bounded by the range of a double, hence the hint.
    values = values.join(F.broadcast(steps), "_step").select(
        "_value",
        (F.col("_n_before") + F.col("_n_above")).alias("_rows_above"),
        (F.col("_sum_before") + F.col("_sum_above")).cast(kind).alias("_sum_above"),
        "row_count",
        "total_sum",
    )
    smaller = Window.partitionBy("_value").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = starts.select(
        "_value", "_start", F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_ties_before")
    ).join(values, "_value")
    place = F.row_number().over(Window.partitionBy(by, "_start").orderBy(tie))
    rows = keyed.withColumn("_place", place).withColumnRenamed("_start", "_own")
    rows = rows.join(offsets, (value == F.col("_value")) & (F.col("_own") == F.col("_start")))
    tied = F.col("_ties_before") + F.col("_place")
    return rows.select(
        *df.columns,
        (F.col("_rows_above") + tied).alias("row_number"),
        (F.col("_rows_above") + 1).alias("rank"),
        (F.col("_sum_above") + value * tied.cast("decimal(18,0)")).cast(kind).alias("running_sum"),
        "row_count",
        "total_sum",
    )


def exact_percentile(df: DataFrame, column: str, p: float = 0.5, accuracy: int = 10_000) -> DataFrame:
    """One row, column ``percentile``: the exact, linearly interpolated percentile.

    A mergeable sketch first brackets the wanted rank to within ``2 / accuracy`` of
    all rows. Only the distinct values inside the bracket are then ordered, after
    their occurrences have been counted, so no task sees more than that share.
    ``df`` is read twice, so it should be cheap to read.
    """
    value = F.col(column)
    rows = df.select(value.alias("_v")).where(value.isNotNull())
    slack = 2.0 / accuracy
    spots = F.array(F.lit(max(0.0, p - slack)), F.lit(min(1.0, p + slack)))
    sketch = F.percentile_approx("_v", spots, F.lit(accuracy))
    frame = rows.agg(F.struct(sketch.alias("b"), F.count("_v").alias("n"))).scalar()
    low, high, total = frame["b"][0], frame["b"][1], frame["n"]

    counted = (
        rows.where(F.col("_v") <= high)
        .groupBy(F.when(F.col("_v") >= low, F.col("_v")).alias("_v"))  # null: everything below
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = F.sum("_c").over(Window.orderBy(F.col("_v").asc_nulls_first()))
    ranked = counted.select("_v", upto.alias("_upto"), ((total - 1) * F.lit(p)).alias("_spot"))
    floor_row = F.floor("_spot") + 1
    ceil_row = F.ceil("_spot") + 1
    ends = ranked.agg(
        F.min(F.when(F.col("_upto") >= floor_row, F.col("_v"))).cast("double").alias("_lo"),
        F.min(F.when(F.col("_upto") >= ceil_row, F.col("_v"))).cast("double").alias("_hi"),
        F.max("_spot").alias("_spot"),
    )
    weight = F.col("_spot") - F.floor("_spot")
    return ends.select((F.col("_lo") + (F.col("_hi") - F.col("_lo")) * weight).alias("percentile"))
