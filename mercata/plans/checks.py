"""Data-quality checks: preconditions, key and parent checks, column checks, layer counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.operators.keyed import duplicate_keys
from mercata.plans.audit import load_history
from mercata.schemas import TABLES


class CheckFailed(RuntimeError):
    """A check on the data did not hold."""


def seed_status(dims: dict[str, DataFrame]) -> DataFrame:
    """One row per dimension: whether it has rows. One job for all, which reads no column."""
    return layer_counts(dims).select("table_name", (F.col("row_count") > 0).alias("has_rows"))


def require_seed(dims: dict[str, DataFrame]) -> None:
    """Refuse to go on while a dimension is empty; facts would join to nothing."""
    empty = sorted(r.table_name for r in seed_status(dims).where("not has_rows").collect())  # a row per dimension
    if empty:
        raise CheckFailed(f"load the seed first, no rows in: {', '.join(empty)}")


def column_checks(items: DataFrame) -> DataFrame:
    """Three rows: no null order_id, no null order_item_id, no price below zero. One pass."""
    row = items.agg(
        F.count_if(F.col("order_id").isNull()).alias("order_id_nulls"),
        F.count_if(F.col("order_item_id").isNull()).alias("order_item_id_nulls"),
        F.count_if(F.col("price") < 0).alias("prices_below_zero"),
    )
    names = row.columns
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("breaches")) for n in names])
    return row.select(F.explode(pairs).alias("_c")).select(
        "_c.*", (F.col("_c.breaches") == 0).alias("passed")
    )


def require_clean(items: DataFrame) -> None:
    failed = [r.check_name for r in column_checks(items).where("not passed").collect()]  # three rows at most
    if failed:
        raise CheckFailed(f"checks failed: {', '.join(failed)}")


def repeated_keys(df: DataFrame, table: str, limit: int | None = None) -> DataFrame:
    """Keys of ``table`` that occur more than once, most frequent first; ``limit`` is for a printout."""
    found = duplicate_keys(df, TABLES[table].key).orderBy(F.desc("n"), *TABLES[table].key)
    return found if limit is None else found.limit(limit)


def orphan_count(child: DataFrame, parent: DataFrame, key: str = "order_id") -> DataFrame:
    """One row: child rows without a parent."""
    return child.join(parent.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("orphans"))


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one union for all of them."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def constraint_breaches(df: DataFrame, table: str) -> DataFrame:
    """One row: rows that break the declared key or a not-null column of ``table``."""
    spec = TABLES[table]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in spec.not_null]
    repeated = duplicate_keys(df, spec.key).agg(F.count(F.lit(1))).scalar()
    return df.agg(*nulls).select("*", repeated.alias("repeated_keys"))


def evidence(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What to look at after a run: loads, rows per table, repeated item keys, orphan items."""
    return {
        "load_audit": load_history(tables["load_audit"]),
        "layer_counts": layer_counts(tables),
        "repeated_keys": repeated_keys(tables["fct_order_items"], "fct_order_items"),
        "orphan_items": orphan_count(tables["fct_order_items"], tables["stg_orders"]),
    }
