"""Profile of the raw text inputs: columns, repeat buyers, statuses, categories, days, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions.measures import pct, rounded_ratio
from mercata.functions.parsing import SIGNED_NUMBER
from mercata.plans.generator import order_day

SAMPLE_LENGTH = 35


def column_profile(table: DataFrame, name: str) -> DataFrame:
    """One row per column: type the text would have, share of nulls, smallest value as a sample.

    All columns are measured in a single pass.
    """
    measures = []
    for c in table.columns:
        text = F.col(c).cast("string")
        numeric = text.rlike(SIGNED_NUMBER)
        measures += [
            F.count(text).alias(f"{c}__filled"),
            F.count_if(numeric & ~text.contains(".")).alias(f"{c}__whole"),
            F.count_if(numeric).alias(f"{c}__numeric"),
            F.min(text).alias(f"{c}__sample"),
        ]
    row = table.agg(F.count(F.lit(1)).alias("__rows"), *measures)

    def described(c: str):
        filled = F.col(f"{c}__filled")
        # A column with gaps cannot be of a whole-number type.
        kind = (
            F.when((F.col(f"{c}__whole") == F.col("__rows")) & (filled > 0), "int64")
            .when(F.col(f"{c}__numeric") == filled, "float64")
            .otherwise("str")
        )
        return F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            kind.alias("data_type"),
            pct(F.col("__rows") - filled, F.col("__rows"), 1).alias("null_pct"),
            F.substring(F.col(f"{c}__sample"), 1, SAMPLE_LENGTH).alias("sample_value"),
        )

    return row.select(F.explode(F.array(*[described(c) for c in table.columns])).alias("_d")).select("_d.*")


def repeat_buyers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """People, customer ids, and people with at least two orders."""
    known = customers.select("customer_id", "customer_unique_id")
    per_person = (
        orders.select("order_id", "customer_id")
        .join(known, "customer_id", "left")
        .where("customer_unique_id is not null")
        .groupBy("customer_unique_id", "order_id")
        .agg(F.lit(1).alias("_one"))
        .groupBy("customer_unique_id")
        .agg(F.count(F.lit(1)).alias("_orders"))
    )
    ids = customers.groupBy("customer_id").agg(F.lit(1).alias("_one")).agg(F.count("customer_id")).scalar()
    return (
        per_person.agg(
            F.count(F.lit(1)).alias("people"), F.count_if(F.col("_orders") > 1).alias("repeat_people")
        )
        .withColumn("customer_ids", ids)
        .withColumn("repeat_pct", pct("repeat_people", "people"))
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    total = orders.agg(F.count(F.lit(1))).scalar()
    return (
        orders.where("order_status is not null")
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"))
        .withColumn("pct_of_total", pct("orders", total))
    )


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    used = products.where("product_category_name is not null").select("product_category_name").distinct()
    return used.join(translation.select("product_category_name"), "product_category_name", "left_anti")


def category_coverage(products: DataFrame, translation: DataFrame) -> DataFrame:
    per_name = products.groupBy("product_category_name").agg(F.count(F.lit(1)).alias("_n"))
    translated = translation.groupBy("product_category_name").agg(F.lit(1).alias("_one"))
    missing = untranslated_categories(products, translation)
    return per_name.agg(
        F.count("product_category_name").alias("categories"),
        F.coalesce(F.sum(F.when(F.col("product_category_name").isNull(), F.col("_n"))), F.lit(0)).alias(
            "products_without_category"
        ),
    ).select(
        "categories",
        translated.agg(F.count(F.lit(1))).scalar().alias("translated_categories"),
        missing.agg(F.count(F.lit(1))).scalar().alias("missing_translation"),
        "products_without_category",
    )


def orders_per_day(orders: DataFrame, thin_day: int = 50) -> DataFrame:
    """One row on the number of orders per day; there is one value per calendar day."""
    per_day = order_day(orders).where("order_day is not null").groupBy("order_day").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_day.agg(
        F.min("order_day").alias("first_day"),
        F.max("order_day").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        rounded_ratio(F.sum("n"), F.count(F.lit(1))).alias("mean_orders"),
        F.percentile("n", F.lit(0.5)).alias("median_orders"),
        F.min("n").alias("min_orders"),
        F.max("n").alias("max_orders"),
        F.count_if(F.col("n") < thin_day).alias("thin_days"),
    )


def key_report(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Repeated item keys, items without an order, items per order."""
    per_key = items.groupBy("order_id", "order_item_id").agg(F.count(F.lit(1)).alias("n"))
    per_order = per_key.groupBy("order_id").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("repeats"))
    known = orders.select("order_id").distinct().withColumn("_known", F.lit(True))
    return (
        per_order.join(known, "order_id", "left")
        .agg(
            F.sum("n").alias("item_rows"),
            F.sum("repeats").alias("repeated_keys"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("orphan_items"),
            rounded_ratio(F.sum("n"), F.count("order_id")).alias("items_per_order"),
        )
    )


def orders_per_month(orders: DataFrame) -> DataFrame:
    return (
        order_day(orders)
        .where("order_day is not null")
        .groupBy(F.trunc("order_day", "month").alias("order_month"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
